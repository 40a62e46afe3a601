"""Keyed format-preserving ciphers as Spark SQL expressions.

Every cipher is a ten-round alternating Feistel network over two halves ``a`` and ``b``:
an even round adds a keyed word of ``b`` to ``a`` modulo the size of ``a``, an odd round adds a
keyed word of ``a`` to ``b``; restoring subtracts the words in reverse order. So each cipher is a
bijection of its domain, deterministic for a key, and null stays null.

The pseudorandom function is SHA-256(key, round, length, other half). ``xxhash64`` with two seeds
only folds the digest into BIGINT words, which is several times faster inside the JVM than parsing
hex text. A word is reduced modulo at most 10^9 or a power of two, so no usable bias is left.

The functions are built here as SQL text, as a chain of named projections that code generation
compiles (``staged``); strings whose halves exceed one block take one expression with lambdas inside
the same chain. ``statlake.functions.cipher_arrow`` has the same ciphers for SQL functions.
"""

from __future__ import annotations

import base64
import hashlib
import hmac
from dataclasses import dataclass, field

from pyspark.sql import types as T

from statlake.errors import PolicyError

ROUNDS = 10

# The alphabets of the presets.
DIGITS = "0123456789"
ALPHANUMERIC = DIGITS + "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "abcdefghijklmnopqrstuvwxyz"
ALPHANUMERIC_WHITESPACE = ALPHANUMERIC + " "

# The functions a policy may name, and the alphabet each works on.
PRESETS = {
    "fpe-digits": DIGITS,
    "fpe-alphanumeric": ALPHANUMERIC,
    "fpe-text": ALPHANUMERIC_WHITESPACE,
    "fpe-fnr": DIGITS,
}

# The names of the eight supported types.
TYPE_NAMES = ("string", "long", "integer", "double", "float", "boolean", "date", "timestamp")


def type_name(data_type: T.DataType) -> str:
    names = {
        T.StringType: "string",
        T.LongType: "long",
        T.IntegerType: "integer",
        T.DoubleType: "double",
        T.FloatType: "float",
        T.BooleanType: "boolean",
        T.DateType: "date",
        T.TimestampType: "timestamp",
        T.TimestampNTZType: "timestamp_ntz",
    }
    name = names.get(type(data_type))
    if name is None:
        raise PolicyError(f"columns of type {data_type.simpleString()} cannot be pseudonymized")
    return name


def key_domain(kind: str, alphabet: str) -> str:
    """Columns that must give equal tokens share a domain: strings by alphabet, others by type."""
    if kind == "string":
        return f"string/{len(alphabet)}"
    return "timestamp" if kind == "timestamp_ntz" else kind


def derive_key(secret: str, domain: str) -> str:
    """128-bit key of a domain as 22 characters, so a round's message fits one SHA-256 block."""
    digest = hmac.new(secret.encode(), domain.encode(), hashlib.sha256).digest()
    return base64.b64encode(digest[:16]).decode().rstrip("=")


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _shifted(value: str, word: str, modulus: str, restore: bool) -> str:
    return f"pmod({value} {'-' if restore else '+'} {word}, {modulus})"


def _small_word(digest: str, modulus: str) -> str:
    return f"pmod(xxhash64(1, {digest}), {modulus})"


def _large_word(digest: str, high: str, low: str) -> str:
    """A word below ``high * low``, drawn in two parts."""
    return f"({_small_word(digest, high)} * {low} + pmod(xxhash64(2, {digest}), {low}))"


def _constants(values, sql_type: str) -> str:
    """A constant array. Written as one text that Spark folds once, not as an expression for each
    element, which would make plans large."""
    return f"cast(split('{','.join(map(str, values))}', ',') as array<{sql_type}>)"


def _apart(value: str) -> str:
    """The value unchanged, through a lambda. Spark leaves a projection with a lambda out of the
    generated loop around it, so the rounds of one column stay a method of their own, small enough
    for the JVM to compile; fused into one method with everything else they would be interpreted.
    The value itself is interpreted, so it must be cheap.
    """
    return f"element_at(transform(array({value}), v -> v), 1)"


# ---------------------------------------------------------------------------------------------
# Fixed-width types
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Numeric:
    """How a fixed-width type splits into two halves and joins again.

    ``{x}`` is the input, ``{a}``/``{b}`` the halves, ``{aux}`` the auxiliary value if any.
    """

    a: str
    b: str
    size_a: int
    size_b: int
    join: str
    aux: str | None = None


def _mantissa(bits: int, smallest: str, largest: str, back: str) -> Numeric:
    """Permute the mantissa, keep sign and exponent. Zero, NaN, infinities and subnormal numbers
    pass through, so every finite number stays finite."""
    size = "abs(cast({x} as double))"
    exponent = f"cast(floor(log2({size})) as int)"
    # log2 may round across a power of two, so the exponent is corrected by comparison
    aux = (
        f"CASE WHEN {size} BETWEEN {smallest} AND {largest} THEN "
        f"CASE WHEN {size} >= pow(2D, {exponent} + 1) THEN {exponent} + 1 "
        f"WHEN {size} < pow(2D, {exponent}) THEN {exponent} - 1 ELSE {exponent} END END"
    )
    low = bits // 2
    fraction = f"(cast({size} / pow(2D, {{aux}}) * {1 << bits}D as bigint) - {1 << bits}L)"
    joined = f"({1 << bits}L + {{a}} * {1 << low}L + {{b}})"
    return Numeric(
        a=f"shiftright({fraction}, {low})",
        b=f"({fraction} & {(1 << low) - 1}L)",
        size_a=1 << (bits - low),
        size_b=1 << low,
        join=(
            f"CASE WHEN {{aux}} IS NULL THEN {{x}} ELSE "
            f"cast(signum({{x}}) * {joined} * pow(2D, {{aux}} - {bits}) as {back}) END"
        ),
        aux=aux,
    )


def _checked(value: str, limit: str, what: str) -> str:
    message = f"'{what} outside the range that can be pseudonymized'"
    return (
        f"CASE WHEN {value} BETWEEN 0 AND {limit} THEN {value} "
        f"WHEN {{x}} IS NOT NULL THEN raise_error({message}) END"
    )


_DAY = 86_400_000_000  # microseconds
_DAYS = 2127 * 1717  # 0001-01-01 to 9999-12-31
_EPOCH_MICROS = 719_162 * _DAY  # 0001-01-01 to 1970-01-01

# Microseconds since 0001-01-01 from the parts of a timestamp without zone. timestampdiff would first
# place it in the session's zone and shift times that a clock change skips.
_NTZ_MICROS = (
    "(datediff({x}, DATE'0001-01-01') * 86400000000L + hour({x}) * 3600000000L "
    "+ minute({x}) * 60000000L + cast(extract(SECOND FROM {x}) * 1000000 as bigint))"
)

NUMERIC = {
    "integer": Numeric(
        a="cast(shiftright({x}, 16) as bigint) + 32768L",
        b="cast({x} & 65535 as bigint)",
        size_a=1 << 16,
        size_b=1 << 16,
        join="cast(({a} - 32768L) * 65536L + {b} as int)",
    ),
    "long": Numeric(
        a="shiftrightunsigned({x}, 32)",
        b="({x} & 4294967295L)",
        size_a=1 << 32,
        size_b=1 << 32,
        join="(shiftleft({a}, 32) | {b})",
    ),
    "double": _mantissa(52, "2.2250738585072014E-308D", "1.7976931348623157E308D", "double"),
    "float": _mantissa(23, "1.1754943508222875E-38D", "3.4028234663852886E38D", "float"),
    # days since 0001-01-01; 2127 * 1717 is the number of days up to 9999-12-31
    "date": Numeric(
        a="({aux} div 1717L)",
        b="({aux} % 1717L)",
        size_a=2127,
        size_b=1717,
        join="date_add(DATE'0001-01-01', cast({a} * 1717L + {b} as int))",
        aux=_checked("cast(datediff({x}, DATE'0001-01-01') as bigint)", f"{_DAYS - 1}L", "date"),
    ),
    # the day and the microsecond of the day
    "timestamp": Numeric(
        a=f"({{aux}} div {_DAY}L)",
        b=f"({{aux}} % {_DAY}L)",
        size_a=_DAYS,
        size_b=_DAY,
        join=f"timestamp_micros({{a}} * {_DAY}L + {{b}} - {_EPOCH_MICROS}L)",
        aux=_checked(f"(unix_micros({{x}}) + {_EPOCH_MICROS}L)", f"{_DAYS * _DAY - 1}L", "timestamp"),
    ),
    "timestamp_ntz": Numeric(
        a=f"({{aux}} div {_DAY}L)",
        b=f"({{aux}} % {_DAY}L)",
        size_a=_DAYS,
        size_b=_DAY,
        join=f"timestampadd(MICROSECOND, {{a}} * {_DAY}L + {{b}}, TIMESTAMP_NTZ'0001-01-01 00:00:00')",
        aux=_checked(_NTZ_MICROS, f"{_DAYS * _DAY - 1}L", "timestamp"),
    ),
}


def _boolean(x: str, key: str) -> str:
    """A keyed flip: one bit holds no more."""
    return f"({x} <> ((xxhash64(sha2({key}, 256)) & 1L) = 1L))"


# ---------------------------------------------------------------------------------------------
# Strings: characters of the alphabet are enciphered, all others keep their place
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Radix:
    """An alphabet. Halves are cut into blocks whose numbers fit a BIGINT with room to add."""

    alphabet: str

    @property
    def size(self) -> int:
        return len(self.alphabet)

    @property
    def block(self) -> int:
        return 18 if self.size == 10 else 10

    @property
    def staged_chars(self) -> int:
        return 2 * self.block

    @property
    def char_class(self) -> str:
        return {10: "0-9", 62: "0-9A-Za-z", 63: "0-9A-Za-z "}[self.size]

    def members(self, text: str, others: str) -> str:
        """The text without its characters outside the alphabet, which ``others`` lists."""
        return f"CASE WHEN {others} = '' THEN {text} ELSE translate({text}, {others}, '') END"

    def others(self, text: str) -> str:
        return f"translate({text}, '{self.alphabet}', '')"

    def code(self, char: str) -> str:
        """Place of a character in the alphabet, by a table over ASCII."""
        table = [max(0, self.alphabet.find(chr(i))) for i in range(128)]
        return f"get({_constants(table, 'bigint')}, ascii({char}))"

    def char(self, code: str) -> str:
        return f"get({_constants(self.alphabet, 'string')}, cast({code} as int))"

    def power(self, exponent: str) -> str:
        table = [self.size**i for i in range(self.block + 1)]
        return f"get({_constants(table, 'bigint')}, {exponent})"

    def number(self, text: str) -> str:
        """The number a block of at most ``block`` characters spells."""
        if self.size == 10:
            return f"CASE WHEN {text} = '' THEN 0L ELSE cast({text} as bigint) END"
        padded = f"lpad({text}, {self.block}, '{self.alphabet[0]}')"
        digits = [
            f"{self.code(f'substring({padded}, {i + 1}, 1)')} * {self.size ** (self.block - 1 - i)}L"
            for i in range(self.block)
        ]
        return " + ".join(digits)

    def spelled(self, number: str, length: str) -> str:
        """The text of ``length`` characters that spells a block's number."""
        if self.size == 10:
            return f"lpad(cast({number} as string), {length}, '0')"
        chars = [
            self.char(f"({number} div {self.size ** (self.block - 1 - i)}L) % {self.size}L")
            for i in range(self.block)
        ]
        return f"right(concat({', '.join(chars)}), {length})"


def _string_single(radix: Radix, x: str, key: str, restore: bool) -> str:
    """The string cipher for any length, as one expression over arrays of blocks."""
    block = radix.block
    alphabet = f"'{radix.alphabet}'"

    def blocks(start: str, length: str) -> str:
        """Characters of one half -> its blocks: number, and the sizes of its word's two parts."""
        count = f"greatest(1, cast(ceil(({length}) / {block}D) as int))"
        held = f"greatest(0, least({block}, {length} - {block} * j))"
        number = (
            f"aggregate(slice(t.codes, {start} + {block} * j, n), 0L, (acc, c) -> acc * {radix.size}L + c)"
        )
        entry = (
            f"named_struct('n', n, 'v', {number}, "
            f"'hi', {radix.power('n - n div 2')}, 'lo', {radix.power('n div 2')})"
        )
        return f"transform(sequence(0, {count} - 1), j -> {_let('n', held, entry)})"

    message = (
        "concat(s.k, i, s.n, '|', array_join(transform(s.next, y -> cast(y.v as string)), ','))"
    )
    # the digest of the message serves the first block, every further block gets its own
    digest = "IF(j = 0, h, sha2(concat(h, '|', j), 256))"
    value = _shifted("y.v", _large_word("g", "y.hi", "y.lo"), "y.hi * y.lo", restore)
    entry = f"named_struct('n', y.n, 'v', {value}, 'hi', y.hi, 'lo', y.lo)"
    moved = _let(
        "h",
        f"sha2({message}, 256)",
        f"transform(s.turn, (y, j) -> {_let('g', digest, entry)})",
    )
    # the halves take turns: apply starts with a, restore with b, and ten rounds end where they began
    order = f"sequence({ROUNDS - 1}, 0)" if restore else f"sequence(0, {ROUNDS - 1})"
    left, right = blocks("1", "t.n div 2"), blocks("t.n div 2 + 1", "t.n - t.n div 2")
    turn, following = (right, left) if restore else (left, right)
    halves = "concat(s.next, s.turn)" if restore else "concat(s.turn, s.next)"
    ciphered = (
        f"aggregate({order}, "
        f"named_struct('k', t.k, 'n', t.n, 'turn', {turn}, 'next', {following}), "
        f"(s, i) -> named_struct('k', s.k, 'n', s.n, 'turn', s.next, 'next', {moved}), "
        f"s -> array_join(transform({halves}, y -> {radix.spelled('y.v', 'y.n')}), ''))"
    )
    prepared = (
        f"named_struct('k', {key}, 'n', cast(length(p) as int), "
        f"'codes', transform(regexp_extract_all(p, '(?s).', 0), c -> {radix.code('c')}))"
    )
    # put the characters back: pairs (place, character) of members and others, sorted by place
    merged = (
        f"array_join(transform(array_sort(concat("
        f"zip_with(filter(transform(chars, (c, i) -> IF(instr({alphabet}, c) > 0, i, -1)), i -> i >= 0), "
        f"regexp_extract_all(w, '(?s).', 0), (i, c) -> named_struct('i', i, 'c', c)), "
        f"filter(transform(chars, (c, i) -> named_struct('i', i, 'c', c)), "
        f"e -> instr({alphabet}, e.c) = 0))), e -> e.c), '')"
    )
    placed = (
        f"CASE WHEN length(w) = length({x}) THEN w ELSE "
        + _let("chars", f"regexp_extract_all({x}, '(?s).', 0)", merged)
        + " END"
    )
    enciphered = _let("w", _let("t", prepared, ciphered), placed)
    members = _let("o", radix.others(x), radix.members(x, "o"))
    return _let("p", members, f"CASE WHEN length(p) = 0 THEN {x} ELSE {enciphered} END")


# ---------------------------------------------------------------------------------------------
# Staged form
# ---------------------------------------------------------------------------------------------


@dataclass
class Staged:
    """The projections that encipher one column: each stage maps new column names to SQL text, and
    ``result`` is the enciphered value."""

    stages: list[dict[str, str]] = field(default_factory=list)
    result: str = ""

    def at(self, k: int) -> dict[str, str]:
        return self.stages[k] if k < len(self.stages) else {}


def staged(kind: str, alphabet: str, x: str, key: str, prefix: str, restore: bool) -> Staged:
    """Stages of one column; ``prefix`` keeps the working columns of several ciphers apart."""
    if kind == "boolean":
        return Staged(result=_boolean(x, key))
    if kind == "string":
        return _staged_string(Radix(alphabet), x, key, prefix, restore)
    return _staged_numeric(NUMERIC[kind], x, key, prefix, restore)


def _round_stages(restore: bool, names: tuple[str, str], step) -> list[dict[str, str]]:
    """The rounds in pairs, one projection for each pair. ``step(i, target, other)`` is the new
    value of a half; the second half of a pair repeats the text of the first, which Spark computes
    once for both."""
    rounds = list(reversed(range(ROUNDS))) if restore else list(range(ROUNDS))
    stages = []
    for first, second in zip(rounds[::2], rounds[1::2]):
        one, two = names[first % 2], names[second % 2]
        changed = step(first, one, two)
        stages.append({one: changed, two: step(second, two, f"({changed})")})
    return stages


def _staged_numeric(spec: Numeric, x: str, key: str, prefix: str, restore: bool) -> Staged:
    a, b, aux = f"{prefix}a", f"{prefix}b", f"{prefix}u"
    plan = Staged()
    if spec.aux:
        plan.stages.append({aux: spec.aux.format(x=x)})
    plan.stages.append({a: spec.a.format(x=x, aux=aux), b: spec.b.format(x=x, aux=aux)})

    def step(i: int, target: str, other: str) -> str:
        size = f"{spec.size_a if target == a else spec.size_b}L"
        word = _small_word(f"sha2(concat({key}, '{i}0|', {other}), 256)", size)
        return _shifted(target, word, size, restore)

    plan.stages += _round_stages(restore, (a, b), step)
    plan.stages.append({a: _apart(a)})
    plan.result = spec.join.format(x=x, a=a, b=b, aux=aux)
    return plan


def _staged_string(radix: Radix, x: str, key: str, prefix: str, restore: bool) -> Staged:
    others, members, n, left, right, token, place, runs, gaps = (
        prefix + name
        for name in ("others", "members", "n", "l", "r", "token", "place", "runs", "gaps")
    )
    short = f"{n} <= {radix.staged_chars}"
    count = f"cast(length({members}) as int)"
    fits = f"{count} <= {radix.staged_chars}"
    halves = {
        name: {part: f"{prefix}{name}_{part}" for part in ("v", "n", "hi", "lo")} for name in "ab"
    }
    sizes, numbers = {}, {}
    for text, length, half in (
        (left, f"{count} div 2", halves["a"]),
        (right, f"{count} - {count} div 2", halves["b"]),
    ):
        # longer texts leave null halves here: their rounds cost nothing
        sizes[half["n"]] = f"CASE WHEN {fits} THEN {length} END"
        numbers[half["v"]] = radix.number(text)
        numbers[half["hi"]] = radix.power(_apart(f"{half['n']} - {half['n']} div 2"))
        numbers[half["lo"]] = radix.power(f"{half['n']} div 2")
    plan = Staged(
        stages=[
            {others: radix.others(x)},
            {members: radix.members(x, others)},
            {
                n: count,
                left: f"CASE WHEN {fits} THEN substring({members}, 1, {count} div 2) END",
                right: f"CASE WHEN {fits} THEN substring({members}, {count} div 2 + 1, {count}) END",
                **sizes,
            },
            numbers,
        ]
    )

    def step(i: int, target: str, other: str) -> str:
        half = next(h for h in halves.values() if h["v"] == target)
        digest = f"sha2(concat({key}, '{i}', {n}, '|', {other}), 256)"
        word = _large_word(digest, half["hi"], half["lo"])
        return _shifted(target, word, f"{half['hi']} * {half['lo']}", restore)

    plan.stages += _round_stages(restore, (halves["a"]["v"], halves["b"]["v"]), step)
    runs_of = f"[{radix.char_class}]+"
    gapped = f"{short} AND length({others}) > 1"
    spelled = [radix.spelled(half["v"], half["n"]) for half in halves.values()]
    plan.stages.append(
        {
            token: f"concat({', '.join(spelled)})",
            place: f"instr({x}, {others})",
            n: _apart(n),
            runs: f"CASE WHEN {gapped} THEN regexp_extract_all({x}, '{runs_of}', 0) END",
            gaps: f"CASE WHEN {gapped} THEN split({x}, '{runs_of}') END",
        }
    )
    single_gap = f"concat(left({token}, {place} - 1), {others}, substring({token}, {place}, {n}))"
    # few runs: walk them, taking as many token characters as each run is long
    merged = (
        f"aggregate({runs}, named_struct('o', 1, 'g', 2, 't', element_at({gaps}, 1)), "
        f"(s, run) -> named_struct('o', s.o + length(run), 'g', s.g + 1, "
        f"'t', concat(s.t, substring({token}, s.o, length(run)), element_at({gaps}, s.g))), "
        f"s -> s.t)"
    )
    plan.result = (
        f"CASE WHEN {n} > {radix.staged_chars} THEN {_string_single(radix, x, key, restore)} "
        f"WHEN {others} = '' THEN {token} "
        f"WHEN length({others}) = 1 THEN {single_gap} ELSE {merged} END"
    )
    return plan
