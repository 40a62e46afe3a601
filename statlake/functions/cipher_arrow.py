"""The ciphers of ``statlake.functions.cipher`` as vectorized functions for SQL.

A SQL function has no place for a secret but its text, its arguments or something that has a name, and
whoever may call it can read all three. These functions hold their key in a closure that goes to the
workers with the code: neither plans nor descriptions of functions, views or variables show it.
Tokens are those of the column expressions, which stay the fast path for DataFrames: here each
distinct value of a batch costs some microseconds in Python.
"""

from __future__ import annotations

import hashlib
import struct
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from statlake.functions import cipher

_SQL_TYPES = {
    "string": "string",
    "long": "bigint",
    "integer": "int",
    "double": "double",
    "float": "float",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
}
# Values whose tokens a worker remembers.
_REMEMBERED = 100_000


def sql_function(kind: str, alphabet: str, key: str, restore: bool):
    """A function of one column that enciphers or restores values of a type."""
    # workers need not have this package: the code goes with the function
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rounds, block = cipher.ROUNDS, cipher.Radix(alphabet).block
    one = _one(kind, alphabet, block, key, rounds, restore)
    known: dict = {}

    def tokens(values: pa.Array) -> pa.Array:
        plain, back = _plain(values, kind)
        coded = plain.dictionary_encode()
        if len(known) > _REMEMBERED:
            known.clear()
        made = []
        for value in coded.dictionary.to_pylist():
            if value not in known or kind in ("double", "float"):  # 0.0 and -0.0 are one key
                known[value] = one(value)
            made.append(known[value])
        return back(pa.array(made, plain.type).take(coded.indices))

    return F.arrow_udf(tokens, _SQL_TYPES[kind])


def _plain(values: pa.Array, kind: str) -> tuple[pa.Array, Callable[[pa.Array], pa.Array]]:
    """Values as strings or numbers, and the way back: dates as days, timestamps as microseconds."""
    if kind == "date":
        return values.cast(pa.int32()), lambda made: made.cast(pa.date32())
    if kind == "timestamp":
        zoned = pa.timestamp("us", tz=values.type.tz)
        return values.cast(zoned).cast(pa.int64()), lambda made: made.cast(zoned)
    return values, lambda made: made


def _word(digest: str, seed: int, modulus: int) -> int:
    """A number below the modulus, as the SQL function xxhash64(seed, digest) makes it."""
    import xxhash

    start = xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=42)
    value = xxhash.xxh64_intdigest(digest.encode(), seed=start)
    return (value - (1 << 64) if value >> 63 else value) % modulus


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _order(rounds: int, restore: bool) -> list[int]:
    return list(reversed(range(rounds))) if restore else list(range(rounds))


def _one(kind: str, alphabet: str, block: int, key: str, rounds: int, restore: bool) -> Callable:
    """The cipher of one value."""
    order, sign = _order(rounds, restore), -1 if restore else 1

    def numbers(a: int, b: int, size_a: int, size_b: int) -> tuple[int, int]:
        for i in order:
            if i % 2 == 0:
                a = (a + sign * _word(_sha(f"{key}{i}0|{b}"), 1, size_a)) % size_a
            else:
                b = (b + sign * _word(_sha(f"{key}{i}0|{a}"), 1, size_b)) % size_b
        return a, b

    def split(value: int, size_a: int, size_b: int) -> int:
        a, b = numbers(value // size_b, value % size_b, size_a, size_b)
        return a * size_b + b

    def integer(x):
        return split(x + (1 << 31), 1 << 16, 1 << 16) - (1 << 31)

    def long(x):
        value = split(x % (1 << 64), 1 << 32, 1 << 32)
        return value - (1 << 64) if value >> 63 else value

    def mantissa(form: str, whole: str, bits: int, most: int):
        def real(x):
            raw = struct.unpack(whole, struct.pack(form, x))[0]
            exponent = raw >> bits & most
            if exponent in (0, most):  # zero, subnormal, infinite or no number
                return x
            low = bits // 2
            made = split(raw & (1 << bits) - 1, 1 << bits - low, 1 << low)
            return struct.unpack(form, struct.pack(whole, raw >> bits << bits | made))[0]

        return real

    def boolean(x):
        import xxhash

        return x != bool(xxhash.xxh64_intdigest(_sha(key).encode(), seed=42) & 1)

    def placed(what: str, least: int, size_a: int, size_b: int):
        def moment(x):
            if not 0 <= x - least < size_a * size_b:
                raise ValueError(f"{what} outside the range that can be pseudonymized")
            return split(x - least, size_a, size_b) + least

        return moment

    def string(x):
        codes = [at for c in x if (at := alphabet.find(c)) >= 0]
        n, r = len(codes), len(alphabet)
        if not n:
            return x
        halves = []
        for part in (codes[: n // 2], codes[n // 2 :]):
            blocks = [part[i : i + block] for i in range(0, len(part), block)] or [[]]
            entries = []
            for own in blocks:
                value = 0
                for c in own:
                    value = value * r + c
                entries.append([value, r ** (len(own) - len(own) // 2), r ** (len(own) // 2), len(own)])
            halves.append(entries)
        for i in order:
            target, other = halves[i % 2], halves[1 - i % 2]
            first = _sha(f"{key}{i}{n}|" + ",".join(str(e[0]) for e in other))
            for j, entry in enumerate(target):
                digest = first if j == 0 else _sha(f"{first}|{j}")
                high, low = entry[1], entry[2]
                word = _word(digest, 1, high) * low + _word(digest, 2, low)
                entry[0] = (entry[0] + sign * word) % (high * low)
        made = []
        for value, _, _, size in (*halves[0], *halves[1]):
            digits = []
            for _ in range(size):
                value, digit = divmod(value, r)
                digits.append(alphabet[digit])
            made += reversed(digits)
        following = iter(made)
        return "".join(next(following) if c in alphabet else c for c in x)

    days, day = 2127 * 1717, 86_400_000_000
    return {
        "string": string,
        "integer": integer,
        "long": long,
        "double": mantissa("<d", "<Q", 52, 2047),
        "float": mantissa("<f", "<I", 23, 255),
        "boolean": boolean,
        "date": placed("date", -719_162, 2127, 1717),
        "timestamp": placed("timestamp", -719_162 * day, days, day),
    }[kind]
