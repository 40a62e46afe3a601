"""Pseudonymize and restore columns of a DataFrame, batch or streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.errors import PolicyError
from statlake.functions import cipher
from statlake.functions.cipher_arrow import sql_function
from statlake.functions.policy import UNDEFINED, parse_declaration, parse_policy

Policy = str | Mapping[str, str] | list[tuple[str, str]]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column_names(df: DataFrame) -> Callable[[str], str]:
    """How the session resolves a name to one of the columns; names of none come back as they are."""
    exact = set(df.columns)
    caseless = df.sparkSession.conf.get("spark.sql.caseSensitive") != "true"
    spelled = {c.lower(): c for c in df.columns} if caseless else {}
    return lambda name: name if name in exact else spelled.get(name.lower(), name)


def resolve_function(function: str) -> tuple[str, str]:
    """``(alphabet, key id)`` of a function declaration."""
    name, args = parse_declaration(function)
    if name not in cipher.PRESETS:
        raise PolicyError(f"no pseudonymization function '{name}' is defined")
    if len(args) != 1:
        raise PolicyError(f"'{name}' takes exactly one argument, the key id; got {args}")
    return cipher.PRESETS[name], args[0]


def _key_frame(spark: SparkSession, derived: list[str]) -> DataFrame:
    """One row of derived keys. A local relation shows only its column names in plans, so
    neither explain output nor event logs hold key material."""
    return spark.createDataFrame(
        pa.table({f"k{i}": pa.array([key], pa.string()) for i, key in enumerate(derived)})
    )


def pseudonymize(df: DataFrame, policy: Policy, keys: Mapping[str, str]) -> DataFrame:
    """Replace the columns a policy lists by keyed, deterministic, restorable tokens.

    ``policy`` is an option text (``col=fpe-digits(key1);…``), a mapping or a list of pairs;
    ``keys`` maps key ids to secrets. Rows are never moved: the result is a chain of projections.
    """
    return _transform(df, policy, keys, restore=False)


def depseudonymize(df: DataFrame, policy: Policy, keys: Mapping[str, str]) -> DataFrame:
    """The inverse of ``pseudonymize`` for the same policy and keys."""
    return _transform(df, policy, keys, restore=True)


def _transform(
    df: DataFrame, policy: Policy, keys: Mapping[str, str], restore: bool
) -> DataFrame:
    spark = df.sparkSession
    mappings = parse_policy(policy) if isinstance(policy, str) else list(dict(policy).items())
    if not mappings:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    derived: dict[str, str] = {}
    plans: dict[str, cipher.Staged] = {}
    same = column_names(df)
    for var, function in mappings:
        var = same(var)
        if var not in types:
            raise PolicyError(f"the policy names column '{var}', which the data does not have")
        if function == UNDEFINED:
            raise PolicyError(f"column '{var}' has no pseudonymization function")
        alphabet, key_id = resolve_function(function)
        if key_id not in keys:
            raise PolicyError(f"no key '{key_id}' is known")
        kind = cipher.type_name(types[var])
        key = cipher.derive_key(keys[key_id], cipher.key_domain(kind, alphabet))
        key_column = derived.setdefault(key, f"__key{len(derived)}")
        plans[var] = cipher.staged(
            kind, alphabet, quoted(var), key_column, f"__fpe{len(plans)}_", restore
        )

    key_frame = _key_frame(spark, list(derived))
    frame = df.withColumns(
        {name: key_frame.select(f"k{i}").scalar() for i, name in enumerate(derived.values())}
    )
    # one projection for each stage of all columns; Spark prunes working columns that no later stage reads
    for k in range(max(len(plan.stages) for plan in plans.values())):
        made = {name: F.expr(text) for plan in plans.values() for name, text in plan.at(k).items()}
        frame = frame.withColumns(made)
    tokens = [F.expr(plan.result).alias(f"__token{i}") for i, plan in enumerate(plans.values())]
    frame = frame.select(*[F.col(quoted(c)) for c in df.columns if c not in plans], *tokens)
    # Spark moves a filter below projections by writing their expressions into it, and every round
    # uses the one before twice: a filter or join on a token would repeat the rounds hundreds of
    # times. It moves no filter on a generated column below its generator, so each token depends on
    # one, the constant that a generator of one row makes; filters on all other columns still reach
    # the scan, and columns that nobody asks for are pruned below the generator, ciphers and all.
    frame = frame.select("*", F.explode(F.array(F.lit(True))).alias("__once"))
    shown = {var: F.when(F.col("__once"), F.col(f"__token{i}")).alias(var) for i, var in enumerate(plans)}
    return frame.select(*[shown[c] if c in shown else F.col(quoted(c)) for c in df.columns])


def function_name(declaration: str, restore: bool, type_name: str) -> str:
    """The SQL name of a typed function, for example
    ``pseudo_fpe-digits(key1)_apply_string_udf``."""
    direction = "restore" if restore else "apply"
    return f"pseudo_{declaration}_{direction}_{type_name}_udf".lower()


def register_functions(
    spark: SparkSession, declarations: list[str], keys: Mapping[str, str]
) -> list[str]:
    """Register every declaration as temporary SQL functions, one for each of the eight types and
    both directions, and return their names. Call them in SQL with back quotes.

    They are vectorized Python functions whose closures hold derived keys, so that a session that may
    call them sees no key anywhere.
    """
    names = []
    for text in declarations:
        base, args = parse_declaration(text)
        alphabet, key_id = resolve_function(text)
        if key_id not in keys:
            raise PolicyError(f"no key '{key_id}' is known")
        canonical = f"{base}({','.join(args)})"
        for kind in cipher.TYPE_NAMES:
            key = cipher.derive_key(keys[key_id], cipher.key_domain(kind, alphabet))
            for restore in (False, True):
                name = function_name(canonical, restore, kind)
                spark.udf.register(name, sql_function(kind, alphabet, key, restore))
                names.append(name)
    return names


def tokens_of(
    spark: SparkSession, data_type: T.DataType, function: str, values: list, keys: Mapping[str, str]
) -> list:
    """The tokens that a function makes of constants of a type, for predicates on stored columns."""
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", data_type)])
    rows = spark.createDataFrame(list(enumerate(values)), schema).coalesce(1)
    made = pseudonymize(rows, [("x", function)], keys).collect()
    return [r["x"] for r in sorted(made, key=lambda r: r["i"])]
