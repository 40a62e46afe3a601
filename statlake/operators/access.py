"""Access rules: which datasets a user may read or write.

A grant covers a path prefix that ends at a segment border (``/a`` covers ``/a`` and ``/a/b``, not
``/ab``; the empty prefix covers all), a privilege, valuations up to a limit, and a list of states
(null = any).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.paths import ancestors, ancestors_of

# Valuations from least to most sensitive, and lifecycle states.
VALUATIONS = ("OPEN", "INTERNAL", "SHIELDED", "SENSITIVE")
STATES = ("RAW", "INPUT", "PROCESSED", "OUTPUT", "PRODUCT", "OTHER")
PRIVILEGES = ("READ", "WRITE")


def valuation_rank(valuation: Column) -> Column:
    return F.array_position(F.array(*[F.lit(v) for v in VALUATIONS]), valuation)


def _covers(valuation: Column, state: Column) -> Column:
    return (valuation_rank(valuation) <= valuation_rank(F.col("max_valuation"))) & (
        F.col("states").isNull() | F.array_contains(F.col("states"), state)
    )


# Grants of one user that are tested inside the row; more are met by joins.
IN_ROW = 10_000


def accessible(catalog: DataFrame, grants: DataFrame, user: str, privilege: str = "READ") -> DataFrame:
    """Catalog rows that a grant of the user covers.

    A user's grants are few: they become one map from prefix to what it grants, a scalar that is
    looked up with the row's own ancestors, so no catalog row moves and none comes out twice. More
    than ``IN_ROW`` of them, which only a count of the user's rows can tell, take the joins of
    ``_accessible_by_joins``.
    """
    mine = (
        grants.filter((F.col("user") == user) & (F.col("privilege") == privilege))
        .select("path_prefix", "max_valuation", "states")
        .distinct()
    )
    if mine.limit(IN_ROW + 1).count() > IN_ROW:
        return _accessible_by_joins(catalog, mine)
    by_prefix = mine.groupBy("path_prefix").agg(F.collect_list(F.struct("max_valuation", "states")).alias("given"))
    entries = F.collect_list(F.struct("path_prefix", "given"))
    given = by_prefix.agg(F.map_from_entries(entries).alias("m")).scalar()

    def grants_it(g: Column) -> Column:
        return (valuation_rank(F.col("valuation")) <= valuation_rank(g["max_valuation"])) & (
            g["states"].isNull() | F.array_contains(g["states"], F.col("state"))
        )

    # lambdas may hold no subquery, so the map is a column of its own until the filter is done
    keyed = catalog.withColumn("__given", given)
    covered = F.exists(
        ancestors(F.col("path")),
        lambda prefix: F.exists(F.coalesce(F.try_element_at(F.col("__given"), prefix), F.array()), grants_it),
    )
    return keyed.filter(covered).drop("__given")


def _accessible_by_joins(catalog: DataFrame, mine: DataFrame) -> DataFrame:
    """The same for any number of grants: each distinct (path, valuation, state) is met with the grants
    by its ancestors, and the catalog keeps the rows whose combination is covered."""
    kinds = catalog.select("path", "valuation", "state").distinct()
    keyed = kinds.withColumn("ancestor", F.explode(ancestors(F.col("path"))))
    condition = (F.col("ancestor") == F.col("path_prefix")) & _covers(F.col("valuation"), F.col("state"))
    hits = keyed.join(mine, condition, "left_semi").select("path", "valuation", "state").distinct()
    same = (
        (F.col("c.path") == F.col("h.path"))
        & (F.col("c.valuation") == F.col("h.valuation"))
        & F.col("c.state").eqNullSafe(F.col("h.state"))
    )
    return catalog.alias("c").join(hits.alias("h"), same, "left_semi").select(*catalog.columns)


def may_access(
    grants: DataFrame, user: str, path: str, privilege: str, valuation: str, state: str
) -> bool:
    """Whether one dataset is covered: a filter on the few possible prefixes, no join."""
    hits = grants.filter(
        (F.col("user") == user)
        & (F.col("privilege") == privilege)
        & F.col("path_prefix").isin(ancestors_of(path))
        & _covers(F.lit(valuation), F.lit(state))
    )
    return not hits.isEmpty()
