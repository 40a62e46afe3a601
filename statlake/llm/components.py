"""Connected components by alternating stars, every round written to a shared table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import let_go, materialize


def _stars(edges: DataFrame) -> bool:
    """Whether the edges (a > b) are disjoint stars: no a has two edges or is the b of another one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not odd.agg(F.max((F.col("up") > 1) | (F.col("up") + F.col("down") > 1))).first()[0]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def contract(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """Edges (a, b) with the components of links (a, b), as stars around each smallest id.

    A node with many links is met by a pre-aggregated minimum and a plain join, whose skewed
    partitions adaptive execution splits. With `rounds`, no more rounds than that: the components
    are the same, but may not be stars yet.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b"))
    done = 0
    while done != rounds and not _stars(edges):
        before, edges = edges, materialize(_small_star(_large_star(edges)).distinct())
        let_go(before)
        done += 1
    return edges


def labels(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of stars; of edges that are no stars yet, the least neighbour."""
    ends = edges.select(F.col("a").alias("node"), "b").unionByName(edges.select(F.col("b").alias("node"), "b"))
    return ends.groupBy("node").agg(F.min("b").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of long ids -> (node, component): every linked node with its smallest reachable id."""
    return labels(contract(links))
