"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statlake.llm.common import materialize, size_in_words

BINS = 4096
#: The columns of a decision.
DECISION = ("size", "source_size", "target", "copies", "taken")
#: Hexadecimal digits of the hash that makes a document's uniform number; 16**13 = 2**52.
DIGITS = 13


def _fill(rows: DataFrame, by: list[str], total: Column, cap: Column, weight: Column, name: str) -> DataFrame:
    """Share total by weight among the rows of each group, none above its cap, as column name.

    In ascending order of cap / weight, the rate that the rows from one on would get is highest at the
    first row that stays below its cap; so the highest rate is the one that holds.
    """
    rows = rows.withColumn("_cap", cap.cast("double")).withColumn("_weight", weight.cast("double"))
    order = [F.col("_cap") / F.col("_weight"), *[F.col(c).asc_nulls_last() for c in ("source", "level") if c in rows.columns]]
    ahead = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rest = W.partitionBy(*by).orderBy(*order).rowsBetween(0, W.unboundedFollowing)
    rate = (total - F.coalesce(F.sum("_cap").over(ahead), F.lit(0.0))) / F.sum("_weight").over(rest)
    rows = rows.withColumn("_rate", rate).withColumn("_rate", F.max("_rate").over(W.partitionBy(*by)))
    return rows.withColumn(name, F.least("_cap", F.col("_rate") * F.col("_weight"))).drop("_cap", "_weight", "_rate")


def _measured(docs: DataFrame, seed: int) -> DataFrame:
    """docs with _size (words), level (decimal digits of the size) and _u, a uniform number of the doc_id."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"|{seed}"))
    number = F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("long")
    return (
        docs.withColumn("_size", size_in_words(F.col("text")))
        .withColumn("level", F.length(F.col("_size").cast("string")))
        .withColumn("_u", (number + 0.5) / F.lit(float(16**DIGITS)))
    )


def _place(u: Column, chance: Column) -> Column:
    """The Pareto rank variable q = odds(u) / odds(chance) as q / (1 + q), which orders alike."""
    q = (u / (1 - u)) / (chance / (1 - chance))
    return F.when(chance > 0, q / (1 + q))


def _cells(slim: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """For each (source, level): the source's size and target, certain copies and chance of one more."""
    cells = slim.groupBy("source", "level").agg(F.sum("_size").alias("words"))
    sources = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("_all", F.sum("source_size").over(W.partitionBy()))
    sources = _fill(sources, [], F.col("_all"), max_copies * F.col("source_size"), F.col("weight"), "target")
    sources = materialize(sources.select(F.col("source").alias("_source"), "source_size", "target"))
    cells = cells.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # a level weighs as many times as a size in it has digits; cells without words weigh nothing
    share = F.greatest(F.col("level") * F.col("words"), F.lit(1e-9))
    cells = _fill(cells, ["source"], F.col("target"), max_copies * F.col("words"), share, "allotted")
    mean = F.when(F.col("words") > 0, F.col("allotted") / F.col("words")).otherwise(F.lit(0.0))
    cells = cells.withColumn("mean", mean).withColumn("sure", F.floor("mean"))
    cells = cells.withColumn("chance", F.col("mean") - F.col("sure"))
    left = F.col("target") - F.sum(F.col("sure") * F.col("words")).over(W.partitionBy("source"))
    cells = cells.withColumn("left", left)
    return materialize(
        cells.select(F.col("source").alias("_source"), F.col("level").alias("_level"), "source_size", "target", "sure", "chance", "left")
    )


def _with_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("level") == F.col("_level"))
    return rows.join(cells, same).drop("_source", "_level").withColumn("_p", _place(F.col("_u"), F.col("chance")))


def _first_over(rows: DataFrame, bin_: Column) -> DataFrame:
    """For each source the bin in which its words reach what is left, and what the bins before it hold."""
    bins = rows.groupBy("source", bin_.alias("bin")).agg(F.sum("_size").alias("words"), F.first("left").alias("left"))
    order = W.partitionBy("source").orderBy("bin")
    bins = bins.withColumn("so_far", F.sum("words").over(order))
    bins = bins.filter("so_far >= left").withColumn("at", F.row_number().over(order)).filter("at = 1")
    return materialize(bins.select(F.col("source").alias("_source"), "bin", (F.col("so_far") - F.col("words")).alias("ahead")))


def _cuts(slim: DataFrame, cells: DataFrame) -> DataFrame:
    """For each source the last (place, doc_id) that is taken; sources that take all have no row."""
    rows = _with_cells(slim, cells).filter("_p is not null")
    rows = rows.select("doc_id", "source", "_size", "left", "_p")
    first = _first_over(rows, F.floor(F.col("_p") * BINS))
    same = F.col("source").eqNullSafe(F.col("_source"))
    rows = rows.withColumn("_bin", F.floor(F.col("_p") * BINS)).join(first, same & (F.col("_bin") == F.col("bin")))
    rows = materialize(rows.select("doc_id", "source", "_size", (F.col("left") - F.col("ahead")).alias("left"), "_p"))
    second = _first_over(rows, F.floor(F.col("_p") * BINS * BINS))
    rows = rows.withColumn("_bin", F.floor(F.col("_p") * BINS * BINS)).join(second, same & (F.col("_bin") == F.col("bin")))
    order = W.partitionBy("source").orderBy("_p", F.col("doc_id").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_sum", F.sum("_size").over(order) + F.col("ahead"))
    last = F.struct("_p", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"))
    taken = 2 * F.col("_sum") - F.col("_size") <= 2 * F.col("left")
    # a boundary bin of which nothing is taken: all before it is
    nothing = F.struct((F.col("bin") / (BINS * BINS)).alias("_p"), F.lit(-(1 << 63)).alias("doc_id"))
    return materialize(
        rows.groupBy(F.col("source").alias("_source"))
        .agg(F.coalesce(F.max(F.when(taken, last)), F.first(nothing)).alias("last"), F.count("*").alias("n"))
        .select("_source", F.col("last._p").alias("last_p"), F.col("last.doc_id").alias("last_id"))
    )


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_copies: int = 3, seed: int = 7
) -> DataFrame:
    """Decide how often each document goes into a mix whose sources have target weights.

    docs (doc_id, text, source, ...) -> its own columns and size (words), source_size, target (words
    of its source in the mix), copies, taken (copies * size). Input columns with these names are
    replaced. Sources in code point order, null last, weigh `weights`, repeating; together they get
    as many words as docs holds; none gets more than max_copies times its size, and what is above
    is shared again by weight.

    Within a source, documents weigh as many as their size has decimal digits, none above max_copies.
    Whole expected copies are certain. The rest is a Pareto order sample: documents are ranked by the
    odds of a number hashed from doc_id over the odds of their chance, and taken in that order until
    the source's words come nearest to the target. The cut is found with two histograms, so no source
    is ever gathered in one task; decisions are a function of the row and small tables, so reruns
    agree and no text is shuffled.

    Null and blank texts have size 0: they weigh nothing and are taken with 0 words. Rows that repeat
    a doc_id share its number and are decided alike. An empty table gives an empty result.
    """
    # the input's columns travel under names that no working column has
    own = {f"__own{i}": c for i, c in enumerate(docs.columns) if c not in DECISION}
    docs = docs.select("doc_id", "text", "source", *[docs[f"`{c}`"].alias(x) for x, c in own.items()])
    slim = materialize(_measured(docs, seed).select(F.col("doc_id").cast("long").alias("doc_id"), "source", "_size", "level", "_u"))
    cells = _cells(slim, weights, max_copies)
    cuts = _cuts(slim, cells)
    decided = _decided(_measured(docs, seed), cells, cuts)
    return decided.select(*[F.col(x).alias(c) for x, c in own.items()], *DECISION)


def mix_decisions(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_copies: int = 3, seed: int = 7
) -> DataFrame:
    """mix_sources without the texts: doc_id, source and the decision, from one pass over the texts."""
    slim = materialize(_measured(docs, seed).select(F.col("doc_id").cast("long").alias("doc_id"), "source", "_size", "level", "_u"))
    cells = _cells(slim, weights, max_copies)
    return _decided(slim, cells, _cuts(slim, cells))


def _decided(rows: DataFrame, cells: DataFrame, cuts: DataFrame) -> DataFrame:
    rows = _with_cells(rows, cells)
    rows = rows.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left")
    here = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    more = (F.col("_p") < F.col("last_p")) | ((F.col("_p") == F.col("last_p")) & (here <= F.col("last_id")))
    more = F.col("_p").isNotNull() & F.coalesce(more, F.lit(True))
    rows = rows.withColumn("copies", (F.col("sure") + more.cast("int")).cast("int"))
    return rows.withColumnRenamed("_size", "size").withColumn("taken", F.col("copies") * F.col("size")).drop(
        "level", "_u", "_p", "sure", "chance", "left", "_source", "last_p", "last_id"
    )
