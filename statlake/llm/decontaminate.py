"""Documents that hold benchmark passages, by spaced seeds, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import BLANK, materialize

#: Word positions that a seed reads. Any WINDOW words with at most WINDOW - LEAST substitutions
#: hold one of these seeds without a substitution, so no overlap is missed.
MASKS = ((0, 1, 3, 6, 7, 8), (0, 1, 2, 5, 6, 8))
SPAN = 9
WINDOW, LEAST = 13, 11
#: Benchmark words whose seeds are broadcast at once (two seeds of 40 bytes each for a word: 40 MB).
BLOCK_WORDS = 500_000
#: Alignments of one document that are compared by one row.
LINES = 1024


def _words(text: Column) -> Column:
    edges = F.lit(" \t\n\u000b\f\r")
    return F.split(F.btrim(F.lower(F.coalesce(text.cast("string"), F.lit(""))), edges), BLANK)


def _seeds(rows: DataFrame, words: str, *keep: str) -> DataFrame:
    """Rows (keep, pos, seed): each mask's hash at each word position from 0."""
    hashed = F.transform(F.col(words), lambda w: F.xxhash64(w))
    rows = rows.select(*keep, hashed.alias("_w")).withColumn("_n", F.size("_w") - (SPAN - 1))

    def of(mask: int) -> Column:
        read = lambda i: F.xxhash64(F.lit(mask), *[F.get(F.col("_w"), i + o) for o in MASKS[mask]])
        return F.transform(F.sequence(F.lit(0), F.col("_n") - 1), read)

    # no filter on the arrays: Spark would push it down and work them out again for every element
    both = F.when(F.col("_n") > 0, F.concat(*map(of, range(len(MASKS)))))
    rows = rows.select(*keep, "_n", F.posexplode_outer(both).alias("_at", "seed"))
    return rows.select(*keep, F.pmod(F.col("_at"), F.col("_n")).alias("pos"), "seed").filter("seed is not null")


def _wholes(rows: DataFrame, words: str, lengths: list[int], *keep: str) -> DataFrame:
    """Rows (keep, pos, length, seed): the hash of the words at each position, of each of a few lengths."""
    hashed = F.transform(F.col(words), lambda w: F.xxhash64(w))
    rows = rows.select(*keep, hashed.alias("_w"))

    def of(n: int) -> Column:
        read = lambda i: F.xxhash64(F.lit(n), *[F.get(F.col("_w"), i + o) for o in range(n)])
        places = F.when(F.size("_w") >= n, F.sequence(F.lit(0), F.size("_w") - n))
        return F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda i: F.struct(i.alias("pos"), F.lit(n).alias("length"), read(i).alias("seed")))

    return rows.select(*keep, F.explode(F.concat(*map(of, lengths))).alias("_x")).select(*keep, "_x.*")


def _overlaps(rows: DataFrame) -> DataFrame:
    """Of aligned word lists (mine, theirs) those with a window of enough equal words."""
    same = F.zip_with("mine", "theirs", lambda x, y: (x == y).cast("int"))
    rows = rows.withColumn("_same", same).withColumn("_wide", F.least(F.lit(WINDOW), F.size("words")))
    # an item shorter than a window must agree in all its words
    least = F.when(F.col("_wide") < WINDOW, F.col("_wide")).otherwise(F.lit(LEAST))
    count = lambda i: F.aggregate(F.slice(F.col("_same"), i, F.col("_wide")), F.lit(0), lambda s, x: s + x)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    counts = F.transform(upto(F.size("_same") - F.col("_wide") + 1), count)
    rows = rows.withColumn("_counts", counts).withColumn("_least", least)
    rows = rows.withColumn("_good", F.filter(upto(F.size("_counts")), lambda i: F.get(F.col("_counts"), i - 1) >= F.col("_least")))
    rows = rows.filter(F.size("_good") > 0)
    first, last = F.get("_good", F.lit(0)), F.element_at("_good", -1)
    return rows.select(
        "doc_id",
        "key",
        "item_id",
        (F.col("start") + first - 1).alias("start"),
        (last - first + F.col("_wide")).alias("words"),
        F.aggregate(F.slice("_same", first, last - first + F.col("_wide")), F.lit(0), lambda s, x: s + x).alias("matches"),
    )


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Overlaps of documents (doc_id, text) with benchmark items (item_id, text).

    One row (doc_id, item_id, start, words, matches) for each alignment of a document with an item in
    which WINDOW consecutive words agree in at least LEAST places: the word position in the document
    of the first such window, the words up to the end of the last one, and how many of them agree.
    Words are lower-cased runs between ASCII blanks. Items of fewer than WINDOW words must agree in all
    words, in order, down to items of one word; null and blank ones match nothing. Items with equal texts are one,
    with the smallest item_id; a null item_id is -1. Documents without words overlap with nothing; a
    null doc_id is kept as null and its rows are told apart by their text.

    Seeds of all word positions meet the seeds of the items in a broadcast join; items of fewer than SPAN
    words meet the hashes of all runs of their length instead. Items come in blocks
    of at most BLOCK_WORDS words, so the broadcast is bounded however large the benchmark is. Only
    the alignments around hits are compared word by word.
    """
    return _found(docs, benchmark).drop("key").distinct()


def _row_key() -> Column:
    """Tells rows apart: the id, which may be null or repeated, and the text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The overlaps, each with the key of its row."""
    words = _words(F.col("text"))
    items = (
        benchmark.filter("text is not null")
        .groupBy(words.alias("words"))
        .agg(F.coalesce(F.min(F.col("item_id").cast("long")), F.lit(-1)).alias("item_id"))
        .filter(F.get("words", F.lit(0)) != "")
        .withColumn("item", F.xxhash64("words"))
    )
    items = materialize(items)
    blocks = max(1, -(-(items.agg(F.sum(F.size("words"))).first()[0] or 0) // BLOCK_WORDS))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # repeated and null ids are told apart by their texts
    texts = texts.withColumn("key", _row_key())
    # lengths of short items, at most SPAN - 1 numbers
    short = sorted(r[0] for r in items.select(F.size("words")).filter(F.size("words") < SPAN).distinct().collect())
    found = []
    for b in range(blocks):
        block = items.filter(F.pmod("item", F.lit(blocks)) == b)
        seeds = _seeds(block.withColumn("length", F.size("words")), "words", "item", "length")
        seeds = seeds.withColumnRenamed("pos", "item_pos")
        mine = texts.select("key", _words(F.col("text")).alias("words"))
        hits = _seeds(mine, "words", "key").join(F.broadcast(seeds), "seed")
        lines = hits.select("key", "item", "length", (F.col("pos") - F.col("item_pos")).alias("line"))
        if short:
            wholes = _wholes(block.filter(F.size("words") < SPAN), "words", short, "item", "words")
            wholes = wholes.filter(F.col("length") == F.size("words")).select("item", "length", "seed")
            hits = _wholes(mine, "words", short, "key").join(F.broadcast(wholes), ["length", "seed"])
            lines = lines.unionByName(hits.select("key", "item", "length", F.col("pos").alias("line")))
        lines = materialize(lines.distinct())
        parts = lines.groupBy("key").agg(F.ceil(F.count("*") / LINES).cast("long").alias("parts"))
        lines = lines.join(parts, "key").groupBy("key", F.pmod(F.xxhash64("item", "line"), "parts").alias("part"))
        lines = materialize(lines.agg(F.collect_list(F.struct("item", "length", "line")).alias("lines")))
        near = texts.join(lines, "key").withColumn("_words", _words(F.col("text")))

        def cut(x: Column) -> Column:
            start = F.greatest(x["line"], F.lit(0))
            mine = F.slice(F.col("_words"), start + 1, x["length"] - F.greatest(-x["line"], F.lit(0)))
            return F.struct(x["item"].alias("item"), x["line"].alias("line"), start.alias("start"), mine.alias("mine"))

        cuts = near.select("doc_id", "key", F.explode(F.transform("lines", cut)).alias("x")).select("doc_id", "key", "x.*")
        pairs = cuts.join(F.broadcast(block), "item")
        theirs = F.slice(F.col("words"), F.greatest(-F.col("line"), F.lit(0)) + 1, F.size("mine"))
        found.append(_overlaps(pairs.withColumn("theirs", theirs)).distinct())
    return reduce(DataFrame.unionByName, found)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each row of docs doc_id, contaminated, n_items, first_item_id (null if none) and overlaps.

    overlaps lists (item_id, start, words, matches) in order of item_id and start. Rows that repeat a
    doc_id share the overlaps of all of them; a row with a null doc_id has those of its own text.
    """
    own = F.when(F.col("doc_id").isNull(), F.col("key")).alias("own")
    found = _found(docs, benchmark).select("doc_id", own, "item_id", "start", "words", "matches")
    found = found.groupBy("doc_id", "own").agg(
        F.countDistinct("item_id").cast("int").alias("n_items"),
        F.min("item_id").alias("first_item_id"),
        F.sort_array(F.collect_set(F.struct("item_id", "start", "words", "matches"))).alias("overlaps"),
    )
    found = materialize(found).withColumnsRenamed({"doc_id": "_doc", "own": "_own"})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("doc_id").isNull(), _row_key()).alias("own"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("own").eqNullSafe(F.col("_own")), "left")
    return rows.select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "first_item_id",
        "overlaps",
    )
