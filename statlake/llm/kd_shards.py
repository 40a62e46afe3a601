"""Shards of near equal bytes by a k-d tree over metadata, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statlake.llm.common import materialize

#: Bytes that a row costs besides its text.
ROW_BYTES = 16
#: Histogram bins for each node and round; nodes * BINS rows reach the driver.
BINS = 256
#: Equal texts stay in one shard unless together they have more than this share of a shard.
WHOLE_GROUP = 0.05
#: Rows that one task numbers.
BLOCK_ROWS = 10_000

#: Every dimension is mapped to 0 .. 2**31 - 1; the text's hash follows in the low bits.
_SPAN = (1 << 31) - 1
#: doc_id as an unsigned order: shifted to 0 .. 2**63 - 1 by dropping its lowest bit.
_ID_SPAN = (1 << 63) - 1


@dataclass
class _Node:
    """Rows of shards first .. first + n - 1; a leaf has one shard."""

    first: int
    n: int
    column: str | None = None
    cut: int = 0
    id_cut: int = 0
    left: _Node | None = None
    right: _Node | None = None


def _below(node: _Node) -> Column:
    here = F.col(node.column)
    return (here < F.lit(node.cut)) | ((here == F.lit(node.cut)) & (F.col("_id") < F.lit(node.id_cut)))


def _shard(node: _Node) -> Column:
    if node.left is None:
        return F.lit(node.first)
    return F.when(_below(node), _shard(node.left)).otherwise(_shard(node.right))


def _leaves(node: _Node) -> list[_Node]:
    return [node] if node.left is None else _leaves(node.left) + _leaves(node.right)


def _histogram(rows: DataFrame, dims: list[str], ranges: dict[int, tuple]) -> dict[int, list]:
    """For each node the bins (number, bytes, least and greatest key) of its range lo .. hi of a column.

    A range may hold for one key of another column only. The ranges come as a table of one row a node.
    """
    columns = [*dims, "_id"]
    values = ", ".join(
        f"({node}, {columns.index(c) + 1}, {lo}L, {hi}L, {max(1, -(-(hi - lo + 1) // BINS))}L, "
        + ("null, cast(null as bigint))" if only is None else f"{columns.index(only[0]) + 1}, {only[1]}L)")
        for node, (c, lo, hi, only) in ranges.items()
    )
    table = rows.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(_node, _c, _lo, _hi, _wide, _oc, _ov)")
    keys = F.array(*columns)
    rows = rows.join(F.broadcast(table), "_node").withColumn("key", F.element_at(keys, F.col("_c")))
    rows = rows.filter(F.col("key").between(F.col("_lo"), F.col("_hi")))
    rows = rows.filter(F.col("_oc").isNull() | (F.element_at(keys, F.coalesce("_oc", F.lit(1))) == F.col("_ov")))
    rows = rows.select("_node", F.expr("(key - _lo) div _wide").alias("bin"), "key", "size")
    found: dict[int, list] = {node: [] for node in ranges}
    bins = rows.groupBy("_node", "bin").agg(F.sum("size").alias("b"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    for r in bins.collect():
        found[r["_node"]].append((r["bin"], r["b"], r["lo"], r["hi"]))
    return {node: sorted(own) for node, own in found.items()}


def _quantiles(rows: DataFrame, dims: list[str], wanted: dict[int, tuple]) -> dict[int, tuple[int, float, int]]:
    """For each node the key at which the bytes in key order pass a weight: (key, bytes before, its bytes).

    The bin that holds the weight is cut again until it holds a single key.
    """
    done, open_ = {}, {node: (c, lo, hi, only, w, 0.0) for node, (c, lo, hi, only, w) in wanted.items()}
    while open_:
        bins = _histogram(rows, dims, {node: x[:4] for node, x in open_.items()})
        for node, (column, _, _, only, weight, before) in list(open_.items()):
            for _, size, lo, hi in bins[node]:
                if before + size >= weight:
                    break
                before += size
            else:
                before -= size if bins[node] else 0
            if not bins[node]:
                done[node] = (0, 0.0, 0)
            elif lo == hi:
                done[node] = (lo, before, size)
            else:
                open_[node] = (column, lo, hi, only, weight, before)
                continue
            del open_[node]
    return done


def _grow(rows: DataFrame, dims: list[str], shards: int) -> _Node:
    root = _Node(0, shards)
    widest = rows.agg(*[F.min(c).alias(f"lo_{c}") for c in dims], *[F.max(c).alias(f"hi_{c}") for c in dims]).first()
    span = {c: max(1, ((widest[f"hi_{c}"] or 0) >> 31) - ((widest[f"lo_{c}"] or 0) >> 31)) for c in dims}
    while open_ := {x.first: x for x in _leaves(root) if x.n > 1}:
        placed = rows.withColumn("_node", _shard(root))
        extents = {
            r["_node"]: r
            for r in placed.groupBy("_node")
            .agg(F.sum("size").alias("bytes"), *[F.min(c).alias(f"lo_{c}") for c in dims], *[F.max(c).alias(f"hi_{c}") for c in dims])
            .collect()
        }
        wanted = {}
        for first, node in open_.items():
            node.column, node.left, node.right = dims[0], _Node(first, node.n // 2), _Node(first + node.n // 2, node.n - node.n // 2)
            if r := extents.get(first):
                node.column = max(dims, key=lambda c: ((r[f"hi_{c}"] >> 31) - (r[f"lo_{c}"] >> 31)) / span[c])
                weight = r["bytes"] * node.left.n / node.n
                wanted[first] = (node.column, r[f"lo_{node.column}"], r[f"hi_{node.column}"], None, weight)
        cuts = _quantiles(placed, dims, wanted)
        split = {}
        for first, (key, before, size) in cuts.items():
            node, weight = open_[first], wanted[first][-1]
            if size > WHOLE_GROUP * extents[first]["bytes"] / node.n:
                split[first] = (key, weight - before)
            else:
                node.cut = key + (2 * (weight - before) > size)
        for first, (id_cut, before, size) in _quantiles(
            placed, dims, {k: ("_id", 0, _ID_SPAN, (open_[k].column, cut), w) for k, (cut, w) in split.items()}
        ).items():
            node = open_[first]
            node.cut, node.id_cut = split[first][0], id_cut + (2 * (split[first][1] - before) > size)
    return root


def kd_shards(docs: DataFrame, shards: int = 40, dims: dict[str, Column] | None = None) -> DataFrame:
    """Put documents (doc_id, text, ...) into shards of near equal bytes.

    Returns doc_id, size (UTF-8 bytes of the text, plus 16), text_crc32, law ('bytes'), shard, slot
    (gapless from 0 in each shard) and grown_shard (null: this law moves rows when shards are added).

    A node of the tree holds several shards; it is cut along its widest dimension, where widths are
    shares of the table's, at the key where bytes in key order reach its left half's share. Keys are
    a dimension's number (0 .. 2**31 - 1) and then a hash of the text, so equal texts stay together
    unless together they exceed a twentieth of a shard; such groups are cut by doc_id. dims
    names the dimensions; the default ones are the logarithm of the size, the language and the bytes
    per character. The cut of every node of a level is found by histograms of at most shards *
    BINS rows; only those reach the driver. Slots are counted by blocks, not by a sort of a shard.

    Null texts have 16 bytes and the checksum of the empty text; a null dimension counts as 0; a
    null doc_id comes first. Rows that repeat a doc_id and text are kept and stay together.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.octet_length(text) + F.lit(ROW_BYTES)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    dims = dims or {
        "log_bytes": F.log2(size.cast("double")) / 40 * _SPAN,
        "lang": F.xxhash64(lang).bitwiseAND(F.lit(_SPAN)),
        "bytes_per_char": (F.octet_length(text) / F.greatest(F.char_length(text), F.lit(1))) / 5 * _SPAN,
    }
    low = F.xxhash64(text).bitwiseAND(F.lit(_SPAN))
    keys = [
        (F.shiftleft(F.least(F.greatest(F.coalesce(d.cast("long"), F.lit(0)), F.lit(0)), F.lit(_SPAN)).cast("long"), 31).bitwiseOR(low)).alias(f"_k{i}")
        for i, d in enumerate(dims.values())
    ]
    doc_id = F.col("doc_id").cast("long")
    # the order of doc_id as a number from 0: its halves shifted by half of the range
    unsigned = F.shiftright(F.coalesce(doc_id, F.lit(-(1 << 63))), 1) + F.lit(1 << 62)
    rows = materialize(
        docs.select(doc_id.alias("doc_id"), size.cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), unsigned.alias("_id"), *keys)
    )
    columns = [f"_k{i}" for i in range(len(dims))]
    tree = _grow(rows, columns, shards)
    blocks = max(1, -(-rows.count() // (shards * BLOCK_ROWS)))
    placed = rows.withColumn("shard", _shard(tree).cast("int"))
    placed = placed.withColumn("_block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks)).cast("int"))
    counts = placed.groupBy("shard", "_block").agg(F.count("*").alias("n"))
    ahead = W.partitionBy("shard").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    counts = materialize(counts.select("shard", "_block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_ahead")))
    own = W.partitionBy("shard", "_block").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32")
    placed = placed.withColumn("_rank", F.row_number().over(own)).join(counts, ["shard", "_block"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_ahead") + F.col("_rank") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
