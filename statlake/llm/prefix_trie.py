"""The trie of conversation prefixes, from sorted conversations and their common prefixes.

Each turn becomes a 16-byte token, each conversation the bytes of its tokens, so sorting bytes sorts
conversations and puts the members of every prefix side by side. The sorted conversations are cut into
blocks. In a block, a sparse table answers the least common prefix (LCP) between any two places, and
each candidate prefix searches its extents with it, all at once and without a stack: to the right for
its members, to the left for its parent. Counts, leaves and saved characters of a node are then differences
of running sums over its interval. Each block knows the conversation before and the one after it, so these
sums add up over blocks: a prefix that reaches over a block's edge hands on one partial row for each
block (as many as its two outer conversations have turns), and these are added up by their prefix.

Defined results: turns come in the order of turn (null first), role, and a hash of role and text; null
roles and texts are empty; rows that repeat are turns that repeat; rows without conv_id belong to no
conversation; an empty table has no node, not even the root. Other columns are not read. One
conversation lies in one row, 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statlake.llm.common import materialize, ship

#: Turns and conversations of a block together; one longer conversation makes a block of its own.
BLOCK = 1 << 17
#: The same of a sorted partition, about; it is cut into blocks as it streams by.
PARTITION = 1 << 20
#: Ids that one piece of a list of ids holds.
PIECE = 4096

_TOKEN = 16


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) with turns an array of (turn, role, token, length of the text) in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    token = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), role.alias("role"), token.alias("token"), F.length(text).alias("size")).alias("t"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_shared_heads(turns: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Conversations that begin as the conversation conv_id - conv_id % every does.

    Conversation c takes the first crc32(c) % (most + 1) turns from there, and its own after as many.
    Only the first turns of the few such conversations are joined, each with at most `every` others.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = turns.filter(F.col("conv_id") % every == 0)
    heads = heads.select(F.col("conv_id").alias("head"), F.slice("turns", 1, most).alias("begin"))
    own = turns.withColumn("h", h).withColumn("head", F.col("conv_id") - F.col("conv_id") % every)
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(0)))
    none = F.slice("turns", 1, 0)
    begun = F.coalesce(F.slice("begin", F.lit(1), F.col("h")), none)
    return own.join(heads, "head", "left").select("conv_id", F.concat(begun, rest).alias("turns"))


def _sorted_blocks(turns: DataFrame) -> DataFrame:
    """(block, conv_id, key, sizes): conversations by key and id; ascending blocks hold them in order."""
    tokens = F.transform("turns", lambda t: t["token"])
    rows = materialize(
        turns.select("conv_id", F.unhex(F.array_join(tokens, "")).alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    )
    weight = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    tasks = max(-(-weight // PARTITION), min(rows.sparkSession.sparkContext.defaultParallelism, -(-weight // BLOCK)), 1)
    dealt = rows.repartitionByRange(tasks, "key", "conv_id").sortWithinPartitions("key", "conv_id")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            blocks = []
            for size in pc.binary_length(batch.column("key")).to_pylist():
                own = size // _TOKEN + 1
                if held and held + own > BLOCK:
                    number, held = number + 1, 0
                held += own
                blocks.append(number)
            yield pa.record_batch([pa.array(blocks, pa.int64()), *batch.columns], names=["block", *batch.schema.names])

    return materialize(dealt.mapInArrow(cut, "block long, conv_id long, key binary, sizes array<int>"))


def _with_neighbours(blocks: DataFrame) -> DataFrame:
    """blocks with the conversation before and after each block (side -1 and 1; its own have 0).

    The window runs over one row for each block of BLOCK turns.
    """
    ends = blocks.groupBy("block").agg(
        F.min(F.struct("key", "conv_id", "sizes")).alias("first"), F.max(F.struct("key", "conv_id", "sizes")).alias("last")
    )
    order = W.orderBy("block")
    ends = ends.select("block", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))

    def side(name: str, number: int) -> DataFrame:
        rows = ends.filter(F.col(name).isNotNull())
        return rows.select("block", F.lit(number).alias("side"), f"{name}.conv_id", f"{name}.key", f"{name}.sizes")

    own = blocks.select("block", F.lit(0).alias("side"), "conv_id", "key", "sizes")
    return own.unionByName(side("before", -1)).unionByName(side("after", 1))


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the least of each 2**k values in a row."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        low, half = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(low[:-half], low[half:]))
    return levels


def right_extents(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last place that shares `depth` turns with each place `at`; value p of level 0 is the
    common prefix of places p and p + 1."""
    pos = at.copy()
    for k in range(len(levels) - 1, -1, -1) if len(levels[0]) else ():
        inside = pos + (1 << k) <= len(levels[0])
        least = levels[k][np.where(inside, pos, 0)]
        pos = np.where(inside & (least >= depth), pos + (1 << k), pos)
    return pos


def left_extents(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first place that shares `depth` turns with each place `at`."""
    pos = at.copy()
    for k in range(len(levels) - 1, -1, -1) if len(levels[0]) else ():
        inside = pos - (1 << k) >= 0
        least = levels[k][np.where(inside, pos - (1 << k), 0)]
        pos = np.where(inside & (least >= depth), pos - (1 << k), pos)
    return pos


def _common(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many turns each conversation but the first shares with the one before it."""
    n = np.diff(starts)
    row = np.repeat(np.arange(len(n)), n)
    depth = np.arange(len(tokens)) - starts[row]
    other = np.where((row > 0) & (depth < n[row - 1]), starts[row - 1] + depth, -1)
    equal = (other >= 0) & (tokens == tokens[other]).all(axis=1)
    common = n.copy()  # all turns, or as many as come before the first that differs
    np.minimum.at(common, row, np.where(equal, n[row], depth))
    return common[1:]


_NODES = pa.schema(
    [
        *((name, pa.int64()) for name in ("block", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
        *((name, pa.binary()) for name in ("node", "parent")),
        ("ends_sha256", pa.string()),
        ("place", pa.int64()),
        ("piece", pa.binary()),
    ]
)
_NODE_COLUMNS = (
    "block long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, node binary, parent binary, ends_sha256 string, place long, piece binary"
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _prefix_names(key: bytes) -> list[bytes]:
    """A name for each prefix of a conversation, the empty one first."""
    so_far = hashlib.blake2b(digest_size=_TOKEN)
    names = [so_far.digest()]
    for at in range(0, len(key), _TOKEN):
        so_far.update(key[at : at + _TOKEN])
        names.append(so_far.digest())
    return names


def _block_nodes(table: pa.Table) -> pa.Table:
    """The nodes of one block: whole rows of prefixes that lie inside, partial rows and pieces of the
    member lists of those that reach over its edges."""
    block = table.column("block")[0].as_py()
    rows = sorted(zip(table.column("side").to_pylist(), table.column("key").to_pylist(), table.column("conv_id").to_pylist(), table.column("sizes").to_pylist(), strict=True))
    first, last = rows[0][0] == -1, rows[-1][0] == 1
    n = np.array([len(r[3]) for r in rows], np.int64)
    starts = np.concatenate([[0], np.cumsum(n)])
    tokens = np.frombuffer(b"".join(r[1] for r in rows), np.uint64).reshape(-1, 2)
    common = _common(tokens, starts)
    # of the block's own conversations: what each shares with the one before; -1 where there is none
    lcp = np.concatenate([[] if first else [-1], common, [] if last else [-1]]).astype(np.int64)
    rows, n = rows[first : len(rows) - last], n[first : len(n) - last]
    m, ids = len(rows), np.array([r[2] for r in rows], np.int64)
    sizes = np.concatenate([[0], np.cumsum(np.fromiter((x for r in rows for x in r[3]), np.int64))])
    at = np.concatenate([[0], np.cumsum(n)])

    def chars(row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Characters of a conversation's first turns."""
        return sizes[at[row] + np.maximum(depth, 0)] - sizes[at[row]]

    levels = sparse_table(lcp[1:m])
    # a candidate for each prefix that its conversation is the first to have here, in preorder
    shared = np.concatenate([[-1], lcp[1:m]])
    base = np.concatenate([[0], np.cumsum(n - shared)])
    row = np.repeat(np.arange(m), n - shared)
    depth = np.arange(base[-1]) - base[row] + shared[row] + 1
    right = right_extents(levels, row, depth)
    left_open, right_open = (row == 0) & (depth <= lcp[0]), (right == m - 1) & (depth <= lcp[m])
    whole = ~left_open & ~right_open

    parent = np.arange(base[-1]) - 1
    begins = base[1:-1][n[1:] > shared[1:]]
    parent[begins] = base[(l := left_extents(levels, row[begins], depth[begins] - 1))] + depth[begins] - 1 - (shared[l] + 1)

    places = np.arange(m)
    leaf = np.concatenate([[0], np.cumsum(lcp[1:] < n)])
    total = np.concatenate([[0], np.cumsum(chars(places, n))])
    new = np.concatenate([[0], np.cumsum(chars(places, n) - chars(places, lcp[:m]))])
    count = right - row + 1
    all_chars = total[right + 1] - total[row] - count * chars(row, depth - 1)
    distinct = np.where(left_open, new[right + 1] - new[row], new[right + 1] - new[row + 1] + chars(row, n[row]) - chars(row, depth - 1))
    least = sparse_table(ids)
    width = np.frexp(count.astype(np.float64))[1] - 1
    smallest = np.empty(len(row), np.int64)
    for k in np.unique(width):
        own = width == k
        smallest[own] = np.minimum(least[k][row[own]], least[k][right[own] + 1 - (1 << k)])
    known = parent >= 0
    children = np.bincount(parent[known & ~left_open], minlength=len(row))

    # the members that end at a node come first in its interval: copies of its first conversation
    other = np.ones(m + 1, bool)
    other[1:m] = (lcp[1:m] < n[1:]) | (n[1:] != n[:-1])
    breaks = np.flatnonzero(other)
    ends = np.flatnonzero(depth == n[row])
    stops = breaks[np.searchsorted(breaks, row[ends], side="right")]
    sha = np.full(len(row), _NO_ENDS, object)
    sha[~whole] = None
    names: dict[int, list[bytes]] = {}

    def name(i: int) -> bytes:
        r = int(row[i])
        if r not in names:
            names[r] = _prefix_names(rows[r][1])
        return names[r][depth[i]]

    texts = [str(i) for i in ids.tolist()]
    pieces = []
    for i, stop in zip(ends.tolist(), stops.tolist(), strict=True):
        if whole[i]:
            sha[i] = hashlib.sha256(",".join(texts[row[i] : stop]).encode()).hexdigest()
        else:
            for x in range(row[i], stop, PIECE):
                pieces.append((name(i), int(x), ",".join(texts[x : min(x + PIECE, stop)]).encode()))
    edge = known.copy()
    edge[known] = ~whole[parent[known]]
    above = np.full(len(row), None, object)
    above[known & ~edge] = smallest[parent[known & ~edge]]
    columns = {
        "block": np.full(len(row), block),
        "depth": depth,
        "conv_id": smallest,
        "parent_conv_id": above,
        "n_convs": count,
        "n_children": children,
        "n_leaves": leaf[right + 1] - leaf[row],
        "saved_tokens": all_chars - distinct,
        "node": [None if w else name(i) for i, w in enumerate(whole.tolist())],
        "parent": [name(int(parent[i])) if e else None for i, e in enumerate(edge.tolist())],
        "ends_sha256": sha,
    }
    nodes = pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(row), f.type) for f in _NODES], schema=_NODES)
    if not pieces:
        return nodes
    more = {"block": [block] * len(pieces), "node": [p[0] for p in pieces], "place": [p[1] for p in pieces], "piece": [p[2] for p in pieces]}
    return pa.concat_tables([nodes, pa.table([pa.array(more[f.name], f.type) if f.name in more else pa.nulls(len(pieces), f.type) for f in _NODES], schema=_NODES)])


def _joined_hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's pieces in their order, joined by commas; no piece is kept."""
    node, so_far = None, None

    def done() -> pa.RecordBatch:
        return pa.record_batch([pa.array([node], pa.binary()), pa.array([so_far.hexdigest()])], names=["node", "joined"])

    for batch in batches:
        for own, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if own != node:
                if so_far is not None:
                    yield done()
                node, so_far = own, hashlib.sha256(piece)
            else:
                so_far.update(b",")
                so_far.update(piece)
    if so_far is not None:
        yield done()


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the conversations (conv_id, turns) of `ordered_turns`."""
    ship(turns.sparkSession)
    blocks = _with_neighbours(_sorted_blocks(turns))
    found = materialize(blocks.groupBy("block").applyInArrow(_block_nodes, _NODE_COLUMNS))
    nodes, pieces = found.filter("piece IS NULL"), found.filter("piece IS NOT NULL")
    inside, across = nodes.filter("node IS NULL"), nodes.filter("node IS NOT NULL")

    hashes = pieces.select("node", "block", "place", "piece").repartition("node").sortWithinPartitions("node", "block", "place")
    hashes = hashes.select("node", "piece").mapInArrow(_joined_hashes, "node binary, joined string")

    def total(name: str) -> Column:
        return F.sum(name).alias(name)

    merged = across.groupBy("node", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.min("parent").alias("parent"), *map(total, ("n_convs", "n_children", "n_leaves", "saved_tokens"))
    )
    merged = materialize(merged.join(hashes, "node", "left").withColumn("ends_sha256", F.coalesce("joined", F.lit(_NO_ENDS))))
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    outer = merged.join(above, "parent", "left").select(*RESULT)
    # children inside a block find their parent by block and name: no parent meets more than a block's nodes
    edges = across.select("block", F.col("node").alias("parent")).join(above, "parent")
    under = inside.filter("parent IS NOT NULL").drop("parent_conv_id").join(edges, ["block", "parent"], "left").select(*RESULT)
    return inside.filter("parent IS NULL").select(*RESULT).unionByName(under).unionByName(outer)
