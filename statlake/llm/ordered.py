"""Documents in doc_id order, in blocks of bounded size."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import materialize

#: Text bytes of a block, about; a row counts ROW_BYTES besides.
BLOCK_BYTES, ROW_BYTES = 24 << 20, 128
#: Blocks at most, about; beyond, they grow with the table, since the driver holds where each begins.
MOST_BLOCKS = 10_000
#: Characters of a text that tell rows of one doc_id apart when blocks are cut.
START = 32
#: Ranges of equal numbers of rows that a block is put together from.
_FINE = 3
_LEAST = -(1 << 63)


def order_key() -> Column:
    """doc_id as an order; null comes first."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST))


def start_key() -> Column:
    return F.substring("text", 1, START)


def block_bounds(docs: DataFrame) -> list[tuple[int, str]]:
    """Ascending (doc_id, start of the text) at which the blocks of docs (doc_id, text not null) begin, but for the first.

    Rows that share a doc_id, or have none, are cut apart by their texts' first START characters. The
    table of keys and sizes is cut into ranges of equal numbers of rows, and these are put together by bytes.
    """
    size = F.octet_length("text").cast("long") + ROW_BYTES
    keys = materialize(docs.select(order_key().alias("order"), start_key().alias("start"), size.alias("size")))
    total = keys.agg(F.sum("size")).first()[0] or 0
    blocks = min(MOST_BLOCKS, -(-total // BLOCK_BYTES))
    if blocks <= 1:
        return []
    ranges = keys.repartitionByRange(_FINE * blocks, "order", "start").groupBy(F.spark_partition_id().alias("range"))
    # a few rows for each block
    found = sorted(ranges.agg(F.min(F.struct("order", "start")).alias("first"), F.sum("size").alias("size")).select("first.*", "size").collect())
    most, held, cuts = max(BLOCK_BYTES, total / MOST_BLOCKS), 0, []
    for order, start, own in found:
        if held and held + own > most:
            cuts.append((order, start))
            held = 0
        held += own
    return cuts


def block_of(bounds: list[tuple[int, str]]) -> Column:
    """The number of bounds that a row (order, text) reaches."""
    edges, starts = np.array([x for x, _ in bounds], np.int64), [x for _, x in bounds]

    @F.pandas_udf("int")
    def block(order: pd.Series, start: pd.Series) -> pd.Series:
        ids = order.to_numpy(np.int64)
        low, high = (np.searchsorted(edges, ids, side=side) for side in ("left", "right"))
        # ids that begin a block: their texts decide
        for at in np.flatnonzero(low < high):
            low[at] = bisect_right(starts, start.iat[at], low[at], high[at])
        return pd.Series(low.astype(np.int32))

    return block("order", start_key()) if bounds else F.lit(0)


def by_blocks(rows: DataFrame, bounds: list[tuple[int, str]], *order: str) -> DataFrame:
    """Rows (block, ...) dealt by the number of their block, one task for each, sorted in it."""
    return rows.repartitionById(len(bounds) + 1, F.col("block")).sortWithinPartitions("block", *order)
