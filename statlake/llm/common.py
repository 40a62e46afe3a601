"""Shared helpers: shared scratch tables, batches of bounded size, hashed words of whole texts."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of bytes other than the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
#: Text bytes that a Python worker handles at once; one longer text makes a batch of its own.
SLICE_BYTES = 2 << 20

_MASK = (1 << 64) - 1


def scratch(spark: SparkSession) -> str:
    """A new folder path below spark.checkpoint.dir; sets that only for local sessions without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="statlake-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Give the executors this package's source once, for sessions whose workers lack it."""
    context = spark.sparkContext
    if getattr(context, "_statlake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if not os.path.isdir(os.path.join(root, "statlake")):
        return  # it runs from an archive that the session got already
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="statlake-src-")), "statlake_src.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(os.path.join(root, "statlake")):
            for name in sorted(names):
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    archive.write(whole, os.path.relpath(whole, root))
    context.addPyFile(path)
    context._statlake_shipped = True


def materialize(df: DataFrame) -> DataFrame:
    """Write to a shared table and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_go(*frames: DataFrame) -> None:
    """Remove the tables of `materialize` that nothing reads any more, and the shuffle files of finished
    steps, which Spark removes when the driver's garbage that names them is collected."""
    for frame in frames:
        for path in {f.rsplit("/part-", 1)[0] for f in frame.inputFiles()}:
            place = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(unquote(path))
            place.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
    gc.collect()
    if frames:
        frames[0].sparkSession._jvm.System.gc()


#: Ids by which a table is narrowed with a broadcast; more of them are met by a join.
BROADCAST_IDS = 2_000_000


def narrowed(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows whose id is among the distinct ids (a table of `materialize`): where they are if the ids are
    few, so that texts nobody asks for are not shuffled."""
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, column, "left_semi")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words_column(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; uint64 in and out."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about SLICE_BYTES of the text column, or one long text."""
    for batch in batches:
        text = batch.column(column)
        if not batch.num_rows:
            continue
        lengths = np.fromiter((0 if n is None else n for n in _lengths(text)), np.int64, batch.num_rows)
        total = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + SLICE_BYTES, side="right")))
            yield batch.slice(start, end - start)
            start = end


_handed_back = 0.0


def hand_back(least: float = 0.0) -> None:
    """Give memory that a worker no longer uses back to the system: an idle worker stays for a while, beside
    the JVM's next stage. least: seconds since the last time, for calls after each of many groups."""
    global _handed_back
    now = time.monotonic()
    if now - _handed_back < least:
        return
    _handed_back = now
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _lengths(text: pa.Array) -> list:
    import pyarrow.compute as pc

    return pc.binary_length(text).to_pylist()


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    text = pa.concat_arrays([text.cast(pa.large_string()).fill_null("")])
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BYTE = seeds(256, 77)
_BASE = 0xD6E8FEB86659FD93
_BACK = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        both = []
        for base in (_BASE, _BACK):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p))
        if n > SLICE_BYTES + 1:
            return tuple(both)  # one long text's own: a worker does not keep them
        _powers = tuple(both)
    return _powers


def hashed_words(text: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased) and, for each row, the offset of its first word."""
    data, offsets = text_bytes(text)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = _IS_WORD[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _powers_to(len(data) + 1)
    table = _BYTE[_LOWER] if lower else _BYTE
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return words, np.searchsorted(starts, offsets)
