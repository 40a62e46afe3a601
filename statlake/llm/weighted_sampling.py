"""Fingerprints of documents by consistent weighted sampling of their words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statlake.llm.common import hashed_words, materialize, mix, seeds, ship, slices
from statlake.llm.ordered import block_bounds, block_of, by_blocks, order_key, start_key

#: Samples of a fingerprint; the likeness of two has a deviation of at most 0.5 / sqrt(SAMPLES).
SAMPLES = 64
_SEEDS = tuple(seeds(SAMPLES, 100 + i) for i in range(2))
#: Terms whose variables are drawn at once.
_TERMS = 8192


def _variables(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each term and sample r and log c, with r and c from Gamma(2, 1), and beta, uniform."""
    a, b = (mix(terms[:, None] ^ s[None, :]) for s in _SEEDS)
    part = lambda h, at: ((h >> np.uint64(at)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(2**-24) + np.float32(2**-25)
    r = -np.log(part(a, 0) * part(a, 24))
    c = -np.log(part(b, 0) * part(b, 24))
    beta = (((a >> np.uint64(48)) << np.uint64(8)) | (b >> np.uint64(56))).astype(np.float32) * np.float32(2**-24)
    return r, np.log(c), beta


def fingerprints(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text (its hashed words) SAMPLES 32-bit codes of the sampled (term, level).

    The weight of a term is 1 + log(its count). For each sample, a term of weight w has
    t = floor(log(w) / r + beta), log y = r (t - beta) and key log c - log y - r; the term with the
    least key is sampled, with t. Two texts agree in a sample with the probability of the generalized
    Jaccard similarity of their weights. A text without words has zeros.
    """
    n = len(offsets) - 1
    out = np.zeros((n, SAMPLES), np.uint32)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    order = np.lexsort((words, doc))
    doc, sorted_ = doc[order], words[order]
    if not len(doc):
        return out
    new = np.empty(len(doc), bool)
    new[0] = True
    new[1:] = (doc[1:] != doc[:-1]) | (sorted_[1:] != sorted_[:-1])
    at = np.flatnonzero(new)
    weight = np.log(1 + np.log(np.diff(np.append(at, len(doc))))).astype(np.float32)
    doc, term = doc[at], sorted_[at]
    vocabulary, code = np.unique(term, return_inverse=True)
    best = np.full((n, SAMPLES), np.inf, np.float32)
    for start in range(0, len(vocabulary), _TERMS):
        r, c, beta = _variables(vocabulary[start : start + _TERMS])
        rows = np.flatnonzero((code >= start) & (code < start + _TERMS))
        for part in np.array_split(rows, max(1, len(rows) // 16_384)):
            own = code[part] - start
            rate, shift = r[own], beta[own]
            level = np.floor(weight[part][:, None] / rate + shift)
            key = c[own] - rate * (level - shift) - rate
            # the least key of each document in this part; parts are in document order
            edges = np.flatnonzero(np.append(True, doc[part][1:] != doc[part][:-1])) if len(part) else np.zeros(0, int)
            if not len(edges):
                continue
            least = np.minimum.reduceat(key, edges, axis=0)
            which = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(part))))
            mine = doc[part][edges]
            better = least < best[mine]
            hit_row, hit_sample = np.nonzero((key == least[which]) & better[which])
            codes = mix(term[part][hit_row] + level[hit_row, hit_sample].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + seeds(1, 3)[0])
            out[mine[which[hit_row]], hit_sample] = codes.astype(np.uint32)
            best[mine] = np.minimum(best[mine], least)
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of samples in which fingerprints agree, row by row."""
    return (x == y).mean(axis=1)


def _texts(values: list[str]) -> np.ndarray:
    return fingerprints(*hashed_words(pa.array(values, pa.large_string())))


def _neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in (block, order) order, each block's last row being the first of the next one."""
    held: tuple | None = None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        own = _texts([r[2] for r in rows])
        edited_texts = []
        for (_, _, text, _), (_, _, after, _) in zip(rows, rows[1:], strict=False):
            half = len(text) // 2
            edited_texts.append(text[: len(text) - half] + after[:half])
        edited = _texts(edited_texts)
        pick = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0] and not rows[i][3]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][1] for i in pick], pa.int64()),
                pa.array([len(rows[i][2]) for i in pick], pa.int64()),
                pa.array([hashlib.sha256(edited_texts[i].encode()).hexdigest() for i in pick], pa.string()),
                pa.array([own[i].astype(">u4").tobytes().hex() for i in pick], pa.string()),
                pa.array([edited[i].astype(">u4").tobytes().hex() for i in pick], pa.string()),
                pa.array(likeness(own[:-1], edited)[pick], pa.float64()),
                pa.array(likeness(own[:-1], own[1:])[pick], pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    for batch in slices(batches, "text"):
        rows = [] if held is None else [held]
        rows += zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "text", "tail")), strict=True)
        held = rows[-1]
        if len(rows) > 1:
            yield out(rows)


def weighted_fingerprints(docs: DataFrame) -> DataFrame:
    """Consistent weighted samples of each document (doc_id, text), of it edited, and of its successor.

    Returns doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint (SAMPLES
    codes of 8 hexadecimal digits), near_edited and near_next (share of samples that agree). Terms
    are the words between ASCII blanks, A-Z lower-cased, weighing 1 + log(count). The edited text has
    its last floor(n_chars / 2) code points replaced by the first as many of the next document in
    ascending doc_id order; after the last comes the first.

    Null and empty texts count as empty; texts without words have the same fingerprint of zeros.
    A null doc_id comes first; rows that repeat a doc_id are ordered by text, and of repeated rows
    each is the next one's predecessor. A single document is its own successor. One result row for
    each input row; other columns are ignored.

    Documents are dealt once, by ranges of (doc_id, text) of about equal bytes; each range also gets the next range's first row.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    bounds = block_bounds(rows)
    rows = rows.withColumn("order", order_key()).withColumn("block", block_of(bounds))
    # where each block begins, and the block before it, wrapping around: one row a block, of which there is a bounded number
    firsts = rows.groupBy("block").agg(F.min(F.struct("order", start_key().alias("start"))).alias("first")).select("block", "first.*")
    ahead = F.coalesce(F.lag("block").over(W.orderBy("block")), F.max("block").over(W.partitionBy()))
    firsts = materialize(firsts.select("block", "order", "start", ahead.alias("before")))
    tails = rows.withColumn("start", start_key()).join(F.broadcast(firsts), ["block", "order", "start"])
    tails = tails.groupBy("order", "before").agg(F.min("text").alias("text"))
    tails = tails.select(F.lit(None).cast("long").alias("doc_id"), "text", "order", F.col("before").alias("block"), F.lit(True).alias("tail"))
    rows = rows.withColumn("tail", F.lit(False)).unionByName(tails)
    dealt = by_blocks(rows, bounds, "tail", "order", "text")
    return dealt.select("block", "doc_id", "text", "tail").mapInArrow(
        _neighbours,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
