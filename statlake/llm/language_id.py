"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased letter by letter; all that is neither letter nor mark counts as a blank, and one
blank stands at either end. Its features are the n-grams of 1 to 4 characters that hold a blank at
their ends at most, hashed into BUCKETS buckets. Counts of all training texts make one row of
log-probabilities for each language; the rows of up to LANGUAGES languages are broadcast at once.

Log-probabilities are whole numbers (units of 2**-20), so sums do not depend on the order of rows,
batches or tasks. The posterior is that of the mean over the four lengths, since n-grams that overlap
are no independent evidence.

Defined results: null texts and texts without a letter are `und` with score 0, and so is every text if
there is nothing to learn from; a text whose n-grams training never had gets the languages' shares as
its posterior; of equal posteriors the least language wins; rows that repeat count and are answered as
often as they occur; a null language is never learnt from, an empty one is a language; tables may be
empty and may have further columns of any names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.llm.common import materialize, ship, slices

#: Lengths of the n-grams and the number of buckets of their hashes.
ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
#: Added to each bucket's count.
ALPHA = 0.1
#: Languages whose rows (BUCKETS * 4 bytes each) are broadcast at once, about.
LANGUAGES = 128
#: Characters that are handled at once; longer texts are taken in pieces that overlap.
PIECE = 1 << 20
UNKNOWN = "und"

_UNIT = float(1 << 20)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
#: Counts that a task holds before it hands them on, in languages.
_HELD = 32


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower-case letter or mark (0 for all else), and whether it is a letter."""
    folded, letter = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    for i in range(0x110000):
        kind = unicodedata.category(c := chr(i))[0]
        if kind in "LM":
            low = c.lower()
            folded[i] = ord(low) if len(low) == 1 else i
            letter[i] = kind == "L"
    return folded, letter


def _grams(codes: np.ndarray, stop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the places before `stop` where an n-gram begins, and its buckets."""
    full = codes != 0
    sums = np.zeros(len(codes), np.uint64)
    inside = np.ones(len(codes), bool)  # no blank between the ends
    with np.errstate(over="ignore"):
        factor = np.uint64(1)
        for n in range(1, max(ORDERS) + 1):
            many = len(codes) - n + 1
            if many <= 0:
                return
            factor = factor * _BASE
            sums = sums[:many] + codes[n - 1 :] * factor
            if n > 2:
                inside = inside[:many] & full[n - 2 : n - 2 + many]
            valid = inside[:many] & (full[:many] | full[n - 1 :]) if n > 1 else full
            at = np.flatnonzero(valid[:stop])
            yield at, ((sums[at] + np.uint64(n)) * _SPREAD) >> np.uint64(48)


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """Folded characters, where each text begins in them, the place before which n-grams begin, and
    which texts have a letter: all texts at once, or a long one piece by piece."""
    folded, letter = _characters()
    reach = max(ORDERS) - 1
    if sum(map(len, texts)) <= PIECE or len(texts) > 1:
        whole = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "replace"), np.uint32)
        starts = np.cumsum([0, *(len(t) + 2 for t in texts)])
        letters = np.add.reduceat(letter[whole], starts[:-1], dtype=np.int64) > 0
        yield folded[whole].astype(np.uint64), starts, len(whole), letters
        return
    for text in texts:
        padded = f" {text} "
        for at in range(0, len(padded), PIECE):
            piece = np.frombuffer(padded[at : at + PIECE + reach].encode("utf-32-le", "replace"), np.uint32)
            yield folded[piece].astype(np.uint64), np.array([0, len(piece)]), PIECE, letter[piece].any(keepdims=True)


_COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts for each language; bucket -1 counts the texts."""
    held: dict[str, np.ndarray] = {}

    def handed_on() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.record_batch([pa.array([lang] * len(at)), pa.array((at - 1).astype(np.int32)), pa.array(counts[at])], schema=_COUNTS)
        held.clear()

    for batch in slices(batches, "text"):
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text or "")
        for lang, texts in by_lang.items():
            if lang not in held and len(held) == _HELD:
                yield from handed_on()
            counts = held.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            counts[0] += len(texts)
            for codes, _, stop, _ in _pieces(texts):
                for _, buckets in _grams(codes, stop):
                    counts[1:] += np.bincount(buckets.astype(np.int64), minlength=BUCKETS)
    yield from handed_on()


_MODEL = "lang string, n_texts long, weights binary"


def _weights(table: pa.Table) -> pa.Table:
    """One language's counts (a row for each bucket at most) as log-probabilities."""
    at, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    counts = np.zeros(BUCKETS)
    counts[at[at >= 0]] = n[at >= 0]
    logs = np.log(counts + ALPHA) - np.log(counts.sum() + ALPHA * BUCKETS)
    row = {"lang": table.column("lang")[0].as_py(), "n_texts": int(n[at < 0].sum()), "weights": np.rint(logs * _UNIT).astype("<i4").tobytes()}
    return pa.Table.from_pylist([row], schema=pa.schema([("lang", pa.string()), ("n_texts", pa.int64()), ("weights", pa.binary())]))


def fit_languages(texts: DataFrame) -> DataFrame:
    """A model, one row for each language, from all rows of `text` and `lang` with a language.

    Tasks count their own texts before anything is shuffled, so a language with most of the rows
    moves no more than its buckets for each task.
    """
    ship(texts.sparkSession)
    known = texts.filter(F.col("lang").isNotNull()).select("text", "lang")
    counts = known.mapInArrow(_counted, "lang string, bucket int, n long")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    return materialize(counts.groupBy("lang").applyInArrow(_weights, _MODEL))


def _scorer(shared, keep: int, last: bool):
    """Fold one group of languages into each row's best posterior so far."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prior, blobs = shared.value
        weights = [np.frombuffer(x, "<i4") for x in blobs]
        for batch in slices(batches, "__text"):
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            sums, letters = np.zeros((len(langs), len(texts)), np.int64), np.zeros(len(texts), bool)
            for codes, starts, stop, has in _pieces(texts):
                letters |= has
                for at, buckets in _grams(codes, stop):
                    edges = np.searchsorted(at, starts)
                    for own, row in zip(sums, weights, strict=True):
                        total = np.concatenate([[0], np.cumsum(row[buckets], dtype=np.int64)])
                        own += total[edges[1:]] - total[edges[:-1]]
            post = sums / (_UNIT * len(ORDERS)) + np.array(prior)[:, None]
            best = post.argmax(axis=0)
            top = post[best, np.arange(len(texts))]
            mass = np.exp(post - top).sum(axis=0)
            named = np.array(langs, object)[best]
            before = batch.column("__top").to_numpy(zero_copy_only=False)
            if not np.isnan(before).all():  # languages of earlier rounds
                name, held = np.array(batch.column("__lang").to_pylist(), object), batch.column("__mass").to_numpy(zero_copy_only=False)
                wins = (top > before) | ((top == before) & (named < name))
                high = np.maximum(top, before)
                mass = mass * np.exp(top - high) + held * np.exp(before - high)
                named, top = np.where(wins, named, name), high
            kept = [batch.column(f"__keep{i}") for i in range(keep)]
            if last:
                kept += [pa.array(np.where(letters, named, UNKNOWN), pa.string()), pa.array(np.where(letters, 1 / mass, 0.0))]
                names = ["__lang", "__score"]
            else:
                kept += [batch.column("__text"), pa.array(top), pa.array(named, pa.string()), pa.array(mass)]
                names = ["__text", "__top", "__lang", "__mass"]
            yield pa.record_batch(kept, names=[*(f"__keep{i}" for i in range(keep)), *names])

    return run


def identify_languages(docs: DataFrame, model: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of every row with `lang_pred` and `score`, its posterior among all languages.

    Models of more than about LANGUAGES languages are broadcast and applied group by group, the rows
    written to a shared table in between.
    """
    spark = docs.sparkSession
    ship(spark)
    size = model.agg(F.count("*"), F.sum("n_texts")).first()
    kept = [F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)]
    back = [F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)]
    if not size[0]:
        return docs.select(*[F.col(c) for c in keep], F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    state = docs.select(
        *kept, F.col("text").alias("__text"), F.lit(float("nan")).alias("__top"), F.lit("").alias("__lang"), F.lit(0.0).alias("__mass")
    )
    rounds, pending = -(-size[0] // LANGUAGES), None
    for r in range(rounds):
        rows = model.filter(F.pmod(F.xxhash64("lang"), F.lit(rounds)) == r).orderBy("lang").toArrow().to_pylist()
        if not rows:
            continue
        if pending is not None:
            state = materialize(state.mapInArrow(_scorer(pending, len(keep), False), state.schema))
        prior = [float(np.log(x["n_texts"] / size[1])) for x in rows]
        pending = spark.sparkContext.broadcast(([x["lang"] for x in rows], prior, [x["weights"] for x in rows]))
    found = [T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())]
    done = state.mapInArrow(_scorer(pending, len(keep), True), T.StructType([*state.schema.fields[: len(keep)], *found]))
    return done.select(*back, F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))
