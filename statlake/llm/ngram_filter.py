"""Language-model scores from a log-frequency Bloom filter of quantised bigram counts."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import hand_back, hashed_words, materialize, mix, seeds, ship, slices

#: Text bytes of a chunk, which one Python call encodes and scores.
CHUNK_BYTES = 12 << 20
#: Filter bits for each entry, and probes for each entry.
ENTRY_BITS, PROBES = 10, 5
#: Entries that are set or probed, and tokens that are hashed, at once.
STEP = 1 << 18
#: Counts are kept as levels of this ratio, from LEAST_COUNT on.
RATIO, LEAST_COUNT = 1.5, 1
#: Weight of the unigram distribution against a context's count.
PRIOR = 300.0
#: Tokens whose bigrams, and tokens whose words, make one segment of the hash space, about.
BIGRAM_TOKENS, WORD_TOKENS = 4_000_000, 10_000_000

_END = seeds(1, 41)[0]
_K = seeds(2, 43) | np.uint64(1)
_PROBE = seeds(PROBES, 47)
_LEVEL = seeds(110, 53)
_EDGES = np.ceil(LEAST_COUNT * RATIO ** np.arange(len(_LEVEL) + 1) - 1e-9)
#: The mean of the counts that a level stands for; level 0 is none, level 1 exactly LEAST_COUNT.
_COUNT = np.concatenate([[0.0], (_EDGES[:-1] + _EDGES[1:] - 1) / 2])


def _planes(codes: np.ndarray) -> bytes:
    """32-bit codes byte plane by byte plane, which compresses well."""
    return np.ascontiguousarray(codes, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _codes(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values, ascending; the place of each value among them; an order by value, and where each
    distinct value begins in it. Arrays that are done with go at once, which np.unique does not do."""
    order = np.argsort(values, kind="stable")
    sorted_ = values[order]
    first = np.ones(len(values), bool)
    np.not_equal(sorted_[1:], sorted_[:-1], out=first[1:])
    names = sorted_[first]
    del sorted_
    group = np.cumsum(first, dtype=np.uint32)
    group -= np.uint32(1)
    place = np.empty(len(values), np.uint32)
    place[order] = group
    return names, place, order, np.flatnonzero(first)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk: its documents, their tokens as codes of the chunk's own dictionary, by frequency."""
    task, done = TaskContext.get().partitionId(), 0
    ids: list = []
    train: list = []
    lengths: list[np.ndarray] = []
    tokens: list[np.ndarray] = []
    size = 0

    def out() -> pa.RecordBatch:
        whole = np.concatenate(tokens)
        tokens.clear()
        names, codes, _, starts = _grouped(whole)
        rank = np.argsort(-np.diff(starts, append=len(whole)), kind="stable")
        del whole
        place = np.empty(len(rank), np.uint32)
        place[rank] = np.arange(len(rank), dtype=np.uint32)
        codes = place[codes]
        own = np.concatenate(lengths)
        known = np.bincount(codes[np.repeat(np.array(train, bool), own)], minlength=len(names)).astype("<u4")
        columns = [
            pa.array([(task << 32) + done], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([train], pa.list_(pa.bool_())),
            pa.array([own.tolist()], pa.list_(pa.int64())),
            pa.array([_planes(codes)], pa.binary()),
            pa.array([names[rank].astype("<u8").tobytes()], pa.binary()),
            pa.array([known.tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "train", "lengths", "codes", "names", "counts"])

    for batch in slices(batches, "text"):
        words, offsets = hashed_words(batch.column("text"))
        n = np.diff(offsets) + 1
        whole = np.empty(int(n.sum()), np.uint64)
        ends = np.cumsum(n) - 1
        inner = np.ones(len(whole), bool)
        inner[ends] = False
        whole[ends], whole[inner] = _END, words
        ids += batch.column("doc_id").to_pylist()
        train += batch.column("train").to_pylist()
        lengths.append(n)
        tokens.append(whole)
        size += batch.column("text").nbytes
        if size >= CHUNK_BYTES:
            yield out()
            done, size = done + 1, 0
            ids, train, lengths, tokens = [], [], [], []
            hand_back()
    if ids:
        yield out()
    hand_back()


_CHUNK = "chunk long, ids array<long>, train array<boolean>, lengths array<long>, codes binary, names binary, counts binary"


def _by_segment(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by (segment, hash), and where each segment begins in it."""
    home = hashes % np.uint64(segments)
    order = np.lexsort((hashes, home))
    return order, np.searchsorted(home[order], np.arange(segments + 1, dtype=np.uint64))


def _rows(chunk: int, first: np.ndarray, second: np.ndarray, edges: np.ndarray, pack) -> pa.RecordBatch:
    full = np.flatnonzero(np.diff(edges))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(full.astype(np.int32)),
            pa.array(np.full(len(full), chunk, np.int64)),
            pa.array([pack(first[edges[i] : edges[i + 1]]) for i in full], pa.binary()),
            pa.array([_planes(second[edges[i] : edges[i + 1]]) for i in full], pa.binary()),
        ],
        names=["segment", "chunk", "names", "counts"],
    )


_ROWS = "segment int, chunk long, names binary, counts binary"


def _entries(batches: Iterable[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """For each chunk and segment the chunk's words there and how often training has them in it."""
    for batch in batches:
        for chunk, names, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "names", "counts")), strict=True):
            names = np.frombuffer(names, "<u8")
            order, edges = _by_segment(names, segments)
            yield _rows(chunk, names[order], np.frombuffer(counts, "<u4")[order], edges, lambda x: x.tobytes())
    hand_back()


def _unigrams(rows: pa.Table) -> pa.Table:
    """The training counts of a segment's words, sent back to each chunk in the order they came in."""
    names = [np.frombuffer(x, "<u8") for x in rows.column("names").to_pylist()]
    counts = np.concatenate([_codes(x) for x in rows.column("counts").to_pylist()])
    words, place = np.unique(np.concatenate(names), return_inverse=True)
    sums = np.bincount(place, weights=counts, minlength=len(words)).astype(np.int64)
    cuts = np.cumsum([0, *map(len, names)])
    once = np.zeros((2, rows.num_rows), np.int64)
    once[:, 0] = sums.sum(), np.count_nonzero(sums)
    back = sums[place].astype("<u8").view("<u4").reshape(-1, 2)
    return pa.table(
        {
            "chunk": rows.column("chunk"),
            "segment": rows.column("segment"),
            "low": pa.array([_planes(np.ascontiguousarray(back[a:b, 0])) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
            "high": pa.array([_planes(np.ascontiguousarray(back[a:b, 1])) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
            "total": once[0],
            "distinct": once[1],
        }
    )


_KNOWN = "chunk long, segment int, low binary, high binary, total long, distinct long"


def _bigrams(tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The hash of each token after the one before it; a document begins after an end."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.cumsum(lengths) - lengths] = _END
    for at in range(0, len(out), STEP):
        own = slice(at, at + STEP)
        out[own] = mix(out[own] * _K[0] + tokens[own] * _K[1])
    return out


def _within(hashes: np.ndarray, segments: int) -> np.ndarray:
    """A hash within its segment: 32 bits, as segments hold few million bigrams at any size of the corpus."""
    return ((hashes // np.uint64(segments)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _by_part(found: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by (segment, hash within it), the latter in that order, and where each segment begins."""
    both = found % np.uint64(segments)
    both <<= np.uint64(32)
    both |= _within(found, segments)
    order = np.argsort(both, kind="stable")
    both = both[order]
    return order, both.astype(np.uint32), np.searchsorted(both, np.arange(segments + 1, dtype=np.uint64) << np.uint64(32))


def _counted(batches: Iterable[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """For each chunk and segment its bigrams, as differences of sorted hashes, and their counts in training."""

    def counted(chunk: int, train: pa.Array, n: np.ndarray, codes: bytes, names: bytes) -> pa.RecordBatch:
        found, _, order, starts = _grouped(_bigrams(np.frombuffer(names, "<u8")[_codes(codes)], n))
        counts = np.add.reduceat(np.repeat(train.to_numpy(zero_copy_only=False), n)[order], starts, dtype=np.uint32)
        del order, starts
        order, part, edges = _by_part(found, segments)
        return _rows(chunk, part, counts[order], edges, lambda x: _planes(np.diff(x, prepend=np.uint32(0))))

    for batch in batches:
        for i in range(batch.num_rows):
            chunk, train, lengths, codes, names = (batch.column(c)[i] for c in ("chunk", "train", "lengths", "codes", "names"))
            yield counted(chunk.as_py(), train.values, lengths.values.to_numpy(), codes.as_buffer(), names.as_buffer())
            hand_back()


def _level(counts: np.ndarray) -> np.ndarray:
    return np.minimum(len(_LEVEL), 1 + np.floor(np.log(counts / LEAST_COUNT) / math.log(RATIO) + 1e-9)).astype(np.int64)


def _places(parts: np.ndarray, level: int, probe: int, bits: np.ndarray | int) -> np.ndarray:
    return (mix(parts.astype(np.uint64) ^ _LEVEL[level - 1] ^ _PROBE[probe]) % np.asarray(bits, np.uint64)).astype(np.int64)


def _parts(names: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.cumsum(_codes(x), dtype=np.uint32) for x in names.to_pylist()]


def _segment(rows: pa.Table, step: int = STEP) -> pa.Table:
    """A segment of the filter, of as many bits as its entries need: its size in bits and the bits."""
    # name and count in one number each, sorted where they are
    both = np.concatenate(_parts(rows.column("names"))).astype(np.uint64)
    both <<= np.uint64(32)
    at = 0
    for x in rows.column("counts").to_pylist():
        both[at : at + len(x) // 4] |= _codes(x)
        at += len(x) // 4
    both.sort()
    own = (both >> np.uint64(32)).astype(np.uint32)
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(own)), bool), own[1:] != own[:-1]]))
    both &= np.uint64(0xFFFFFFFF)
    n = np.add.reduceat(both, starts).astype(np.int64) if len(starts) else np.zeros(0, np.int64)
    own = own[starts]
    del both, starts
    own, n = own[n >= LEAST_COUNT], n[n >= LEAST_COUNT]
    levels = _level(n)
    size = max(64, int(levels.sum()) * ENTRY_BITS)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        deep = own[levels >= level]
        for at in range(0, len(deep), step):
            for probe in range(PROBES):
                bits[_places(deep[at : at + step], level, probe, size)] = True
    return pa.table(
        {
            "segment": rows.column("segment").slice(0, 1),
            "size": pa.array([size], pa.int64()),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
        }
    )


def _found(rows: pa.Table) -> pa.Table:
    """The levels that a segment's filter has for its bigrams, sent back to each chunk in the order they came in."""
    made = _segment(rows)
    filter_ = BigramFilter(np.zeros(1, np.int64), made.column("size").to_numpy(), np.frombuffer(made.column("bits")[0].as_py(), np.uint8))
    names = _parts(rows.column("names"))
    cuts = np.cumsum([0, *map(len, names)])
    parts = np.concatenate(names)
    levels = np.concatenate([filter_.levels(np.zeros(len(x), np.int64), x) for x in (parts[i : i + STEP] for i in range(0, len(parts), STEP))])
    return pa.table(
        {
            "chunk": rows.column("chunk"),
            "segment": rows.column("segment"),
            "levels": pa.array([levels[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
        }
    )


@dataclass
class BigramFilter:
    """Quantised counts of bigrams, found by probing level after level until one is missing."""

    starts: np.ndarray
    sizes: np.ndarray
    bits: np.ndarray

    def levels(self, home: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """The level of each hash within its segment; 0 is none."""
        out = np.zeros(len(parts), np.uint8)
        left = np.flatnonzero(self.sizes[home] > 0)
        for level in range(1, len(_LEVEL) + 1):
            for probe in range(PROBES):
                at = self.starts[home[left]] * 8 + _places(parts[left], level, probe, self.sizes[home[left]])
                left = left[(self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
            if not len(left):
                break
            out[left] = level
        return out

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        segments = len(self.sizes)
        return _COUNT[self.levels((hashes % np.uint64(segments)).astype(np.int64), _within(hashes, segments))]


def _score(chunk: pa.Table, back: pa.Table, words: int, segments: int, total: int, distinct: int) -> pa.Table:
    names = np.frombuffer(chunk.column("names")[0].as_py(), "<u8")
    counts = np.empty(len(names))
    rows = sorted(zip(*(back.column(c).to_pylist() for c in ("pairs", "segment", "low", "high")), strict=True), key=lambda r: r[:2])
    counts[_by_segment(names, words)[0]] = np.concatenate([_codes(a) + _codes(b) * 2.0**32 for pairs, _, a, b in rows if not pairs])
    codes, n = _codes(chunk.column("codes")[0].as_py()), chunk.column("lengths")[0].values.to_numpy()
    begins = np.cumsum(n) - n
    found, place = _grouped(_bigrams(names[codes], n))[:2]
    levels = np.empty(len(found), np.uint8)
    levels[_by_part(found, segments)[0]] = np.frombuffer(b"".join(a for pairs, _, a, _ in rows if pairs), np.uint8)
    del found, rows
    score = _COUNT[levels[place]]
    del place
    c = counts[codes]
    context = np.empty_like(c)
    context[1:] = c[:-1]
    context[begins] = counts[np.flatnonzero(names == _END)[0]]
    # from here on each array is worked on where it is: (min(seen, c, context) + PRIOR * base) / (context + PRIOR)
    np.minimum(score, c, out=score)
    np.minimum(score, context, out=score)
    context += PRIOR
    known = np.add.reduceat(c > 0, begins).astype(np.int64)
    base = c
    base += 0.5
    base /= total + 0.5 * (distinct + 1)
    score += PRIOR * base
    score /= context
    del context
    return pa.table(
        {
            "doc_id": chunk.column("ids")[0].values,
            "train": chunk.column("train")[0].values,
            "n_tokens": pa.array(n, pa.int64()),
            "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(len(n), total, np.int64)),
            "base_score": np.add.reduceat(np.log10(base, out=base), begins),
            "score": np.add.reduceat(np.log10(score, out=score), begins),
        }
    )


_SCORES = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _lean(group, *given) -> pa.Table:
    """What group makes; the memory that it took is handed back before the worker waits."""
    made = group(*given)
    hand_back()
    return made


def score_texts(docs: DataFrame, train: Column) -> DataFrame:
    """Score docs (doc_id, text) with a model of the rows for which train holds (null: it does not).

    Tokens are the words between ASCII blanks, A-Z lower-cased, and an end after each document. One
    row for each input row: doc_id, train, n_tokens, n_known (tokens that training has), train_tokens,
    base_score (log10 probability under unigrams smoothed by 0.5) and score, under the bigram model:
    (count of the bigram + PRIOR * unigram probability) / (count of the context + PRIOR), where bigram
    counts come from the filter. Every training bigram has an entry, those seen once included, and the
    number of filter segments grows with the tokens.

    Null, empty and blank texts have the end token only. Rows that repeat a doc_id are scored each,
    and without training rows every count is 0. Other columns are ignored.

    Texts are read once and kept as chunks of codes with a dictionary each; unigram counts go to
    and from chunks by segments of the hash space, and so do a chunk's distinct bigrams and the levels
    that their segment of the filter has for them. No vocabulary or filter is broadcast or collected.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    chunks = materialize(rows.mapInArrow(_chunks, _CHUNK))
    tokens = chunks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0]
    if not tokens:
        return spark.createDataFrame([], _SCORES)
    words = max(8, -(-tokens // WORD_TOKENS))
    entries = chunks.select("chunk", "names", "counts").mapInArrow(lambda it: _entries(it, words), _ROWS)
    known = materialize(entries.groupBy("segment").applyInArrow(lambda rows: _lean(_unigrams, rows), _KNOWN))
    total, distinct = known.agg(F.sum("total"), F.sum("distinct")).first()
    segments = max(8, -(-tokens // BIGRAM_TOKENS))
    counted = chunks.select("chunk", "train", "lengths", "codes", "names").mapInArrow(lambda it: _counted(it, segments), _ROWS)
    found = counted.groupBy("segment").applyInArrow(lambda rows: _lean(_found, rows), "chunk long, segment int, levels binary")

    def score(chunk: pa.Table, back: pa.Table) -> pa.Table:
        return _lean(_score, chunk, back, words, segments, total, distinct)

    own = chunks.select("chunk", "ids", "train", "lengths", "codes", "names")
    none = F.lit(None).cast("binary")
    back = known.select("chunk", F.lit(False).alias("pairs"), "segment", "low", "high").unionByName(
        found.select("chunk", F.lit(True).alias("pairs"), "segment", F.col("levels").alias("low"), none.alias("high"))
    )
    return own.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(score, _SCORES)
