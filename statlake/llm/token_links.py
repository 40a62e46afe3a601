"""Alignment of two tokenizers: which ids of one go with which ids of the other, over all documents.

Both tokenizers cut a text into tokens; where a token of either side ends at the same byte, a group
ends, and all pairs of tokens of the two sides in a group are linked. The work goes in three steps:

* Each task aligns its documents, in chunks of bounded size. A chunk's records (pair, document, links)
  are sorted by pair, first side first, and packed as one zstd run that stays where it is written. Its
  distinct pairs with the number of documents that hold each are radix-partitioned by the first
  side's id into small zstd runs.
* The runs of a partition are merged by a k-way heap, FAN of them at a time, and those results
  again, until each partition is one run with the corpus-wide counts. As all pairs of a first id
  stand side by side there, its highest count is known as its pairs go by.
* Counts and marks of the highest go back along the same merges to each chunk, which adds them up
  over its records for each document.

Runs hold a pair once for each chunk, however many documents have it, so frequent pairs are no hot
keys; no task holds more than FAN runs of one partition, or one chunk and its answers.

Both tokenizers treat words that follow a single blank independently, so each distinct word is
tokenized and aligned once for a worker's cache; what both make of a word is checked byte by byte.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte by
byte, have no tokens: all numbers 0, groups_sha256 ''. Rows that repeat are documents of their
own; null ids are kept; ties for the highest count are all best; tables may be empty and have further columns.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import materialize, ship, slices

#: Text bytes and rows of a chunk, about; a longer text makes a chunk of its own.
CHUNK_BYTES, CHUNK_ROWS = 8 << 20, 1 << 16
#: Radix partitions of the first side's ids, runs that are merged at once, pairs of a frame.
RADIX, FAN, FRAME = 64, 64, 1 << 14
#: Words that a worker keeps, about at most (some 350 bytes each).
CACHE = 400_000

_JOINED = 500
#: A blank between words that neither other white space nor another blank touches.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_TOUCHING = re.compile(r" \s|\s ")
_TOUCHING_ASCII = tuple(x for c in " \t\n\x0b\f\r\x1c\x1d\x1e\x1f" for x in (f" {c}", f"{c} "))
_MARK = "▁"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def _words(text: str) -> list[str]:
    """A text cut at the blanks that stand alone between words."""
    if " " in (text[0], text[-1]):
        return _CUT.split(text)
    touching = any(x in text for x in _TOUCHING_ASCII) if text.isascii() else _TOUCHING.search(text)
    return _CUT.split(text) if touching else text.split(" ")


class _Words(dict):
    """Numbers words as they are asked for; new ones wait in a list."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Aligner:
    """Groups and linked pairs of texts under a byte-level tokenizer and a sentencepiece model."""

    def __init__(self, bpe_path: str, piece_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.bpe = Tokenizer.from_file(bpe_path)
        self.bpe.encode_special_tokens = True
        self.piece = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = _byte_letters()
        n = self.bpe.get_vocab_size()
        tokens = [self.bpe.id_to_token(i) or "" for i in range(n)]
        self.bytes_a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else b"" for t in tokens]
        self.size_b = self.piece.get_piece_size()
        self.bytes_b = [self._piece_bytes(i) for i in range(self.size_b)]
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.names = [str(i) for i in range(max(n, self.size_b))]
        self._clear()

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.piece.id_to_piece(i)
        if self.piece.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return b"" if self.piece.is_control(i) or self.piece.is_unknown(i) else piece.replace(_MARK, " ").encode()

    def _clear(self) -> None:
        self.words = _Words()
        self.groups: list[str] = []
        self.counts = np.zeros((0, 5), np.int64)  # tokens of either side, groups, links, 1 if it fails
        self.edges = np.zeros(1, np.int64)
        self.pairs, self.links = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _learn(self) -> None:
        """Align the new words: joined by blanks where that changes nothing, in their order."""
        new, self.words.new = self.words.new, []
        batch: list[list[str]] = [[]]
        for word in new:
            if word[0].isspace() or word[-1].isspace():
                batch += [[word], []]
            else:
                if len(batch[-1]) == _JOINED:
                    batch.append([])
                batch[-1].append(word)
        batch = [x for x in batch if x]
        ids = self._tokens(batch)
        if any(x is None for x in ids):  # find the words that do not come back
            batch = [own for x, done in zip(batch, ids, strict=True) for own in ([x] if done else [[w] for w in x])]
            ids = self._tokens(batch)
        self._keep(batch, ids)

    def _tokens(self, batch: list[list[str]]) -> list[tuple[list[int], list[int]] | None]:
        texts = [" ".join(x) for x in batch]
        side_a = self.bpe.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        side_b = self.piece.encode(texts, num_threads=1)
        found = []
        for text, a, b in zip(texts, side_a, side_b, strict=True):
            whole, a = (" " + text).encode(), a.ids
            same = b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b))
            found.append((a, b) if same and _MARK not in text else None)
        return found

    def _keep(self, batch: list[list[str]], ids: list) -> None:
        a = np.array([i for x in ids if x for i in x[0]], np.int64)
        b = np.array([i for x in ids if x for i in x[1]], np.int64)
        good = [w for x, done in zip(batch, ids, strict=True) if done for w in x]
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        word_ends = np.cumsum([len(w.encode()) + 1 for w in good]) if good else np.zeros(0, np.int64)
        if not np.isin(word_ends, common).all():
            raise ValueError("a tokenizer does not cut its input at blanks")
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        n_a, n_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        word = np.searchsorted(word_ends, common)  # of each group
        own = np.zeros((len(good), 5), np.int64)
        for column, values in enumerate((n_a, n_b, np.ones(len(common), np.int64), n_a * n_b)):
            np.add.at(own[:, column], word, values)
        pairs, links, per_group = self._pairs(group_a, a, group_b, b, len(common))
        per_word = np.zeros(len(good), np.int64)
        np.add.at(per_word, word, per_group)

        names, texts, i, j = self.names, [[] for _ in good], 0, 0
        a, b = a.tolist(), b.tolist()
        for w, x, y in zip(word.tolist(), n_a.tolist(), n_b.tolist(), strict=True):
            if x == y == 1:
                texts[w].append(f"{names[a[i]]}|{names[b[j]]}")
            else:
                texts[w].append(",".join([names[k] for k in a[i : i + x]]) + "|" + ",".join([names[k] for k in b[j : j + y]]))
            i, j = i + x, j + y

        # words in the order in which they were numbered, those that fail among them
        failed = np.array([done is None for x, done in zip(batch, ids, strict=True) for _ in x], bool)
        counts, sizes = np.zeros((len(failed), 5), np.int64), np.zeros(len(failed), np.int64)
        counts[failed, 4] = 1
        counts[~failed], sizes[~failed] = own, per_word
        joined = iter(texts)
        self.groups += ["" if f else ";".join(next(joined)) for f in failed.tolist()]
        self.counts = np.concatenate([self.counts, counts])
        used = int(self.edges[-1])
        if used + len(pairs) > len(self.pairs):
            more = np.zeros(used + 2 * len(pairs), np.int64)
            self.pairs, self.links = np.concatenate([self.pairs[:used], more]), np.concatenate([self.links[:used], more])
        self.pairs[used : used + len(pairs)], self.links[used : used + len(pairs)] = pairs, links
        self.edges = np.concatenate([self.edges, used + np.cumsum(sizes)])

    def _pairs(self, group_a, a, group_b, b, n):
        """Distinct pairs of each group with their links; a group's ids are first counted on either side."""
        wide = max(len(self.bytes_a), self.size_b)
        key_a, times_a = np.unique(group_a * wide + a, return_counts=True)
        key_b, times_b = np.unique(group_b * wide + b, return_counts=True)
        per_b = np.bincount(key_b // wide, minlength=n)
        repeat = per_b[key_a // wide]
        first = np.cumsum(per_b) - per_b
        at_a = np.repeat(np.arange(len(key_a)), repeat)
        at_b = np.arange(len(at_a)) - np.repeat(np.cumsum(repeat) - repeat, repeat) + first[key_a[at_a] // wide]
        pairs = key_a[at_a] % wide * self.size_b + key_b[at_b] % wide
        return pairs, times_a[at_a] * times_b[at_b], np.bincount(key_a[at_a] // wide, minlength=n)

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """For each text its counts (tokens of either side, groups, links) and the hash of its groups; and
        for all of them the linked pairs: text, pair, links."""
        if len(self.words) > CACHE:
            self._clear()
        split = [[] if not t or _MARK in t else _words(t) for t in texts]
        lengths = np.array([len(s) for s in split], np.int64)
        words = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum()))
        if self.words.new:
            self._learn()
        stops = np.cumsum(lengths)
        sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.counts[words], axis=0)])
        counts = sums[stops] - sums[stops - lengths]
        good = (counts[:, 4] == 0) & (lengths > 0)
        counts[~good] = 0
        hashes, numbers, groups = [], words.tolist(), self.groups
        for ok, stop, n in zip(good.tolist(), stops.tolist(), lengths.tolist(), strict=True):
            own = ";".join([groups[w] for w in numbers[stop - n : stop]]) if ok else ""
            hashes.append(hashlib.sha256(own.encode()).hexdigest() if ok else "")
        text = np.repeat(np.arange(len(texts)), lengths)
        keep = good[text]
        text, words = text[keep], words[keep]
        many = self.edges[words + 1] - self.edges[words]
        at = np.arange(int(many.sum())) + np.repeat(self.edges[words] - (np.cumsum(many) - many), many)
        return counts[:, :4], hashes, np.repeat(text, many), self.pairs[at], self.links[at]


# zstd frames of rising whole numbers and of numbers beside them


def _packed(values: np.ndarray) -> bytes:
    """Byte planes, so that the many high zero bytes cost nothing."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.int64)


def _run(pairs: np.ndarray, *beside: np.ndarray) -> list[bytes]:
    """A run in frames: pairs as gaps, then each column beside them."""
    frames = []
    for at in range(0, len(pairs), FRAME):
        own = pairs[at : at + FRAME]
        frames += [_packed(np.diff(own, prepend=0)), *(_packed(x[at : at + FRAME]) for x in beside)]
    return frames


def _frames(frames: list[bytes], columns: int) -> Iterator[list[np.ndarray]]:
    for at in range(0, len(frames), columns):
        gaps, *beside = map(_unpacked, frames[at : at + columns])
        yield [np.cumsum(gaps), *beside]


def _whole(frames: list[bytes], columns: int) -> list[np.ndarray]:
    parts = list(_frames(frames, columns))
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * columns


def _entries(frames: list[bytes]) -> Iterator[tuple[int, int]]:
    for pairs, counts in _frames(frames, 2):
        yield from zip(pairs.tolist(), counts.tolist(), strict=True)


_CHUNKS = pa.schema(
    [
        ("chunk", pa.int64()),
        ("radix", pa.int32()),
        ("frames", pa.list_(pa.binary())),
        ("records", pa.list_(pa.binary())),
        ("doc_id", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("groups_sha256", pa.list_(pa.string())),
    ]
)
_CHUNK_COLUMNS = "chunk long, radix int, frames array<binary>, records array<binary>, doc_id array<long>, counts array<long>, groups_sha256 array<string>"


def _aligner(bpe_path: str, piece_path: str) -> Aligner:
    global _held
    if _held is None or _held[0] != (bpe_path, piece_path):
        _held = ((bpe_path, piece_path), Aligner(bpe_path, piece_path))
    return _held[1]


_held = None


def _chunks(bpe_path: str, piece_path: str):
    """Align a task's documents: for each chunk a row of its own and one for each radix partition."""

    def packed(number: int, held: list, size_b: int) -> pa.RecordBatch:
        ids, counts, hashes = [], [], []
        keys, links, n = [], [], sum(len(x[0]) for x in held)
        for own, (own_counts, own_hashes, text, pairs, own_links) in held:
            keys.append(pairs * n + text + len(ids))
            links.append(own_links)
            ids += own
            counts.append(own_counts)
            hashes += own_hashes
        keys, links = np.concatenate(keys), np.concatenate(links)
        order = np.argsort(keys)
        keys, links = keys[order], links[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, links = keys[first], np.add.reduceat(links, first) if len(first) else links
        pairs, documents = np.unique(keys // n, return_counts=True)
        radix = pairs // size_b % RADIX
        rows = [{"chunk": number, "records": _run(keys, links), "doc_id": ids, "counts": np.concatenate(counts).ravel().tolist(), "groups_sha256": hashes}]
        for r in np.unique(radix).tolist():
            own = radix == r
            rows.append({"chunk": number, "radix": r, "frames": _run(pairs[own], documents[own])})
        return pa.RecordBatch.from_pylist(rows, schema=_CHUNKS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(bpe_path, piece_path)
        number, held, size, rows = TaskContext.get().partitionId() << 32, [], 0, 0
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            own = batch.column("text").nbytes
            if held and (size + own > CHUNK_BYTES or rows + len(texts) > CHUNK_ROWS):
                yield packed(number, held, aligner.size_b)
                number, held, size, rows = number + 1, [], 0, 0
            held.append((batch.column("doc_id").to_pylist(), aligner.align(texts)))
            size, rows = size + own, rows + len(texts)
        if held:
            yield packed(number, held, aligner.size_b)

    return run


_RUN = "radix int, node long, frames array<binary>"
_RUNS = pa.schema([("radix", pa.int32()), ("node", pa.int64()), ("frames", pa.list_(pa.binary()))])


def _merged(table: pa.Table) -> pa.Table:
    """A k-way heap merge of runs: each pair once, its counts added up."""
    radix, node = table.column("radix")[0].as_py(), table.column("parent")[0].as_py()
    frames, pairs, counts, last = [], [], [], -1
    for pair, n in heapq.merge(*map(_entries, table.column("frames").to_pylist())):
        if pair == last:
            counts[-1] += n
            continue
        if len(pairs) == FRAME:
            frames += _run(np.array(pairs), np.array(counts))
            pairs, counts = [], []
        last = pair
        pairs.append(pair)
        counts.append(n)
    frames += _run(np.array(pairs, np.int64), np.array(counts, np.int64))
    return pa.Table.from_pylist([{"radix": radix, "node": node, "frames": frames}], schema=_RUNS)


def _with_maxima(size_b: int):
    """Runs of whole partitions: mark each pair that has the highest count of its first id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, counts = _whole(row["frames"], 2)
                first = np.flatnonzero(np.diff(pairs // size_b, prepend=-1))
                most = np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(pairs)))
                row["frames"] = _run(pairs, counts, counts == most)
                yield pa.RecordBatch.from_pylist([row], schema=_RUNS)

    return run


def _answered(table: pa.Table) -> pa.Table:
    """Hand the counts and marks of a merged run on to the runs that it came from."""
    answer, children = None, []
    for row in table.to_pylist():
        if row["answers"]:
            answer = _whole(row["frames"], 3)
        else:
            children.append(row)
    done = []
    for row in children:
        pairs, _ = _whole(row["frames"], 2)
        at = np.searchsorted(answer[0], pairs)
        done.append({"radix": row["radix"], "node": row["node"], "frames": _run(pairs, answer[1][at], answer[2][at])})
    return pa.Table.from_pylist(done, schema=_RUNS)


COLUMNS = ("n_a", "n_b", "n_groups", "n_links")
_RESULT = ", ".join(f"{c} long" for c in ("doc_id", *COLUMNS, "n_best", "count_sum")) + ", groups_sha256 string"


def _documents(table: pa.Table) -> pa.Table:
    """Add up the answers to a chunk over its records, for each document."""
    own, answers = None, []
    for row in table.to_pylist():
        if row["radix"] is None:
            own = row
        else:
            answers.append(_whole(row["frames"], 3))
    n = len(own["doc_id"])
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if answers:
        pairs, counts, highest = (np.concatenate(x) for x in zip(*answers, strict=True))
        order = np.argsort(pairs)
        for keys, links in _frames(own["records"], 2):
            at = order[np.searchsorted(pairs, keys // n, sorter=order)]
            np.add.at(best, keys % n, links * highest[at])
            np.add.at(total, keys % n, links * counts[at])
    counts = np.array(own["counts"], np.int64).reshape(n, len(COLUMNS))
    columns = [pa.array(own["doc_id"], pa.int64()), *(pa.array(c) for c in counts.T), pa.array(best), pa.array(total), pa.array(own["groups_sha256"], pa.string())]
    return pa.table(columns, names=["doc_id", *COLUMNS, "n_best", "count_sum", "groups_sha256"])


def token_links(docs: DataFrame, bpe_path: str, piece_path: str) -> DataFrame:
    """One row for each document (doc_id, text): tokens of either side, groups and links, the links
    whose pair has the highest count of its first id, and the sum of the counts over all links. A pair's
    count is the number of documents that hold it linked."""
    import sentencepiece

    spark = docs.sparkSession
    ship(spark)
    size_b = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    found = materialize(texts.mapInArrow(_chunks(bpe_path, piece_path), _CHUNK_COLUMNS))
    chunks = found.filter("radix IS NULL").drop("frames")
    level = found.filter("radix IS NOT NULL").select("radix", F.col("chunk").alias("node"), "frames")

    levels, n = [], chunks.count()
    while n > 1 or not levels:
        n = max(1, -(-n // FAN))
        levels.append(level.withColumn("parent", F.pmod(F.xxhash64("node"), F.lit(n)).cast("long")))
        level = materialize(levels[-1].groupBy("radix", "parent").applyInArrow(_merged, _RUN))
    answers = level.mapInArrow(_with_maxima(size_b), _RUN)
    for children in reversed(levels):
        rows = children.withColumn("answers", F.lit(False))
        rows = rows.unionByName(answers.select("radix", "node", "frames", F.col("node").alias("parent"), F.lit(True).alias("answers")))
        answers = rows.groupBy("radix", "parent").applyInArrow(_answered, _RUN)
    back = answers.select(F.col("node").alias("chunk"), "radix", "frames")
    return chunks.unionByName(back, allowMissingColumns=True).groupBy("chunk").applyInArrow(_documents, _RESULT)
