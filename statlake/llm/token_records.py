"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

A file is a run of records; a record is the payload's length (8 bytes), the masked CRC-32C of these
8 bytes (4), the payload, and its masked CRC-32C (4), all little-endian. A payload is the doc_id
(8 bytes) and the ids, of 2 bytes each if the vocabulary fits, else 4.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statlake.llm.common import materialize, scratch, ship, slices
from statlake.llm.ordered import block_bounds, block_of, by_blocks, order_key

#: The id after each document.
END = 0
#: Words whose ids a worker keeps, about at most (some 200 bytes each).
CACHE = 1_500_000
#: Stands for a null doc_id in a payload.
NO_ID = -(1 << 63)

_LANE = 512
_JOINED = 1000
#: White space other than the space itself. Next to a space, the ids of words depend on each other.
_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def _tables(n: int) -> np.ndarray:
    """Reflected CRC-32C of each byte followed by 0 .. n - 1 zero bytes."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = (first >> np.uint32(1)) ^ np.where(first & np.uint32(1), np.uint32(0x82F63B78), np.uint32(0))
    out = [first]
    for _ in range(n - 1):
        out.append((out[-1] >> np.uint32(8)) ^ first[out[-1] & np.uint32(255)])
    return np.stack(out)


_T = _tables(4)
#: What a lane of zero bytes makes of each byte of a checksum.
_SHIFT = [[int(x) for x in row] for row in _tables(_LANE)[_LANE - 4 : _LANE][::-1]]


def crc32c(payloads: list[bytes]) -> np.ndarray:
    """CRC-32C of byte strings of at least 4 bytes, all lanes of all strings at once."""
    if not payloads:
        return np.zeros(0, np.uint32)
    counts = [-(-len(p) // _LANE) for p in payloads]
    whole = np.zeros(sum(counts) * _LANE, np.uint8)
    at = 0
    for p, n in zip(payloads, counts, strict=True):
        at += n * _LANE
        own = whole[at - len(p) : at]
        own[:] = np.frombuffer(p, np.uint8)
        own[:4] ^= 255  # the initial value of the checksum; zero bytes ahead change nothing
    lanes = np.ascontiguousarray(whole.view("<u4").reshape(-1, _LANE // 4).T)
    crc = np.zeros(lanes.shape[1], np.uint32)
    for word in lanes:
        x = crc ^ word
        crc = _T[3][x & 255] ^ _T[2][(x >> 8) & 255] ^ _T[1][(x >> 16) & 255] ^ _T[0][x >> 24]
    a, b, c, d = _SHIFT
    out, at, parts = np.empty(len(payloads), np.uint32), 0, crc.tolist()
    for i, n in enumerate(counts):
        value = 0
        for lane in parts[at : at + n]:
            value = a[value & 255] ^ b[(value >> 8) & 255] ^ c[(value >> 16) & 255] ^ d[value >> 24] ^ lane
        out[i], at = value ^ 0xFFFFFFFF, at + n
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def _odd(text: str) -> bool:
    if text[:1] == " " or text[-1:] == " " or "  " in text:
        return True
    return any(c in text and (f" {c}" in text or f"{c} " in text) for c in _WHITE)


class _Numbers(dict):
    """Numbers words as they are asked for; new ones wait in a list."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Encodes as the tokenizer does, each word once: words do not depend on each other across a space."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self.begins = np.array([(self.tokenizer.id_to_token(i) or "").startswith(space) for i in range(size)])
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.pool = np.zeros(1 << 16, self.kind)
        self.edges = np.zeros(1, np.int64)

    def _learn(self) -> None:
        """Ids of the new words, which are joined by spaces: the ids that begin with one begin a word."""
        new, self.numbers.new = self.numbers.new, []
        texts = [" " + " ".join(new[i : i + _JOINED]) for i in range(0, len(new), _JOINED)]
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, self.kind) for x in done])
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(new):
            raise ValueError("the tokenizer does not cut its input at spaces")
        used = int(self.edges[-1])
        if used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[:used], np.zeros(used + 2 * len(ids), self.kind)])
        self.pool[used : used + len(ids)] = ids
        self.edges = np.concatenate([self.edges[:-1], used + starts, [used + len(ids)]])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.numbers) > CACHE:
            self._clear()
        if not texts:
            return []
        plain = ["" if _odd(t) else t for t in texts]
        # odd texts whole, else what is ahead of the first space
        heads = self.tokenizer.encode_batch_fast(
            [p[: p.find(" ")] if " " in p else t for t, p in zip(texts, plain, strict=True)], add_special_tokens=False
        )
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        starts = split.offsets.to_numpy()
        counts = np.diff(starts) - 1
        rest = np.ones(int(starts[-1]), bool)
        rest[starts[:-1]] = False
        # each distinct word is looked up once
        words = split.values.dictionary_encode()
        places = words.indices.to_numpy()[rest]
        used = np.zeros(len(words.dictionary), bool)
        used[places] = True
        names = words.dictionary.filter(pa.array(used)).to_pylist()
        numbers = np.zeros(len(used), np.int64)
        numbers[used] = np.fromiter(map(self.numbers.__getitem__, names), np.int64, len(names))
        words = numbers[places]
        if self.numbers.new:
            self._learn()
        lengths = (self.edges[1:] - self.edges[:-1])[words]
        ends = np.cumsum(lengths)
        at = np.repeat(self.edges[words] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
        ids = self.pool[at]
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [
            np.array(head.ids, self.kind).tobytes() + ids[a:b].tobytes()
            for head, a, b in zip(heads, cuts, cuts[1:], strict=False)
        ]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _written(batches: Iterable[pa.RecordBatch], tokenizer: str, folder: str) -> Iterator[pa.RecordBatch]:
    """Write one file for each block; a file of a lost attempt has a name that no index row holds."""
    encoder = _encoder(tokenizer)
    store, root = fs.FileSystem.from_uri(folder)
    end = np.array([END], encoder.kind).tobytes()
    block, name, sink, offset, before = None, "", None, 0, 0
    try:
        for batch in slices(batches, "text"):
            blocks, ids = (batch.column(c).to_pylist() for c in ("block", "doc_id"))
            payloads = [
                np.array([NO_ID if i is None else i], "<i8").tobytes() + own + end
                for i, own in zip(ids, encoder.encode(batch.column("text").to_pylist()), strict=True)
            ]
            sizes = [np.array([len(p)], "<u8").tobytes() for p in payloads]
            size_sums, sums = (masked(crc32c(x)).astype("<u4") for x in (sizes, payloads))
            rows: list[tuple] = []
            for i, payload in enumerate(payloads):
                if blocks[i] != block:
                    if sink is not None:
                        sink.close()
                    block, offset, before = blocks[i], 0, 0
                    name = f"block-{block:07d}-{uuid.uuid4().hex}.records"
                    sink = store.open_output_stream(f"{root}/{name}")
                sink.write(b"".join((sizes[i], size_sums[i].tobytes(), payload, sums[i].tobytes())))
                count = (len(payload) - 8) // encoder.kind.itemsize
                rows.append((block, name, offset, len(payload), before, count, encoder.kind.itemsize))
                offset += len(payload) + 16
                before += count
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4, pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["block", "file", "offset", "length", "before", "n_tokens", "width"],
            )
    finally:
        if sink is not None:
            sink.close()


def write_records(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Encode docs (doc_id, text) and write them in ascending doc_id order below folder.

    Returns the index, a Parquet table in folder/index: block, file, offset and length (of a record's
    payload), before (ids ahead of it in its block), n_tokens, width. A null text is empty; each
    document ends with END. A null doc_id comes first; rows that repeat one are ordered by text and
    written each. An empty table gives an empty index. tokenizer is the path of a tokenizers file.
    Blocks are ranges of (doc_id, text) of about equal bytes in ascending order, each written by a task of its own; a document's place in the whole is the ids of all
    earlier blocks and `before`. folder is a URI that all executors share and pyarrow can write to.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bounds = block_bounds(rows)
    rows = rows.withColumn("order", order_key()).withColumn("block", block_of(bounds))
    dealt = by_blocks(rows, bounds, "order", "text").select("block", "doc_id", "text")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{root}/data")
    kind = "block int, file string, offset long, length long, before long, n_tokens long, width int"
    index = dealt.mapInArrow(lambda it: _written(it, tokenizer, f"{folder}/data"), kind)
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(kind).parquet(f"{folder}/index")


def _read(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(folder)
    name, source = "", None
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            frames, payloads = [], []
            for i in range(batch.num_rows):
                if columns["file"][i] != name:
                    name = columns["file"][i]
                    source = store.open_input_file(f"{root}/{name}")
                record = bytes(source.read_at(columns["length"][i] + 16, columns["offset"][i]))
                frames.append(record)
                payloads.append(record[12:-4])
            sizes = [r[:8] for r in frames]
            good = [int.from_bytes(s, "little") == len(p) for s, p in zip(sizes, payloads, strict=True)]
            good = np.array(good) & (masked(crc32c(sizes)) == np.array([int.from_bytes(r[8:12], "little") for r in frames], np.uint32))
            good &= masked(crc32c(payloads)) == np.array([int.from_bytes(r[-4:], "little") for r in frames], np.uint32)
            if not good.all():
                raise ValueError(f"damaged record in {name}")
            ids = [int.from_bytes(p[:8], "little", signed=True) for p in payloads]
            tokens = [np.frombuffer(p, f"<u{w}", offset=8).astype("<u4") for p, w in zip(payloads, columns["width"], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None if x == NO_ID else x for x in ids], pa.int64()),
                    batch.column("block"),
                    batch.column("before"),
                    pa.array([len(t) for t in tokens], pa.int64()),
                    pa.array([zlib.crc32(t.tobytes()) for t in tokens], pa.int64()),
                ],
                names=["doc_id", "block", "before", "n_tokens", "ids_crc32"],
            )


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Read records through the index, in whatever order its rows come; checksums are verified.

    Returns doc_id, start (ids of all documents before it), n_tokens and ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers). A damaged record raises an error.
    """
    ship(index.sparkSession)
    totals = index.groupBy("block").agg(F.sum("n_tokens").alias("n"))
    ahead = F.sum("n").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    totals = materialize(totals.select("block", F.coalesce(ahead, F.lit(0)).alias("ahead")))
    rows = index.mapInArrow(lambda it: _read(it, f"{folder}/data"), "doc_id long, block int, before long, n_tokens long, ids_crc32 long")
    return rows.join(totals, "block").select("doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_records(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write docs to a new shared folder and read them back."""
    folder = scratch(docs.sparkSession)
    return read_records(write_records(docs, tokenizer, folder), folder)
