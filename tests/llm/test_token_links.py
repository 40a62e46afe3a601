"""Alignment of two tokenizers against the libraries themselves, text by text and pair by pair."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import KIND, ODD

from statlake.llm import token_links as tl
from statlake.llm.common import read
from statlake.llm.queries import QUERIES
from statlake.llm.token_links import Aligner, token_links

FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def paths():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides(paths):
    import sentencepiece
    from tokenizers import Tokenizer

    bpe, piece = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    bpe.encode_special_tokens = True
    letters = tl._byte_letters()

    def side_a(text):
        found = bpe.encode(" " + text, add_special_tokens=False)
        return [(i, bytes(letters[c] for c in t)) for i, t in zip(found.ids, found.tokens, strict=True)]

    def side_b(text):
        return [(i, bytes([int(piece.id_to_piece(i)[3:-1], 16)]) if piece.is_byte(i) else piece.id_to_piece(i).replace("▁", " ").encode()) for i in piece.encode(text)]

    return side_a, side_b


def groups(sides, text):
    """The groups of a whole text, each a pair of id lists; none if a side does not give it back."""
    if not text:
        return []
    a, b = sides[0](text), sides[1](text)
    if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
        return []
    ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
    found, cut = [([], [])], ends[0] & ends[1]
    for at, side in enumerate((a, b)):
        own, end = 0, 0
        for i, x in side:
            if own == len(found):
                found.append(([], []))
            found[own][at].append(i)
            end += len(x)
            own += end in cut
    return found


def plain(sides, rows):
    all_groups = [groups(sides, text) for _, text in rows]
    links = [collections.Counter((x, y) for a, b in g for x in a for y in b) for g in all_groups]
    documents = collections.Counter(p for own in links for p in own)
    most = collections.Counter()
    for (x, _), n in documents.items():
        most[x] = max(most[x], n)
    found = []
    for (doc_id, _), g, own in zip(rows, all_groups, links, strict=True):
        joined = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        sha = hashlib.sha256(joined.encode()).hexdigest() if g else ""
        best = sum(n for p, n in own.items() if documents[p] == most[p[0]])
        found.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), own.total(), best, sum(n * documents[p] for p, n in own.items()), sha))
    return found


def by_id(rows):
    return sorted((tuple(r[f] for f in FIELDS) if hasattr(r, "__fields__") else r for r in rows), key=lambda r: (r[0] is not None, r))


STRANGE = [
    " leads", "ends ", "  two", "a  b", "a\nb \n c", "\n", " ", "x\t y", "<|endoftext|> <s> <0x41>", "日本語のテキスト", "日本 語",
    "a▁b", "▁", "é x", "é", "😀😃 👨‍👩‍👧", "a\x00b", "don't we'll", "1234567 8 9", "aaaaaaaaaaaaaaaaaaaaaaaaa", "x　y  z", "ﬁ ½ ²", "\x1c \x1d", "a \x85 b", "﻿bom ​",
]


def test_strange_texts_equal_the_libraries(spark, documents, paths, sides):
    rows = [(i, t) for i, t in enumerate(STRANGE)] + [(None, "the null"), (None, "the null"), (7, "twice"), (7, "twice")]
    assert by_id(token_links(documents(rows), *paths).collect()) == by_id(plain(sides, rows))


def test_odd_rows_in_small_chunks_and_merges(spark, documents, paths, sides, monkeypatch):
    for name, value in (("CHUNK_BYTES", 100), ("CHUNK_ROWS", 2), ("FAN", 2), ("FRAME", 3), ("RADIX", 4)):
        monkeypatch.setattr(tl, name, value)
    rng = random.Random(5)
    vocabulary = [w for t in STRANGE for w in t.split()] + ["the", "und", "Straße", "naïve"]
    rows = [(r[0], r[1]) for r in ODD] + [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(40)))) for i in range(100, 160)]
    frame = documents(rows).selectExpr("*", "1 AS chunk", "2 AS radix", "3 AS n_a", "4 AS records").repartition(9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)  # tasks make several chunks
    try:
        assert by_id(token_links(frame, *paths).collect()) == by_id(plain(sides, rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_small_caches_change_nothing(paths, sides, monkeypatch):
    monkeypatch.setattr(tl, "CACHE", 3)
    monkeypatch.setattr(tl, "_JOINED", 2)
    aligner = Aligner(*paths)
    for _ in range(2):
        for text in [*STRANGE, "one two three four five six"]:
            counts, hashes, _, pairs, links = aligner.align([text, None, text])
            want = plain(sides, [(0, text)])[0]
            assert counts.tolist() == [list(want[1:5]), [0] * 4, list(want[1:5])] and hashes == [want[7], "", want[7]]
            assert links.sum() == 2 * want[4] and (pairs >= 0).all()


def test_texts_that_a_side_does_not_give_back(paths, monkeypatch):
    aligner = Aligner(*paths)
    lost = aligner.bpe.encode(" lost", add_special_tokens=False).ids[0]
    aligner.bytes_a[lost] = b"?"
    counts, hashes, text, _, _ = aligner.align(["all is lost", "all is well"])
    assert counts[0].tolist() == [0] * 4 and hashes[0] == "" and counts[1].all() and set(text.tolist()) == {1}


def test_heap_merge_equals_a_counter(monkeypatch):
    monkeypatch.setattr(tl, "FRAME", 4)
    rng = np.random.default_rng(1)
    total, runs = collections.Counter(), []
    for _ in range(9):
        pairs = np.unique(rng.integers(0, 60, 30))
        counts = rng.integers(1, 2**40, len(pairs))
        total.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
        runs.append({"radix": 1, "parent": 2, "frames": tl._run(pairs, counts)})
    merged = tl._merged(pa.Table.from_pylist(runs)).to_pylist()[0]
    pairs, counts = tl._whole(merged["frames"], 2)
    assert (pairs.tolist(), counts.tolist()) == tuple(map(list, zip(*sorted(total.items()), strict=True)))


def test_empty_tables(spark, documents, paths):
    assert token_links(documents([(1, "x")]).limit(0), *paths).collect() == []
    got = token_links(documents([(1, None), (2, "")]), *paths).collect()
    assert by_id(got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_equals_brute_force(spark, sides):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    assert by_id(QUERIES["op13_token_links"](spark, sf_dir).collect()) == by_id(plain(sides, rows))
