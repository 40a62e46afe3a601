"""Extraction, token records, language model, fingerprints and toxicity against plain versions."""

import collections
import hashlib
import math
import random
import struct
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import ODD
from llm.test_near_dedup import words

from statlake.llm import ngram_filter, ordered, toxicity
from statlake.llm.html_extract import extract_main_text, labelled_blocks, main_text, trained_tree
from statlake.llm.ngram_filter import score_texts
from statlake.llm.token_records import Encoder, crc32c, masked, read_records, write_records
from statlake.llm.toxicity import fit_toxicity, score_toxicity, segments
from statlake.llm.weighted_sampling import SAMPLES, weighted_fingerprints

# extraction


def test_tree_fits_its_labelled_table():
    rows, labels = labelled_blocks()
    assert ((trained_tree().predict(rows) >= 0.5) == labels).all()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><head><title>T</title></head><body></body></html>", ""),
        ("<nav><a>Home</a></nav><article><h1>A &amp; B</h1><p>one\n two<b>three</b> <i>x</i><br>y<p>z</article><footer>f</footer>", "A & B\none twothree x y\nz"),
        ("<body><article><p>a<script>var p='</p>';</script>b<!-- c <p> --><style>d</style></p><form><p>mail</p></form><p>&#233;&nbsp;&lt;q&gt;</p>", "ab\né <q>"),
        ("<main><p>in</p><aside><p>side</p></aside><div class='cookie-notice'>we use cookies</div><p>in again</p></main><section id=comments><p>first!</p></section>", "in\nin again"),
        ("<article><p>kept</p><div class='adBanner'>buy</div><div hidden>gone</div><p>cut <a href='x", "kept\ncut"),
        ("<ARTICLE><P CLASS=lead>Up</P></ARTICLE><DIV ROLE=contentinfo>away</DIV>", "Up"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


LONG = "word " * 60


@pytest.mark.parametrize(
    ("page", "kept"),
    [
        ("<body class='single has-sidebar'><article><p>{0}</p></article></body>", True),
        ("<html class='no-search'><body id=search><article><p>{0}</p></article></body></html>", True),
        ("<div id='page' class='no-sidebar'><article><p>{0}</p></article></div>", True),
        ("<div class='hasSidebar'><p>{0}</p><p>{0}</p></div>", True),
        ("<main class='site-content with-nav'><p>{0}</p></main>", True),
        ("<article class='post search-result'><p>{0}</p></article>", True),
        ("<div class='sidebar-right-layout'><article><p>{0}</p></article><div class=sidebar><p>side</p></div></div>", True),
        ("<div class='content'><div class='layout-widget'><div class='entry'><p>{0}</p></div></div></div>", True),
        ("<article class=teaser><p>{0}</p></article>", False),
        ("<div class=sidebar><p>{0}</p></div>", False),
        ("<main><p>own</p></main><div class='sidebar-list'><article><p>{0}</p></article></div>", False),
        ("<article><p>own</p></article><section id=comments><article class='comment-body'><p>{0}</p></article></section>", False),
        ("<div class=content><p>own text</p></div><ol class='comment-list'><article><p>{0}</p></article></ol>", False),
        ("<nav class='with-main'><article><p>{0}</p></article></nav>", False),
    ],
)
def test_classes_of_layouts_do_not_hide_the_article(page, kept):
    text = main_text(page.format(LONG))
    assert (LONG.strip() in text) == kept and "side" not in text


def test_extraction_of_a_table(spark):
    long = "<article>" + "<p>word word</p>" * 40_000
    rows = [(1, "u", long, 7), (1, "u", long, 7), (None, None, None, 8), (2, "v", "<p", 9)]
    found = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text long")).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in found) == [(0, 0), (1, 399_999), (1, 399_999), (2, 0)]
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# token records


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_checksums():
    assert crc32c([b"123456789", b"\0" * 32, b"\xff" * 32]).tolist() == [0xE3069283, 0x8A9136AA, 0x62A8AB43]
    rng = random.Random(1)
    joined = rng.randbytes(1700)
    assert crc32c([joined[:n] for n in (511, 512, 513, 1700)]).tolist() == [crc32c([joined[:n]])[0] for n in (511, 512, 513, 1700)]


def test_words_encode_as_texts_do(tokenizer):
    rng = random.Random(2)
    parts = ["a", "b", " ", " ", "\n", "\t", "'s", " x", "É", "é", "  ", ".", "1", " ", "　", "日本", "😀", "<|endoftext|>", "'ll"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(4000)]
    encoder = Encoder(tokenizer)
    plain = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)] == [x.ids for x in plain]


def test_records_round_trip(spark, documents, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK_BYTES", 100_000)
    folder = f"{tmp_path}/records"
    index = write_records(documents(ODD), tokenizer, folder)
    found = read_records(index, folder).collect()
    plain = Encoder(tokenizer).tokenizer
    order = sorted(((-(1 << 63) if r[0] is None else r[0]), r[1] or "") for r in ODD)
    start, wanted = 0, []
    for doc_id, text in order:
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        wanted.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    own = sorted(((-(1 << 63) if r["doc_id"] is None else r["doc_id"]), r["start"], r["n_tokens"], r["ids_crc32"]) for r in found)
    assert own == sorted(wanted)
    assert index.select("block").distinct().count() > 1
    # the frame of a record, by hand
    row = index.filter("offset > 0").first()
    data = (tmp_path / "records" / "data" / row["file"]).read_bytes()[row["offset"] :][: row["length"] + 16]
    assert struct.unpack("<Q", data[:8])[0] == row["length"]
    assert struct.unpack("<I", data[8:12])[0] == masked(crc32c([data[:8]]))[0]
    assert struct.unpack("<I", data[-4:])[0] == masked(crc32c([data[12:-4]]))[0]
    # a flipped byte is found
    path = tmp_path / "records" / "data" / row["file"]
    broken = bytearray(path.read_bytes())
    broken[row["offset"] + 14] ^= 1
    path.write_bytes(broken)
    with pytest.raises(Exception, match="damaged record"):
        read_records(index, folder).collect()


def test_no_records(documents, tokenizer, tmp_path):
    folder = f"{tmp_path}/none"
    assert read_records(write_records(documents([]), tokenizer, folder), folder).collect() == []


# language model


def test_scores(documents, monkeypatch):
    monkeypatch.setattr(ngram_filter, "CHUNK_BYTES", 20_000)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["the", "of", "Of", "a", *[f"w{j}" for j in range(300)]], k=rng.randint(0, 60)))) for i in range(1200)]
    rows += [(2000 + i, "these five words come together") for i in range(50)] + [r[:2] for r in ODD]
    docs = documents(rows)
    found = score_texts(docs, docs.doc_id % 3 != 1).collect()
    counts = collections.Counter()
    for doc_id, text in rows:
        if doc_id is not None and math.fmod(doc_id, 3) != 1:
            counts.update([*words(text), None])
    total, distinct = sum(counts.values()), len(counts)
    assert len(found) == len(rows) and {r["train_tokens"] for r in found} == {total}
    texts = collections.defaultdict(list)
    for doc_id, text in rows:
        own = [*words(text), None]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        texts[doc_id].append((len(own), sum(counts[w] > 0 for w in own), round(base, 6)))
    scored = collections.defaultdict(list)
    for r in found:
        scored[r["doc_id"]].append((r["n_tokens"], r["n_known"], round(r["base_score"], 6)))
        assert r["score"] < 0
    assert scored == texts
    # a repeated passage is likelier under the model than word by word
    assert all(r["score"] > r["base_score"] + 1 for r in found if (r["doc_id"] or 0) >= 2000)


def test_counts_come_back_from_the_filter():
    rng = np.random.default_rng(4)
    hashes = np.unique(rng.integers(0, 1 << 56, 20_000, dtype=np.uint64))
    counts = rng.choice([1, 2, 3, 10, 200], len(hashes)).astype(np.uint64)
    import pyarrow as pa

    home, part = hashes % np.uint64(4), ngram_filter._within(hashes, 4)
    rows = []
    for segment in range(4):
        own = np.argsort(part[home == segment])
        names = np.diff(part[home == segment][own], prepend=np.uint32(0))
        table = {"segment": [segment], "names": [ngram_filter._planes(names)], "counts": [ngram_filter._planes(counts[home == segment][own])]}
        rows += ngram_filter._segment(pa.table(table), 1 << 30).to_pylist()
    starts = np.cumsum([0, *(len(r["bits"]) for r in rows)])[:-1]
    bloom = ngram_filter.BigramFilter(starts, np.array([r["size"] for r in rows]), np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8))
    back = bloom.counts(hashes)
    kept = counts >= 2
    assert (back[kept] >= counts[kept] / 1.5).all()
    assert np.median(np.abs(back[kept] / counts[kept] - 1)) < 0.3
    absent = rng.integers(0, 1 << 56, 20_000, dtype=np.uint64)
    assert (bloom.counts(absent) > 0).mean() < 0.03


def segment_of(names, counts):
    own = np.argsort(names)
    planes = ngram_filter._planes
    return pa.table({"segment": [0], "chunk": [5], "names": [planes(np.diff(names[own], prepend=np.uint32(0)))], "counts": [planes(counts[own])]}), own


def test_a_segment_keeps_all_entries_whatever_their_number():
    rng = np.random.default_rng(8)
    names = np.unique(rng.integers(0, 1 << 32, 30_000, dtype=np.uint32))
    counts = rng.choice([2, 3, 10], len(names)).astype(np.uint32)
    # a bound of 64, which was one in bits
    made = ngram_filter._segment(segment_of(names, counts)[0], 64).to_pylist()[0]
    bloom = ngram_filter.BigramFilter(np.zeros(1, np.int64), np.array([made["size"]]), np.frombuffer(made["bits"], np.uint8))
    assert (bloom.counts(names.astype(np.uint64)) >= counts / 1.5).all()


def test_bigrams_seen_once_have_their_count(documents):
    rng = np.random.default_rng(11)
    names = np.unique(rng.integers(0, 1 << 32, 30_000, dtype=np.uint32))
    counts = rng.choice([0, 1, 2], len(names)).astype(np.uint32)
    rows, own = segment_of(names, counts)
    back = ngram_filter._COUNT[np.frombuffer(ngram_filter._found(rows).column("levels")[0].as_py(), np.uint8)]
    assert (back >= counts[own]).all()
    for n in (0, 1, 2):
        assert (back[counts[own] == n] == n).mean() > 0.97
    # in scores: what training has once is likelier in its order than in another
    text = [f"v{i}" for i in range(40)]
    docs = documents([(0, " ".join(text)), (1, " ".join(text)), (2, " ".join(text[::-1]))])
    found = {r["doc_id"]: r["score"] for r in score_texts(docs, docs.doc_id == 0).collect()}
    base = (1 + 0.5) / (41 + 0.5 * 42)
    wanted = 41 * math.log10((1 + 300 * base) / 301)
    assert found[0] == pytest.approx(wanted, abs=0.02) and found[1] == pytest.approx(wanted, abs=0.02)
    assert found[2] < found[1]


def test_scores_do_not_depend_on_the_size_of_the_filter(spark, documents, monkeypatch):
    """A filter far above its former share, in many segments and chunks, against counts in a dictionary."""
    monkeypatch.setattr(ngram_filter, "FILTER_BYTES", 500, raising=False)
    monkeypatch.setattr(ngram_filter, "BIGRAM_TOKENS", 2_000)
    monkeypatch.setattr(ngram_filter, "CHUNK_BYTES", 20_000)
    rng = random.Random(10)
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(60)], k=rng.randint(0, 60)))) for i in range(1500)]
    docs = documents(rows)
    found = {r["doc_id"]: r["score"] for r in score_texts(docs, docs.doc_id % 3 != 1).collect()}
    # the same text has the same score in training and out of it, in whichever chunk it is
    pairs, counts = collections.Counter(), collections.Counter()
    for i, text in rows:
        if i % 3 != 1:
            own = [None, *words(text), None]
            counts.update(own[1:])
            pairs.update(zip(own, own[1:], strict=False))
    total, distinct = sum(counts.values()), len(counts)
    off = []
    for i, text in rows:
        own = [None, *words(text), None]
        score = 0.0
        for a, b in zip(own, own[1:], strict=False):
            base = (counts[b] + 0.5) / (total + 0.5 * (distinct + 1))
            score += math.log10((pairs[a, b] + 300 * base) / (counts[a] + 300))
        off.append((found[i] - score) / len(own))
    assert abs(np.mean(off)) < 0.01 and np.max(np.abs(off)) < 0.08


def test_a_chunk_and_a_segment_take_little_memory():
    """Each step over a chunk or segment, against its number of tokens: arrays that are done with go at once."""
    rng = np.random.default_rng(12)
    n, vocabulary = 1 << 20, 1 << 16
    hashes = np.unique(rng.integers(0, 1 << 63, vocabulary, dtype=np.uint64))
    names = np.append(hashes[:-1], ngram_filter._END)
    lengths = np.full(n // 256, 256)
    codes = rng.integers(0, len(names) - 1, n).astype(np.uint32)
    codes[255::256] = len(names) - 1
    train = rng.random(len(lengths)) < 0.8
    columns = {"chunk": [7], "ids": [list(range(len(lengths)))], "train": [train.tolist()], "lengths": [lengths.tolist()]}
    columns |= {"codes": [ngram_filter._planes(codes)], "names": [names.astype("<u8").tobytes()]}
    chunk = pa.table(columns)

    def peak(step):
        tracemalloc.start()
        made = step()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return made, most / n

    rows, most = peak(lambda: list(ngram_filter._counted(iter(chunk.to_batches()), 1)))
    assert most < 55
    rows = pa.Table.from_batches(rows)
    found, most = peak(lambda: ngram_filter._found(rows))
    assert most < 55
    counts = np.bincount(codes[np.repeat(train, 256)], minlength=len(names)).astype(np.uint64)
    order, edges = ngram_filter._by_segment(names, 1)
    back = {"pairs": [False, True], "segment": [0, 0], "low": [ngram_filter._planes(counts[order]), found.column("levels")[0].as_py()]}
    back = pa.table(back | {"high": [ngram_filter._planes(np.zeros(len(names))), None]})
    scored, most = peak(lambda: ngram_filter._score(chunk, back, 1, 1, int(counts.sum()), len(names)))
    assert most < 70
    # and they count right
    pairs = ngram_filter._bigrams(names[codes], lengths)
    distinct, place, _, starts = ngram_filter._grouped(pairs)
    assert (distinct == np.unique(pairs)).all() and (distinct[place] == pairs).all()
    assert (np.diff(starts, append=n) == np.unique(pairs, return_counts=True)[1]).all()
    assert np.concatenate([ngram_filter._codes(x.as_py()) for x in rows.column("counts")]).sum() == 256 * train.sum()
    assert scored.num_rows == len(lengths) and scored.column("n_tokens").to_pylist() == lengths.tolist()


def test_no_texts_and_no_training(documents):
    docs = documents([(1, "a b"), (2, None)])
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in score_texts(docs, docs.doc_id < 0).collect()} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    empty = documents([])
    assert score_texts(empty, empty.doc_id < 0).collect() == []


# fingerprints


def weights(text):
    return {w: 1 + math.log(n) for w, n in collections.Counter(words(text)).items()}


def similarity(x, y):
    x, y = weights(x), weights(y)
    both = x.keys() | y.keys()
    return sum(min(x.get(w, 0), y.get(w, 0)) for w in both) / sum(max(x.get(w, 0), y.get(w, 0)) for w in both) if both else 1.0


def test_fingerprints_and_edited_texts(documents, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK_BYTES", 3_000)
    rng = random.Random(5)
    rows = [(i * 7, " ".join(f"é{rng.randrange(80)}" for _ in range(rng.randint(1, 90)))) for i in range(150)] + [(3, ""), (5, None), (2000, "a a a B")]
    rng.shuffle(rows)
    found = {r["doc_id"]: r for r in weighted_fingerprints(documents(rows)).collect()}
    ids = sorted(found)
    text = {d: t or "" for d, t in rows}
    errors = []
    for this, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        mine, half = text[this], len(text[this]) // 2
        edited = mine[: len(mine) - half] + text[after][:half]
        r = found[this]
        assert (r["n_chars"], r["edited_sha256"]) == (len(mine), hashlib.sha256(edited.encode()).hexdigest())
        errors += [r["near_edited"] - similarity(mine, edited), r["near_next"] - similarity(mine, text[after])]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.6 / math.sqrt(SAMPLES)


def test_fingerprints_of_odd_rows(documents):
    found = weighted_fingerprints(documents(ODD)).collect()
    assert len(found) == len(ODD)
    same = {r["fingerprint"] for r in found if r["doc_id"] in (6, 8, None)}
    assert len(same) == 1
    assert {r["fingerprint"] for r in found if r["doc_id"] in (1, 2, 3)} == {"0" * 8 * SAMPLES}
    assert weighted_fingerprints(documents([])).collect() == []
    one = weighted_fingerprints(documents([(1, "abcd")])).collect()
    assert [(r["edited_sha256"], r["near_next"]) for r in one] == [(hashlib.sha256(b"abab").hexdigest(), 1.0)]


# toxicity


def test_segments_equal_all_maximal_ones():
    """Against the definition: split at the best interval, then left and right of it."""

    def best(scores, low, high):
        found = max(((sum(scores[i:j]), i - j, i, j) for i in range(low, high) for j in range(i + 1, high + 1)), default=(0, 0, 0, 0))
        if found[0] <= 0:
            return []
        return best(scores, low, found[2]) + [(found[2], found[3])] + best(scores, found[3], high)

    rng = random.Random(6)
    for _ in range(200):
        scores = [rng.uniform(-2, 1.5) for _ in range(rng.randint(0, 14))]
        found = segments(np.array(scores, float))
        assert [(a, b) for a, b, _ in found] == best(scores, 0, len(scores))
        assert all(s == pytest.approx(sum(scores[a:b])) for a, b, s in found)


def test_toxic_texts_are_told_apart(spark, documents):
    rng = random.Random(7)
    plain = [f"w{i}" for i in range(300)]
    bad = ["nasty", "vile", "grimstem", "grimstems", "grimster"]
    rows, labels = [], []
    for i in range(900):
        text = rng.choices(plain, k=rng.randint(20, 200))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", "!", ","]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic), "x"))
    labels += [(None, 1, "x"), (5, None, "x"), (99_999, 1, "x")]
    table = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    docs = documents(rows + [r[:2] for r in ODD if r[0] in (None, -9)])
    model = fit_toxicity(docs, table.filter("doc_id is null or doc_id % 5 <> 0"))
    found = {r["doc_id"]: r for r in score_toxicity(docs, model).collect()}
    held = [i for i in range(900) if i % 5 == 0]
    assert np.mean([(found[i]["score"] >= 0.5) == (i % 6 == 0) for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values())
    hit = next(found[i] for i in held if i % 6 == 0 and found[i]["passages"])
    assert any(rows[hit["doc_id"]][1].split()[p["start"]].strip("!,") in bad for p in hit["passages"])


def test_no_labels_and_odd_texts(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = fit_toxicity(documents(ODD), none)
    found = score_toxicity(documents(ODD), model).collect()
    assert len(found) == len(ODD) and all(r["score"] < 0.5 for r in found)
    assert score_toxicity(documents([]), toxicity.ToxicityModel()).collect() == []


def test_ids_at_the_ends_of_their_range(spark, documents, monkeypatch, tmp_path):
    pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(ordered, "BLOCK_BYTES", 200)
    ids = [2**63 - 1, 2**63 - 2, -(2**63), 2**62, 0, 5, None]
    rows = [(i, f"text {n} " * (n + 5)) for n, i in enumerate(ids)]
    import public_tokenizers

    folder = f"file://{tmp_path}/records"
    found = read_records(write_records(documents(rows), public_tokenizers.path("byte_bpe_50k.json"), folder), folder).collect()
    by_start = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert by_start[2:] == [0, 5, 2**62, 2**63 - 2, 2**63 - 1] and len(found) == len(ids)
    assert len(weighted_fingerprints(documents(rows)).collect()) == len(ids)


def test_toxicity_model_does_not_depend_on_the_layout(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    models = [fit_toxicity(d, x) for d, x in ((docs, labels), (docs.repartition(7), labels.repartition(3)), (docs.orderBy("text"), labels.orderBy("toxic")))]
    assert models[0].__dict__ == models[1].__dict__ == models[2].__dict__


def test_rows_of_one_id_are_cut_into_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK_BYTES", 4_000)
    rng = random.Random(8)
    rows = [(i, f"{rng.random()} {'x' * rng.randint(0, 300)}") for i in [None] * 150 + [7] * 150 + list(range(100))]
    docs = documents(rows).select("doc_id", "text")
    bounds = ordered.block_bounds(docs)
    placed = docs.withColumn("order", ordered.order_key())
    placed = placed.select("doc_id", "text", ordered.block_of(bounds).alias("block")).collect()
    sizes, where = {}, sorted(((-(1 << 63) if r["doc_id"] is None else r["doc_id"]), r["text"], r["block"]) for r in placed)
    for _, text, block in where:
        sizes[block] = sizes.get(block, 0) + len(text) + ordered.ROW_BYTES
    # in order of id and text, no block is empty or far above the size
    assert [b for *_, b in where] == sorted(b for *_, b in where)
    assert set(sizes) == set(range(len(bounds) + 1)) and max(sizes.values()) < 2 * 4_000
    found = weighted_fingerprints(docs).select("doc_id", "edited_sha256").collect()
    texts = [t for _, t, _ in where]
    edited = sorted(hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest() for t, n in zip(texts, texts[1:] + texts[:1], strict=True))
    assert sorted(r["edited_sha256"] for r in found) == edited
