"""Language identification against a plain version, held-out accuracy, odd rows and rounds."""

import collections
import math
import unicodedata

import pytest
from llm.conftest import KIND, ODD

from statlake.llm import language_id
from statlake.llm.common import read
from statlake.llm.language_id import ALPHA, BUCKETS, ORDERS, UNKNOWN, fit_languages, identify_languages
from statlake.llm.queries import QUERIES

MASK = (1 << 64) - 1


def grams(text):
    """Buckets of a text's n-grams, one character at a time."""
    codes = []
    for c in f" {text or ''} ":
        low = c.lower()
        codes.append(ord(low if len(low) == 1 else c) if unicodedata.category(c)[0] in "LM" else 0)
    for n in ORDERS:
        for i in range(len(codes) - n + 1):
            own = codes[i : i + n]
            if all(own[1:-1]) and (own[0] or own[-1]):
                value = sum(c * pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j, c in enumerate(own)) + n
                yield (value * 0xD6E8FEB86659FD93 & MASK) >> 48


def plain(rows, train):
    """(language, posterior) of every text of rows, learnt from the (text, lang) of train."""
    counts, shares = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in train:
        if lang is not None:
            shares[lang] += 1
            counts[lang].update(grams(text))
    sizes = {lang: counts[lang].total() for lang in shares}
    found = []
    for text in rows:
        if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
            found.append((UNKNOWN, 0.0))
            continue
        own = collections.Counter(grams(text))
        post = {
            lang: math.log(shares[lang] / shares.total())
            + sum(n * round((math.log(counts[lang][b] + ALPHA) - math.log(sizes[lang] + ALPHA * BUCKETS)) * 2**20) for b, n in own.items()) / 2**20 / len(ORDERS)
            for lang in shares
        }
        best = max(sorted(post), key=post.get)
        found.append((best, 1 / sum(math.exp(p - post[best]) for p in post.values())))
    return found


TRAIN = [("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("der hund und die katze", "de"), ("это кот", "ru"), (None, "en"), ("no language", None), ("the the", "")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], KIND)


@pytest.mark.parametrize("languages", [128, 2])
def test_equals_a_plain_version_in_one_round_and_in_several(spark, monkeypatch, languages):
    monkeypatch.setattr(language_id, "LANGUAGES", languages)
    texts = ["The cat", "un chien", "ein HUND", "кот", "日本語", "१२ ", "123 !", "", None, "İstanbul ǅ éte", "zzz", "the " * 3000]
    model = fit_languages(frame(spark, TRAIN))
    rows = frame(spark, [(t, None) for t in texts])
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify_languages(rows, model).collect()}
    for i, (lang, score) in enumerate(plain(texts, TRAIN)):
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, rel=1e-6), texts[i]


def test_long_texts_in_pieces_have_the_same_features(spark, monkeypatch):
    text = "Ein häufig wiederholter, langer Text " * 60
    monkeypatch.setattr(language_id, "PIECE", 1000)
    pieces = collections.Counter()
    for codes, _, stop, letters in language_id._pieces([text]):
        assert letters.all()
        for _, buckets in language_id._grams(codes, stop):
            pieces.update(buckets.tolist())
    assert pieces == collections.Counter(grams(text))


def test_odd_rows_and_clashing_columns(spark, documents):
    rows = documents(ODD).selectExpr("*", "1 AS lang_pred", "2 AS __text", "3 AS bucket")
    model = fit_languages(rows)
    got = identify_languages(rows, model, keep=("doc_id", "text", "shard")).collect()
    assert len(got) == len(ODD)
    for r in got:
        letters = any(unicodedata.category(c)[0] == "L" for c in r.text or "")
        assert (r.lang_pred, r.score) == (("en", 1.0) if letters else (UNKNOWN, 0.0)) and r.shard == "y"


def test_empty_tables_and_nothing_to_learn_from(spark, documents):
    rows, empty = documents(ODD), documents(ODD).limit(0)
    assert identify_languages(empty, fit_languages(rows)).collect() == []
    got = identify_languages(rows, fit_languages(empty)).collect()
    assert len(got) == len(ODD) and {(r.lang_pred, r.score) for r in got} == {(UNKNOWN, 0.0)}


def test_model_does_not_depend_on_the_layout(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    models = [{r.lang: (r.n_texts, bytes(r.weights)) for r in fit_languages(d).collect()} for d in (docs, docs.repartition(7), docs.orderBy("text"))]
    assert models[0] == models[1] == models[2]


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in read(spark, sf_dir, "documents").collect()}
    got = QUERIES["op11_language_id"](spark, sf_dir).collect()
    assert len(got) == len(truth)
    held = [(r.lang_pred, truth[r.doc_id].lang) for r in got if r.held_out and any(c.isalpha() for c in truth[r.doc_id].text)]
    assert len(held) > 200 and sum(a == b for a, b in held) / len(held) > 0.97
