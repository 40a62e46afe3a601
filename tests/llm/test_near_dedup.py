"""Groups against a comparison of all pairs."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import ODD

from statlake.llm import near_dedup
from statlake.llm.near_dedup import BINS, near_duplicates, shingle_sets, sketch


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text, k):
    own = words(text)
    return frozenset(tuple(own[i : i + k]) for i in range(max(1, len(own) - k + 1))) if own else frozenset()


def groups(rows, k=2, percent=80):
    sets = collections.defaultdict(list)
    for doc_id, text in rows:
        sets[doc_id].append(shingles(text, k))
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    flat = [(d, s) for d, own in sets.items() for s in own if s]
    for i, (d, s) in enumerate(flat):
        for e, t in flat[:i]:
            if 100 * len(s & t) >= percent * len(s | t):
                a, b = find(d), find(e)
                up[max(a, b)] = min(a, b)
    return {d: find(d) for d in sets}


def corpus(n, seed):
    """Texts, chains of edits of them, and copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        text = rng.choices(vocabulary, k=rng.randint(1, 80))
        for _ in range(rng.choice([1, 1, 2, 6])):
            out.append(" ".join(text))
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    rng.shuffle(out)
    return list(enumerate(out, 100))


@pytest.mark.parametrize("k", [2, 5])
def test_groups_equal_all_pairs(documents, k):
    rows = corpus(80, k)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(rows), k).collect()}
    assert found == groups(rows, k)


def test_a_crowded_bucket_in_blocks(documents, monkeypatch):
    """Small blocks, and a group whose members are mostly apart from its first and last one."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "STAR", 3)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(rng.randint(2, 7)):
            text[rng.randrange(90)] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(text)))
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(rows), 2).collect()}
    assert found == groups(rows)
    assert 1 < len(set(found.values())) < 60


def test_long_texts_are_compared_in_smaller_groups(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "LONG", 4)
    monkeypatch.setattr(near_dedup, "STAR", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 9)
    rows = corpus(25, 6)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(rows), 2).collect()}
    assert found == groups(rows)


def test_odd_rows(documents):
    found = near_duplicates(documents([r[:2] for r in ODD]), 2).collect()
    assert len(found) == len(ODD)
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[d]["n_shingles"] for d in (1, 2, 3, 4, 5, 7)] == [0, 0, 0, 1, 2, 2]
    assert all(by_id[d]["kept"] for d in (1, 2, 3, 4, 5, 7))
    assert [by_id[d]["component_id"] for d in (5, 6, 8)] == [5, 5, 5]
    assert by_id[None]["kept"] and by_id[None]["component_id"] is None


def test_empty_table(documents):
    assert near_duplicates(documents([]), 5).collect() == []


def test_sketches_estimate_the_similarity():
    rng = np.random.default_rng(1)
    for size in (1, 3, 40, 3000):
        x = rng.integers(1, 1 << 63, size, dtype=np.uint64)
        y = x.copy()
        y[: size // 4] = rng.integers(1, 1 << 63, size // 4, dtype=np.uint64)
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs((sketch(x) == sketch(y)).mean() - true) < 5 * np.sqrt(true * (1 - true) / BINS) + 1e-9


def test_shingles_of_rows_do_not_run_together():
    texts = ["a b c", "A  b\tc", "c", None, "b c", "é É"]
    sets = list(shingle_sets(pa.array(texts), 2))
    assert [len(s) for s in sets] == [2, 2, 1, 0, 1, 1]
    assert set(sets[0]) == set(sets[1]) > set(sets[4])
