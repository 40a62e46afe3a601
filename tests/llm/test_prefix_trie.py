"""The trie of prefixes against plain dictionaries, over one block and over many."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from statlake.llm import prefix_trie as pt
from statlake.llm.prefix_trie import RESULT, ordered_turns, prefix_trie, with_shared_heads
from statlake.llm.queries import ORACLE, QUERIES

KIND = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            token = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv_id].append((turn is not None, turn or 0, role, token, text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    done = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        done[c] = own.get(c - (abs(c) % 100) * (1 if c > 0 else -1), [])[:h] + turns[h:]
    return done


def plain(conversations):
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (own[0], len(p), members[p[:-1]][0] if p else None, len(own), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, own in members.items()
    )


def got(frame):
    return sorted(tuple(r) for r in frame.select(*RESULT).collect())


def sample(rng, n, first=0):
    """Conversations with common first turns, copies, prefixes of others, and odd rows."""
    rows = []
    for c in range(first, first + n):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "a", "é日", "", None]) if t < 5 else "x" * (t % 4)))
        if c % 3 == 0:  # a very common conversation
            rows = [r for r in rows if r[0] != c] + [(c, t, "user", f"common {t}") for t in range(3)]
    return rows


@pytest.mark.parametrize(("block", "partition"), [(1 << 17, 1 << 20), (37, 200), (8, 60), (1, 1000)])
def test_equals_dictionaries_over_any_blocks(spark, monkeypatch, block, partition):
    monkeypatch.setattr(pt, "BLOCK", block)
    monkeypatch.setattr(pt, "PARTITION", partition)
    monkeypatch.setattr(pt, "PIECE", 4)
    rows = sample(random.Random(block), 250) + [(-5, 0, "user", "a"), (-5, 1, "user", "b"), (None, 0, "user", "lost"), (-100, 0, "user", "a")]
    frame = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS block", "2 AS key", "'z' AS node", "0 AS side", "4 AS depth", "5 AS head", "6 AS h")
    assert got(prefix_trie(with_shared_heads(ordered_turns(frame)))) == plain(rebuilt(rows))


def test_turnless_conversations_and_copies(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK", 5)
    # conversation 101 takes its first turns from 100, which is absent, and has too few of its own
    short = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1][:20]
    rows = [(c, 0, "user", "x") for c in short]
    assert all(turns == [] for turns in rebuilt(rows).values())
    trie = got(prefix_trie(with_shared_heads(ordered_turns(spark.createDataFrame(rows, KIND)))))
    ends = hashlib.sha256(",".join(map(str, short)).encode()).hexdigest()
    assert trie == plain(rebuilt(rows)) == [(short[0], 0, None, 20, 0, 1, 0, ends)]


def test_one_very_long_conversation_and_its_copy(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK", 50)
    rows = [(c, t, "user", f"t{t}") for c in (0, 100) for t in range(400)] + [(200, t, "user", f"t{t}") for t in range(200)]
    assert got(prefix_trie(ordered_turns(spark.createDataFrame(rows, KIND)))) == plain({c: [("user", f"t{t}") for t in range(n)] for c, n in ((0, 400), (100, 400), (200, 200))})


def test_empty_table_has_no_node(spark):
    assert got(prefix_trie(with_shared_heads(ordered_turns(spark.createDataFrame([], KIND))))) == []


def test_extents_equal_a_walk():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64):
        lcp = rng.integers(0, 4, n)
        levels = pt.sparse_table(lcp)
        for at in range(n + 1):
            for depth in range(5):
                left = right = at
                while right < n and lcp[right] >= depth:
                    right += 1
                while left > 0 and lcp[left - 1] >= depth:
                    left -= 1
                where, want = np.array([at]), np.array([depth])
                assert pt.right_extents(levels, where, want)[0] == right
                assert pt.left_extents(levels, where, want)[0] == left


@pytest.mark.parametrize("block", [1 << 17, 100])
def test_query_equals_its_sql(spark, monkeypatch, block):
    monkeypatch.setattr(pt, "BLOCK", block)
    sf_dir = "/root/testdata/sf0.01"
    base = duckdb.connect()
    base.sql(f"CREATE VIEW conversations AS FROM '{sf_dir}/conversations.parquet'")
    want = base.sql(ORACLE["op12_prefix_trie"]).select(", ".join(RESULT)).fetchall()
    assert got(QUERIES["op12_prefix_trie"](spark, sf_dir)) == sorted(want, key=lambda r: (r[0], r[1]))
