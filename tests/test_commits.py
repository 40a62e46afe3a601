"""Commits that need no atomic operation of the storage, and writes that die at any point."""

import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from statlake import Lake
from statlake.errors import DatasetNotFound, VersionExists, WriteExpired
from statlake.sources import store as stores
from statlake.sources import tables
from statlake.sources.store import Store, Turn, new_id


def test_only_one_contender_has_the_turn(spark, tmp_path):
    store, folder = Store(spark), str(tmp_path / "turns")
    done, holders, most = [], [], []

    def contend(_):
        turn = Turn(store, folder, pause_s=0.01)
        if not turn.take(settled=lambda: bool(done)):
            return 0
        holders.append(1)
        most.append(len(holders))
        time.sleep(0.05)
        holders.pop()
        done.append(1)
        turn.release()
        return 1

    for _ in range(5):
        done.clear()
        with ThreadPoolExecutor(6) as pool:
            assert sum(pool.map(contend, range(6))) == 1
    assert max(most) == 1 and store.names(folder) == []


def test_earlier_waits_for_later_and_later_gives_up(spark, tmp_path):
    store, folder = Store(spark), str(tmp_path / "turns")
    early, late = Turn(store, folder, pause_s=0.01), Turn(store, folder, pause_s=0.01)
    assert late.take()  # the earlier one has not put its marker yet
    done, result = [], []
    waiting = threading.Thread(target=lambda: result.append(early.take(settled=lambda: bool(done))))
    waiting.start()
    time.sleep(0.3)
    assert waiting.is_alive()
    done.append(1)
    late.release()
    waiting.join(10)
    assert result == [False]
    assert early.take() and not Turn(store, folder).take()


def test_dead_contenders_do_not_block(spark, tmp_path):
    store, folder = Store(spark), str(tmp_path / "turns")
    store.put(f"{folder}/{'0' * 17}-dead")
    turn = Turn(store, folder)
    assert turn.take()
    turn.release()
    assert not Turn(store, folder, lease_s=0.0).take()  # its own lease is over


@pytest.mark.parametrize("order", ["apart", "at once"])
def test_one_write_wins_where_claims_hold_nobody_back(lake, spark, governed, monkeypatch, order):
    """Claims let both writers through: both see no claim and no version, and write all their data."""
    barrier, real = threading.Barrier(2, timeout=60), Turn.take
    monkeypatch.setattr(stores.Store, "names", lambda self, folder, names=Store.names: [] if "/claims/" in folder else names(self, folder))

    def meet(self, *args, **named):
        if "/commits/" in self.folder:
            barrier.wait()
            if order == "apart" and self.name.endswith(("0", "2", "4", "6", "8", "a", "c", "e")):
                time.sleep(0.3)
        return real(self, *args, **named)

    monkeypatch.setattr(Turn, "take", meet)

    def write(i):
        try:
            return lake.write(spark.range(1000 * (i + 1)), "/race", version=1, dataset_doc=f'{{"n":{i}}}', **governed), i
        except VersionExists:
            return None

    with ThreadPoolExecutor(2) as pool:
        won = [x for x in pool.map(write, range(2)) if x]
    assert len(won) == 1
    made, i = won[0]
    assert lake.read("/race").count() == 1000 * (i + 1)
    assert lake.versions("/race").count() == 1
    assert [r["json"] for r in lake.documents().filter("kind = 'doc'").collect()] == [f'{{"n":{i}}}']
    # the loser's files are gone, the winner's lie in a folder of its own
    assert os.listdir(f"{lake.root}/data/race/1") == [made.folder.rsplit("/", 1)[1]]
    assert lake.unfinished().isEmpty()


def test_an_earlier_attempt_counts_should_two_have_one_version(lake, spark, governed):
    lake.write(spark.range(2), "/a", version=1, **governed)
    row = {**lake.catalog().drop("fields", "nested").first().asDict(), "fields": [], "nested": []}
    tables.append_rows(spark, lake.root, "catalog", [{**row, "attempt": new_id()}])
    assert lake.resolve("/a")["attempt"] == row["attempt"] and lake.read("/a").count() == 2


class Died(BaseException):
    pass


def dying(monkeypatch, table, kind=None):
    """A writer that dies before it appends to a table."""
    real = tables.append_rows

    def append(spark, root, name, rows):
        if name == table and (kind is None or rows[0]["kind"] == kind):
            raise Died
        real(spark, root, name, rows)

    monkeypatch.setattr(tables, "append_rows", append)


@pytest.mark.parametrize(
    ("table", "kind", "stage"),
    [("changes", "meta", "claimed"), ("documents", None, "announced"), ("changes", "commit", "announced"), ("catalog", None, "uncatalogued")],
)
def test_a_write_that_dies_shows_and_can_be_cleared(lake, spark, governed, monkeypatch, table, kind, stage):
    with monkeypatch.context() as patch:
        dying(patch, table, kind)
        with pytest.raises(Died):
            lake.write(spark.range(5), "/a", version=3, dataset_doc="{}", **governed)
    assert [tuple(r) for r in lake.orphans().collect()] == [("/a", 3)]
    assert [(r["stage"], r["expired"]) for r in lake.unfinished().collect()] == [(stage, False)]
    with pytest.raises(DatasetNotFound):
        lake.read("/a")
    # nobody clears a write whose lease holds, and nobody takes its version
    assert lake.discard_expired() == 0
    with pytest.raises(VersionExists):
        lake.write(spark.range(7), "/a", version=3, **governed)
    later = Lake(spark, lake.root, claim_lease_s=0.0)
    assert later.discard_expired() == 1
    assert lake.orphans().isEmpty() and lake.unfinished().isEmpty() and later.discard_expired() == 0
    folder = f"{lake.root}/data/a/3"
    assert not os.path.isdir(folder) or os.listdir(folder) == []
    lake.write(spark.range(7), "/a", version=3, **governed)
    assert lake.read("/a").count() == 7 and lake.orphans().isEmpty()
    assert lake.documents().filter("kind = 'doc'").isEmpty()  # the dead write's document does not count


def test_a_dead_attempt_beside_a_committed_one(lake, spark, governed, monkeypatch):
    with monkeypatch.context() as patch:
        dying(patch, "catalog")
        with pytest.raises(Died):
            lake.write(spark.range(5), "/a", version=3, **governed)
    with pytest.raises(VersionExists):
        lake.write(spark.range(6), "/a", version=3, **governed)
    folder = f"{lake.root}/claims/{tables.key_of('/a')}/3"
    (name,) = (n for n in os.listdir(folder) if not n.startswith("."))
    os.rename(f"{folder}/{name}", f"{folder}/{10**15:017d}-{name.partition('-')[2]}")  # an old claim
    lake.write(spark.range(6), "/a", version=3, **governed)
    assert [r["stage"] for r in lake.unfinished().collect()] == ["superseded"]
    assert lake.orphans().isEmpty() and lake.read("/a").count() == 6


def test_a_write_that_outlives_its_claim_is_not_committed(lake, spark, governed):
    slow = Lake(spark, lake.root, claim_lease_s=0.001)
    with pytest.raises(WriteExpired):
        slow.write(spark.range(5), "/a", version=1, **governed)
    assert lake.catalog().isEmpty()
    assert slow.discard_expired() == 1 and lake.orphans().isEmpty()


def test_a_running_write_is_not_touched(lake, spark, governed):
    """Clearing up while a write runs: it commits, and what it wrote is there."""
    rows = spark.range(3).withColumn("x", F.expr("id + 1"))
    with ThreadPoolExecutor(2) as pool:
        running = pool.submit(lambda: lake.write(rows, "/a", version=1, **governed))
        while not running.done():
            assert lake.discard_expired() == 0
        running.result()
    assert lake.read("/a").count() == 3
