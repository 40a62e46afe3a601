"""Log-structured tables: folding small files beside readers and writers, and clearing up after it."""

import json
import os
import shutil
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from statlake import Lake
from statlake.errors import DatasetNotFound
from statlake.sources import tables
from statlake.sources.store import new_id


@pytest.fixture
def rows(spark):
    return spark.range(3).selectExpr("id", "concat('n', id) AS name")


def same_state(lake):
    return [sorted(map(str, table.collect())) for table in (lake.catalog(), lake.changes(), lake.documents(), lake.grants())]


def named_files(lake, name):
    manifest = tables.read_manifest(lake.spark, lake.root, name)
    return {f"{lake.root}/tables/{name}/{f}" for f in manifest.files}


def found_files(df):
    return {f.removeprefix("file://") for f in df.inputFiles()}


def test_compaction_changes_no_result(lake, rows, governed):
    for path in ("/a/b", "/a/c", "/d"):
        for version in (1, 2):
            lake.write(rows, path, version=version, dataset_doc='{"n":1}', **governed)
    lake.grant("bob", "/a")
    tables.append_frame(lake.catalog().selectExpr("concat('/bulk', path) path", "version", "parent_uri", "valuation", "state"), lake.root, "catalog")
    before = same_state(lake)
    for _ in range(2):
        lake.compact()
        assert same_state(lake) == before
        assert lake.read("/a/b").count() == 3 and lake.versions("/a/c").count() == 2
        assert lake.read("/a/*").count() == 2 and Lake(lake.spark, lake.root, user="bob").read("/a/b").count() == 3
    lake.write(rows, "/a/b", version=3, **governed)
    assert lake.resolve("/a/b")["version"] == 3 and lake.resolve("/a/c")["version"] == 2
    lake.compact()
    assert lake.vacuum(grace_s=0) > 0
    assert lake.resolve("/a/b")["version"] == 3 and lake.list("/").count() == 6
    assert lake.vacuum(grace_s=0) == 0


def test_readers_take_the_files_that_the_manifest_names(lake, rows, governed):
    for i in range(6):
        lake.write(rows, f"/p/{i}", version=1, **governed)
    assert len(lake.list("/p/").inputFiles()) == 6
    lake.compact()
    assert found_files(lake.list("/p/")) == named_files(lake, "catalog")
    lake.write(rows, "/p/7", version=1, **governed)
    later = found_files(lake.list("/p/")) - named_files(lake, "catalog")
    assert len(later) == 1 and f"/log/{tables.key_of('/p/7')}/" in later.pop()


def test_a_reader_keeps_its_files_through_a_compaction(lake, rows, governed):
    lake.write(rows, "/a", version=1, **governed)
    pinned = lake.catalog()
    lake.write(rows, "/b", version=1, **governed)
    lake.compact()
    lake.vacuum(grace_s=3600)
    assert [r["path"] for r in pinned.collect()] == ["/a"]


def many_versions(lake, path, n):
    """Catalog rows of versions 2 to n, each an append of its own, by copies of one written file."""
    row = {**lake.catalog().filter("version = 1").drop("fields", "nested").first().asDict(), "fields": [], "nested": []}
    folder = f"{lake.root}/tables/catalog/log/{tables.key_of(path)}"
    tables.append_rows(lake.spark, lake.root, "catalog", [{**row, "version": 2}])
    whole = f"{folder}/{sorted(os.listdir(folder))[-1]}"
    for _ in range(n - 2):
        shutil.copytree(whole, f"{folder}/{new_id()}")


def best_of(times, run):
    def once():
        began = time.perf_counter()
        run()
        return time.perf_counter() - began

    return min(once() for _ in range(times))


def test_two_thousand_versions_resolve_as_one_does(lake, rows, governed):
    lake.write(rows, "/one", version=1, **governed)
    lake.write(rows, "/many", version=1, **governed)
    many_versions(lake, "/many", 2000)
    one = best_of(5, lambda: lake.resolve("/one"))
    lake.compact()
    lake.vacuum(grace_s=0)
    assert lake.resolve("/many")["version"] == 2
    assert best_of(5, lambda: lake.resolve("/many")) < 2 * one + 0.05
    assert len(lake._table("catalog", "/many").inputFiles()) == 1


def test_writers_beside_compactions_lose_nothing(lake, rows, governed):
    stop = []

    def fold():
        while not stop:
            lake.compact()
            lake.vacuum(grace_s=60)

    with ThreadPoolExecutor(4) as pool:
        folding = pool.submit(fold)
        list(pool.map(lambda i: lake.write(rows, f"/w/{i % 3}", version=i + 1, **governed), range(9)))
        stop.append(True)
        folding.result()
    assert sorted(r["version"] for r in lake.catalog().collect()) == list(range(1, 10))
    assert lake.changes().count() == 18 and lake.documents().count() == 9


def test_one_of_several_compactions_does_the_work(lake, rows, governed):
    for i in range(3):
        lake.write(rows, f"/p/{i}", version=1, **governed)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: tables.compact(lake.spark, lake.root, "catalog"), range(4)))
    assert tables.read_manifest(lake.spark, lake.root, "catalog").number == 1
    assert lake.catalog().count() == 3


def test_large_files_are_named_where_they_are(lake, monkeypatch):
    rows = lake.spark.range(1000).selectExpr("'/x' path", "id version", "'doc' kind", "repeat('t', 50) json")
    tables.append_frame(rows, lake.root, "documents")
    monkeypatch.setattr(tables, "LARGE_BYTES", 1000)
    lake.compact()
    assert all(f.startswith("loads/") for f in tables.read_manifest(lake.spark, lake.root, "documents").files)
    assert lake.vacuum(grace_s=0) == 0 and lake.documents().count() == 1000
    assert tables.read_table(lake.spark, lake.root, "documents", "/x").count() == 1000


def test_incomplete_loads_and_dead_compactions_do_not_count(lake, rows, governed):
    lake.write(rows, "/a", version=1, **governed)
    tables.append_frame(lake.catalog().selectExpr("'/b' path", "version", "'INTERNAL' valuation", "'RAW' state"), lake.root, "catalog")
    loads = f"{lake.root}/tables/catalog/loads"
    os.remove(f"{loads}/{os.listdir(loads)[0]}/_SUCCESS")
    shutil.copytree(f"{loads}/{os.listdir(loads)[0]}", f"{lake.root}/tables/catalog/base/{1:010d}-{new_id()}")
    assert [r["path"] for r in lake.catalog().collect()] == ["/a"]
    lake.compact()
    assert [r["path"] for r in lake.catalog().collect()] == ["/a"]
    lake.vacuum(grace_s=0)
    assert len(os.listdir(f"{lake.root}/tables/catalog/base")) == 1 and len(os.listdir(loads)) == 1
    assert [r["path"] for r in lake.catalog().collect()] == ["/a"]


def test_manifest_is_plain_text(lake, rows, governed):
    lake.write(rows, "/a", version=1, **governed)
    lake.compact()
    with open(f"{lake.root}/manifests/catalog/{1:010d}.json") as file:
        manifest = json.load(file)
    assert manifest["number"] == 1 and len(manifest["folded"]) == 1 and all(n > 0 for n in manifest["files"].values())
    with pytest.raises(DatasetNotFound):
        lake.read("/b")
