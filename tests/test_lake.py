import glob
import json
import time

import pytest
from pyspark.sql import functions as F

from statlake import Lake
from statlake.errors import (
    DatasetNotFound,
    InvalidPath,
    MissingOption,
    PermissionDenied,
    PolicyError,
    VersionExists,
)
from statlake.functions.paths import with_lineage
from statlake.operators import access
from statlake.operators.catalog import committed_versions, current_catalog
from statlake.operators.schemas import avro_records
from statlake.sources import tables


@pytest.fixture
def ships(spark):
    return spark.createDataFrame(
        [("Gull Four", "sail", "0101"), ("Old Tern", "steam", "0202")],
        "ship string, power string, PORT string",
    )


def test_write_then_read(lake, ships, governed):
    before = time.time_ns() // 1_000_000
    made = lake.write(ships, "/harbour/ships/list", **governed)
    assert before <= made.version <= time.time_ns() // 1_000_000
    assert made.uri == f"{lake.root}/data/harbour/ships/list/{made.version}"
    assert sorted(lake.read("/harbour/ships/list/").collect()) == sorted(ships.collect())


def test_versions_and_snapshots(lake, ships, governed):
    for version in (10, 20, 30):
        rows = ships.withColumn("v", F.lit(version))
        lake.save(rows, "/a/b", {**governed, "version": str(version)})
    assert lake.read("/a/b").first()["v"] == 30
    assert lake.read("/a/b", snapshot=20).first()["v"] == 20
    assert lake.read("/a/b", snapshot=29).first()["v"] == 20
    with pytest.raises(DatasetNotFound):
        lake.read("/a/b", snapshot=9)
    with pytest.raises(VersionExists):
        lake.write(ships, "/a/b", version=20, **governed)
    assert lake.documents().filter("kind = 'meta' AND version = 20").count() == 1
    assert sorted(r["version"] for r in lake.versions("/a/b").collect()) == [10, 20, 30]
    assert current_catalog(lake.catalog()).first()["version"] == 30
    assert current_catalog(lake.catalog(), snapshot=25).first()["version"] == 20
    assert lake.write(ships, "/a/b", version="", **governed).version > 1_000_000


def test_missing_dataset(lake, ships, governed):
    with pytest.raises(DatasetNotFound):
        lake.read("/nothing/here")
    lake.write(ships, "/some/thing", **governed)
    with pytest.raises(DatasetNotFound):
        lake.read("/some/thin")


def test_required_options(lake, ships):
    with pytest.raises(MissingOption, match="valuation is missing in options"):
        lake.write(ships, "/a")
    with pytest.raises(MissingOption, match="state is missing in options"):
        lake.write(ships, "/a", valuation="INTERNAL")
    with pytest.raises(MissingOption):
        lake.write(ships, "/a", valuation="SECRET", state="INPUT")
    with pytest.raises(MissingOption):
        lake.write(ships, "/a", valuation="INTERNAL", state="DONE")
    with pytest.raises(MissingOption):
        lake.write(ships, "/a", valuation="INTERNAL", state="INPUT", version="latest")
    with pytest.raises(MissingOption):
        lake.save(ships, "/a", {"valuation": "INTERNAL", "state": "INPUT", "color": "red"})
    with pytest.raises(InvalidPath):
        lake.write(ships, "/a*", valuation="INTERNAL", state="INPUT")
    assert lake.changes().isEmpty()


def test_listing(lake, ships, governed):
    for path in ("/harbour/ships/list1", "/harbour/ships/list2", "/harbour/crews/x"):
        lake.write(ships, path, version=1, **governed)
        lake.write(ships, path, version=2, **governed)
    listing = lake.read("/harbour/ships/*")
    assert listing.columns == ["path"]
    assert sorted(r["path"] for r in listing.collect()) == ["/harbour/ships/list1", "/harbour/ships/list2"]
    assert lake.read("/harbour*").count() == 3
    assert lake.list("/harbour/crews", "version").count() == 2
    assert lake.read("/none*").count() == 0


def test_documents_and_events(lake, ships, governed):
    made = lake.write(
        ships, "/a/b", dataset_doc='{"name":"ships"}', lineage_doc='{"from":[]}', **governed
    )
    documents = {r["kind"]: r["json"] for r in lake.documents().collect()}
    assert json.loads(documents["meta"]) == {
        "id": {"path": "/a/b", "version": str(made.version)},
        "valuation": "INTERNAL",
        "state": "INPUT",
    }
    assert documents["doc"] == '{"name":"ships"}' and documents["lineage"] == '{"from":[]}'
    events = lake.changes().orderBy("ts").collect()
    assert [e["kind"] for e in events] == ["meta", "commit"]
    assert [e["uri"] for e in events] == [
        f"{made.uri}/.dataset-meta.json",
        f"{made.uri}/.dataset-meta.json.sign",
    ]
    lake.write(ships, "/a/c", write_documents=False, **governed)
    assert lake.documents().filter("path = '/a/c'").count() == 0


def test_failed_write_is_invisible(lake, ships, governed):
    lake.write(ships, "/a/b", version=1, **governed)
    broken = ships.withColumn("x", F.expr("raise_error('broken row')").cast("string"))
    with pytest.raises(Exception, match="broken row"):
        lake.write(broken, "/a/b", version=2, **governed)
    assert lake.read("/a/b").columns == ships.columns
    assert [tuple(r) for r in lake.orphans().collect()] == [("/a/b", 2)]
    assert [tuple(r) for r in committed_versions(lake.changes()).collect()] == [("/a/b", 1)]


def test_nested_datasets_do_not_mix(lake, ships, governed):
    lake.write(ships, "/a/b", version=7, **governed)
    lake.write(ships.limit(1), "/a/b/7", version=3, **governed)
    assert lake.read("/a/b").count() == 2
    assert lake.read("/a/b/7").count() == 1
    with pytest.raises(VersionExists):
        lake.write(ships, "/a/b/7", version=3, **governed)


def test_output_files(lake, spark, governed):
    rows = spark.range(0, 100_000, 1, 20)

    def files(path):
        made = lake.write(rows, path, max_partitions=5, **governed)
        return len(glob.glob(f"{made.folder}/*.parquet"))

    assert 1 <= files("/few") <= 5
    made = lake.write(rows, "/same", auto_repartition=False, **governed)
    assert len(glob.glob(f"{made.folder}/*.parquet")) == 20
    assert lake.read("/few").count() == lake.read("/same").count() == 100_000


def test_a_limit_of_files_does_not_shuffle_a_plain_scan(lake, spark, governed, tmp_path):
    source = str(tmp_path / "source")
    spark.range(0, 100_000, 1, 20).withColumn("half", F.col("id") % 2).write.parquet(source)
    scan = spark.read.parquet(source)

    def shaped(df, limit=5):
        plan = lake._shaped(df, limit)
        return "Exchange" in plan._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "20")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        assert scan.rdd.getNumPartitions() >= 10
        # few partitions, or other work than a scan's, is spread by a shuffle as before
        assert not shaped(scan) and not shaped(scan.filter("half = 1").select("id"))
        assert shaped(scan, 1000) and shaped(scan.groupBy("half").count(), 1) and shaped(spark.range(0, 100, 1, 20))
        assert shaped(scan.mapInArrow(lambda batches: batches, scan.schema), 1)
        made = lake.write(scan, "/five", max_partitions=5, **governed)
        sizes = [spark.read.parquet(file).count() for file in glob.glob(f"{made.folder}/*.parquet")]
    finally:
        for name in ("openCostInBytes", "minPartitionNum", "maxPartitionBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")
    assert len(sizes) == 5 and max(sizes) <= 1.5 * 20_000
    assert sorted(r["id"] for r in lake.read("/five").collect()) == list(range(100_000))


def test_hidden_files_do_not_matter(lake, ships, governed):
    made = lake.write(ships, "/a/b", **governed)
    with open(f"{made.folder}/.dataset-meta.json", "w") as file:
        file.write("{}")
    assert lake.read("/a/b").count() == 2


def test_pushdown(lake, spark, governed):
    rows = spark.range(100).select("id", (F.col("id") * 2).alias("twice"), F.lit("abc").alias("text"))
    lake.write(rows, "/a/b", **governed)
    df = lake.read("/a/b").filter((F.col("id") > 5) | F.col("text").startswith("x")).select("twice")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThan(id,5),StringStartsWith(text,x))]" in plan
    # filter columns are read as well, nothing else
    assert "ReadSchema: struct<id:bigint,twice:bigint,text:string>" in plan
    count = lake.read("/a/b").groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in count


def test_lineage_columns(lake, ships, governed):
    lake.write(ships, "/rådata/a@b", version=5, **governed)
    rows = with_lineage(lake.read("/rådata/a@b"), lake.parent_uri).select("path", "version").distinct().collect()
    assert [tuple(r) for r in rows] == [("/rådata/a@b", 5)]


def test_access(lake, spark, ships, governed):
    lake.write(ships, "/a/b", version=1, **governed)
    lake.write(ships, "/a/secret", version=1, valuation="SENSITIVE", state="RAW")
    lake.write(ships, "/ab", version=1, **governed)
    lake.grant("bob", "/a", max_valuation="SHIELDED")
    lake.grant("bob", "/a/b", privilege="WRITE", states=["INPUT"])
    bob = Lake(spark, lake.root, user="bob")
    assert bob.read("/a/b").count() == 2
    for path in ("/a/secret", "/ab"):
        with pytest.raises(PermissionDenied, match="Permission denied"):
            bob.read(path)
    bob.write(ships, "/a/b", version=2, **governed)
    assert bob.versions("/a/b").filter("version = 2").first()["created_by"] == "bob"
    with pytest.raises(PermissionDenied):
        bob.write(ships, "/a/b", valuation="INTERNAL", state="OUTPUT")
    with pytest.raises(PermissionDenied):
        bob.write(ships, "/a/c", **governed)
    with pytest.raises(PermissionDenied):
        Lake(spark, lake.root, user="eve").read("/a/b")
    seen = sorted((r["path"], r["version"]) for r in lake.accessible("bob").collect())
    assert seen == [("/a/b", 1), ("/a/b", 2)]


def test_access_moves_no_catalog_row(lake, ships, governed, monkeypatch):
    for path in ("/a/b", "/a/c", "/d"):
        for version in (1, 2):
            lake.write(ships, path, version=version, **governed)
    lake.grant("bob", "/a")
    lake.grant("bob", "/a/b")
    lake.grant("bob", "/d", max_valuation="OPEN")
    visible = lake.accessible("bob")
    seen = sorted((r["path"], r["version"]) for r in visible.collect())
    assert seen == [("/a/b", 1), ("/a/b", 2), ("/a/c", 1), ("/a/c", 2)]
    plan = visible._jdf.queryExecution().executedPlan().toString()
    rows = plan[: plan.index("Subquery")] if "Subquery" in plan else plan
    assert not any(x in rows for x in ("Exchange", "Join", "HashAggregate", "Generate"))
    monkeypatch.setattr(access, "IN_ROW", 2)  # more grants than are tested inside the row
    assert sorted((r["path"], r["version"]) for r in lake.accessible("bob").collect()) == seen
    assert lake.accessible("nobody").isEmpty()


def test_user_sees_only_what_is_granted(lake, spark, ships, governed):
    lake.write(ships, "/a/b", version=1, dataset_doc="{}", pseudo="ship=fpe-text(key1)", **governed)
    lake.write(ships, "/secret/x", version=1, **governed)
    lake.grant("bob", "/a")
    bob, eve = Lake(spark, lake.root, user="bob"), Lake(spark, lake.root, user="eve")
    assert bob.read("/sec*").isEmpty() and [r["path"] for r in bob.list("/").collect()] == ["/a/b"]
    assert {r["path"] for r in bob.documents().collect()} == {"/a/b"}
    assert bob.policies().count() == 1 and bob.versions("/a/b").count() == 1
    assert eve.list("/").isEmpty() and eve.documents().isEmpty() and eve.policies().isEmpty()
    with pytest.raises(PermissionDenied, match="Permission denied"):
        eve.versions("/secret/x")


def test_pseudonymized_dataset(lake, ships, governed):
    lake.write(ships, "/a/b", pseudo="ship=fpe-text(key1);PORT=fpe-digits( key2 )", **governed)
    stored = lake.read("/a/b")
    assert not {r["ship"] for r in stored.collect()} & {"Gull Four", "Old Tern"}
    restored = lake.read("/a/b", pseudo="ship;PORT")
    assert sorted(restored.collect()) == sorted(ships.collect())
    given = lake.read("/a/b", pseudo="ship=fpe-text(key1);PORT")
    assert sorted(given.collect()) == sorted(ships.collect())
    with pytest.raises(PolicyError, match="no function is stored"):
        lake.read("/a/b", pseudo="power")
    entries = [(r["position"], r["var"], r["pseudo_func"]) for r in lake.policies().orderBy("position").collect()]
    assert entries == [(0, "ship", "fpe-text(key1)"), (1, "PORT", "fpe-digits(key2)")]


def test_predicates_on_restored_columns_reach_the_scan(lake, spark, governed):
    rows = spark.range(200).selectExpr("id", "lpad(id % 50, 11, '0') AS fnr", "nullif(id % 5, 4) AS kind", "concat('Name ', id) AS name")
    lake.write(rows, "/people", pseudo="fnr=fpe-fnr(key1);kind=fpe-digits(key1);name=fpe-text(key2)", **governed)

    def found(**where):
        return sorted(map(tuple, lake.read("/people", pseudo="fnr;kind;name", where=where).collect()))

    def plain(condition):
        return sorted(map(tuple, rows.filter(condition).collect()))

    assert found(fnr="00000000007") == plain("fnr = '00000000007'") and len(found(fnr="00000000007")) == 4
    assert found(Fnr=["00000000007", "00000000008"], kind=2) == plain("fnr IN ('00000000007', '00000000008') AND kind = 2")
    assert found(kind=[1, None]) == plain("kind = 1 OR kind IS NULL") and found(kind=None) == plain("kind IS NULL")
    assert found(id=[3, 4], name="Name 4") == plain("id = 4") and found(name=[]) == []
    assert lake.read("/people", where={"id": 5}).count() == 1
    token = lake.read("/people").filter("id = 7").first()["fnr"]
    df = lake.read("/people", pseudo="fnr;kind;name", where={"fnr": "00000000007"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(fnr,{token})" in plan[plan.index("PushedFilters") :]
    both = lake.read("/people", pseudo="fnr", where={"fnr": ["00000000007", "00000000008"]}).select("id")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "In(fnr, [" in plan and "sha2" not in plan


def test_lookup_reads_one_bucket(lake, ships, governed):
    for i in range(4):
        lake.write(ships, f"/a/{i}x", version=1, **governed)
    files = tables.read_table(lake.spark, lake.root, "catalog", "/a/1x").inputFiles()
    assert len(files) == 1 and f"/log/{tables.key_of('/a/1x')}/" in files[0]
    lake.compact()
    files = tables.read_table(lake.spark, lake.root, "catalog", "/a/1x").inputFiles()
    assert len(files) == 1 and f"bucket={tables.bucket_number('/a/1x')}/" in files[0]
    row = tables.read_table(lake.spark, lake.root, "catalog").filter("path = '/a/1x'")
    assert row.select(tables.bucket_of(F.col("path"))).first()[0] == tables.bucket_number("/a/1x")


def test_nested_types(lake, spark, governed):
    rows = spark.sql(
        "SELECT named_struct('a b', 1, 'c', array(1.5D)) s, map('k', 1L) m, 1.25BD d, "
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' t, X'00FF' bin"
    )
    lake.write(rows, "/nested", **governed)
    back = lake.read("/nested")
    assert back.collect() == rows.collect()
    assert back.dtypes == rows.dtypes


def test_concurrent_writers(lake, spark, governed):
    from concurrent.futures import ThreadPoolExecutor

    def write(i):
        return lake.write(spark.range(i + 1), "/shared", version=100 + i, **governed)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(write, range(6)))
    assert sorted(r["version"] for r in lake.versions("/shared").collect()) == list(range(100, 106))
    assert lake.changes().count() == 12 and lake.documents().count() == 6
    assert lake.read("/shared").count() == 6


def test_one_writer_gets_a_version(lake, spark, governed):
    from concurrent.futures import ThreadPoolExecutor

    def write(i):
        try:
            return lake.write(spark.range(1000 * (i + 1)), "/race", version=1, **governed) and 1000 * (i + 1)
        except VersionExists:
            return 0

    with ThreadPoolExecutor(4) as pool:
        won = [n for n in pool.map(write, range(4)) if n]
    assert len(won) == 1
    assert lake.read("/race").count() == won[0]
    assert lake.versions("/race").count() == 1


def test_bulk_loads_at_once(lake, spark):
    from concurrent.futures import ThreadPoolExecutor

    def load(i):
        rows = spark.range(50_000 * i + 1000).selectExpr(f"concat('/l{i}/', id) path", "1L version", "'x' kind")
        tables.append_frame(rows, lake.root, "documents")

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(load, range(3)))
    assert lake.documents().count() == 153_000
    assert tables.read_table(spark, lake.root, "documents", "/l2/7").count() == 1


def test_a_crash_before_the_catalog_row_shows(lake, ships, governed, monkeypatch):
    real = tables.append_rows

    def broken(spark, root, name, rows):
        if name == "catalog":
            raise RuntimeError("gone")
        real(spark, root, name, rows)

    monkeypatch.setattr(tables, "append_rows", broken)
    with pytest.raises(RuntimeError):
        lake.write(ships, "/a", version=3, **governed)
    assert [tuple(r) for r in lake.orphans().collect()] == [("/a", 3)]
    with pytest.raises(DatasetNotFound):
        lake.read("/a")


def test_intervals_and_collations(lake, spark, governed):
    rows = spark.sql("SELECT 1 a, INTERVAL '3' DAY b, 'x' COLLATE UTF8_LCASE c, array(INTERVAL '1' MONTH) d")
    lake.write(rows, "/odd", version=1, **governed)
    back = lake.read("/odd")
    assert back.dtypes == rows.dtypes and back.filter("c = 'X'").select("a", "b").collect() == rows.select("a", "b").collect()
    fields = {f["name"]: f["avro_type"] for f in lake.catalog().first()["fields"]}
    assert fields["a"] == '"int"' and json.loads(fields["b"])["type"] == "long"
    assert fields["c"] == '"string"'
    assert json.loads(fields["d"])["items"]["type"] == "int"
    record = json.loads(avro_records(lake.catalog()).first()["avro"])
    assert [f["name"] for f in record["fields"]] == ["a", "b", "c", "d"]
    assert lake.orphans().isEmpty()


def test_lineage_below_a_data_folder(spark, ships, governed, tmp_path):
    lake = Lake(spark, str(tmp_path / "data" / "lake"))
    lake.write(ships, "/data/x/5", version=7, **governed)
    rows = with_lineage(lake.read("/data/x/5"), lake.parent_uri).select("path", "version").distinct()
    assert [tuple(r) for r in rows.collect()] == [("/data/x/5", 7)]


def test_no_limit_on_files_unless_asked(lake, spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition " not in plan(lake._shaped(spark.range(9), None))
    assert "Repartition 5, false" in plan(lake._shaped(spark.range(9), 5))


def test_slashes_and_option_names(lake, ships, governed):
    lake.save(ships, "/a//b", {"Valuation": "INTERNAL", "STATE": "INPUT", "version": "1"})
    lake.write(ships.limit(1), "/a/b/", version=2, **governed)
    assert lake.versions("/a///b").count() == 2


def test_lookup_does_not_grow_with_other_paths(lake, spark, ships, governed):
    lake.write(ships, "/one", version=1, **governed)
    bucket = tables.bucket_number("/one")
    others = (p for p in (f"/other/{i}" for i in range(10_000)) if tables.bucket_number(p) == bucket)
    row = {**lake.catalog().drop("fields", "nested").first().asDict(), "fields": [], "nested": []}
    for _ in range(20):
        tables.append_rows(spark, lake.root, "catalog", [{**row, "path": next(others)}])
    assert len(tables.read_table(spark, lake.root, "catalog", "/one").inputFiles()) == 1


def test_bulk_loaded_rows_without_schema(lake, spark, ships, governed):
    made = lake.write(ships, "/a", version=1, **governed)
    row = spark.sql(f"SELECT '/a' path, 2L version, '{lake.parent_uri}' parent_uri, 'INTERNAL' valuation, 'INPUT' state")
    ships.write.parquet(made.uri[:-1] + "2")
    tables.append_frame(row, lake.root, "catalog")
    assert sorted(lake.read("/a").collect()) == sorted(ships.collect())


def test_lineage_below_a_root_with_a_plus_sign(spark, ships, governed, tmp_path):
    lake = Lake(spark, str(tmp_path / "c++ and %41" / "lk"))
    lake.write(ships, "/a/b", version=7, **governed)
    rows = with_lineage(lake.read("/a/b"), lake.parent_uri).select("path", "version").distinct()
    assert [tuple(r) for r in rows.collect()] == [("/a/b", 7)]


def test_tables_show_what_a_user_may_read(lake, spark, ships, governed):
    lake.write(ships, "/a/b", version=1, **governed)
    lake.write(ships, "/secret/x", version=1, **governed)
    lake.grant("bob", "/a")
    lake.grant("eve", "/b")
    broken = ships.withColumn("x", F.expr("raise_error('broken row')").cast("string"))
    for path in ("/a/dead", "/secret/dead"):
        with pytest.raises(Exception, match="broken row"):
            lake.write(broken, path, version=2, **governed)
    bob, eve = Lake(spark, lake.root, user="bob"), Lake(spark, lake.root, user="eve")
    for table in (bob.catalog(), bob.changes(), bob.documents()):
        assert {r["path"] for r in table.collect()} == {"/a/b"}
    assert {r["path"] for r in bob.orphans().collect()} == {"/a/dead"}
    assert {r["path_prefix"] for r in bob.grants().collect()} == {"/a"}
    assert eve.catalog().isEmpty() and eve.changes().isEmpty() and eve.orphans().isEmpty()
    assert lake.catalog().count() == 2 and lake.orphans().count() == 2
