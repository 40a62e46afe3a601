import pytest
from pyspark.sql import DataFrameWriter

from statlake import depseudonymize, pseudonymize
from statlake.sources.tables import append_frame
from statlake.streaming.changes import change_stream, commits, read_commits, write_available, write_commits

KEYS = {"key1": "secret one"}


def feed(lake, uri):
    return sorted((r["path"], r["version"]) for r in read_commits(lake.spark, uri).collect())


def test_commits_follow_writes(lake, spark, governed, tmp_path):
    uri, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    rows = spark.range(3)
    assert feed(lake, uri) == []
    lake.write(rows, "/a", version=1, **governed)

    def run():
        write_commits(commits(change_stream(spark, lake.root)), uri, checkpoint)
        return feed(lake, uri)

    assert run() == [("/a", 1)]
    lake.write(rows, "/b", version=1, **governed)
    # the same events again: announced again, in one batch and in the next, and written by a compaction
    append_frame(lake.changes().unionAll(lake.changes()), lake.root, "changes")
    assert run() == [("/a", 1), ("/b", 1)]
    lake.compact()
    lake.vacuum(grace_s=0)
    append_frame(lake.changes(), lake.root, "changes")
    assert run() == [("/a", 1), ("/b", 1)]
    # another checkpoint starts anew, the feed does not
    write_commits(commits(change_stream(spark, lake.root)), uri, f"{checkpoint}-2")
    assert feed(lake, uri) == [("/a", 1), ("/b", 1)]


def test_a_run_that_dies_between_batch_and_checkpoint(lake, spark, tmp_path, monkeypatch):
    uri, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def announce(*paths):
        rows = " UNION ALL ".join(f"SELECT '{p}/1/x' uri, '{p}' path, 1L version, 'commit' kind, current_timestamp() ts" for p in paths)
        append_frame(spark.sql(rows), lake.root, "changes")

    def run():
        write_commits(commits(change_stream(spark, lake.root)), uri, checkpoint)

    announce("/a")
    run()
    announce("/a", "/b", "/c")
    real = DataFrameWriter.parquet

    def dying(self, path, *args, **named):
        real(self, path, *args, **named)
        if "/batch=" in path:
            raise RuntimeError("killed after the write")

    with monkeypatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", dying)
        with pytest.raises(Exception, match="killed after the write"):
            run()
    announce("/c", "/d")
    run()
    assert feed(lake, uri) == [("/a", 1), ("/b", 1), ("/c", 1), ("/d", 1)]


def test_late_commits_come_out(lake, spark, tmp_path):
    uri, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for i, hour in enumerate((12, 9, 13)):
        event = f"'/p{i}/1/x' uri, '/p{i}' path, 1L version, 'commit' kind, timestamp'2024-01-01 {hour}:00:00' ts"
        append_frame(spark.sql(f"SELECT {event}"), lake.root, "changes")
        write_commits(commits(change_stream(spark, lake.root)), uri, checkpoint)
    assert [p for p, _ in feed(lake, uri)] == ["/p0", "/p1", "/p2"]
    plan = commits(lake.changes())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Arrow" not in plan


def test_pseudonymized_stream(spark, tmp_path):
    source, uri = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(100).selectExpr("id", "concat('user-', id) AS name")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    write_available(pseudonymize(stream, "name=fpe-text(key1)", KEYS), uri, str(tmp_path / "checkpoint"))
    stored = spark.read.parquet(uri)
    assert sorted(stored.collect()) == sorted(pseudonymize(rows, "name=fpe-text(key1)", KEYS).collect())
    assert sorted(depseudonymize(stored, "name=fpe-text(key1)", KEYS).collect()) == sorted(rows.collect())
