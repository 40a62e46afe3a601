"""The change log as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from statlake.sources.store import Store
from statlake.sources.tables import CHANGES, bucket_of, rows_frame, table_uri


def change_stream(spark: SparkSession, root: str) -> DataFrame:
    """Events as they are appended to the change log."""
    reader = spark.readStream.schema(CHANGES).option("recursiveFileLookup", "true")
    # a folded append may go between the listing and the read: its events are in the compaction's files
    reader = reader.option("ignoreMissingFiles", "true")
    return reader.parquet(table_uri(root, "changes"))


def commits(changes: DataFrame) -> DataFrame:
    """Commit events as (path, version, ts), without state: however late an event comes, it comes out.

    An event that is announced again, or that a compaction writes again, comes out again; the feed that
    ``write_commits`` keeps has it once.
    """
    events = changes.filter((F.col("kind") == "commit") & F.col("uri").isNotNull())
    return events.select("path", "version", "ts")


_FEED = T.StructType([f for f in CHANGES.fields if f.name in ("path", "version", "ts")])
# query, batch and bucket are folders, so a filter on a bucket reads no others
_FEED_FOLDERS = T.StructType(
    [*_FEED.fields, *(T.StructField(n, t) for n, t in (("query", T.StringType()), ("batch", T.LongType()), ("bucket", T.IntegerType())))]
)


def read_commits(spark: SparkSession, uri: str) -> DataFrame:
    """The feed of ``write_commits``: each committed version once, with the time of its first event there."""
    if not Store(spark).exists(uri):
        return rows_frame(spark, _FEED, [])
    return spark.read.schema(_FEED_FOLDERS).parquet(uri).select(*_FEED.names)


def write_commits(events: DataFrame, uri: str, checkpoint: str) -> StreamingQuery:
    """Bring a feed of commits up to date with all events that are available, then stop.

    The feed is distinct by (path, version) in itself, with neither a watermark nor state that grows in
    memory: each batch takes the versions that the feed does not have yet, by a join with those of
    its buckets only, and replaces a folder of its own. A batch that died between its write and its
    checkpoint is run again with the same number and the same events, and replaces what it left.
    One query at a time may keep a feed.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        own = f"{uri}/query={query}/batch={number}"
        Store(spark).delete(own)
        new = batch.groupBy("path", "version").agg(F.min("ts").alias("ts"))
        new = new.withColumn("bucket", bucket_of(F.col("path")))
        if Store(spark).exists(uri):
            buckets = [r["bucket"] for r in batch.select(bucket_of(F.col("path")).alias("bucket")).distinct().collect()]
            known = spark.read.schema(_FEED_FOLDERS).parquet(uri).filter(F.col("bucket").isin(buckets))
            new = new.join(known.select("path", "version"), ["path", "version"], "left_anti")
        new.hint("rebalance", "bucket").select(*_FEED.names, "bucket").write.partitionBy("bucket").parquet(own)

    query = (
        events.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_available(stream: DataFrame, uri: str, checkpoint: str) -> StreamingQuery:
    """Append all that is available to a Parquet directory, exactly once, then stop. The
    checkpoint must lie on storage that all executors share."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", uri)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
