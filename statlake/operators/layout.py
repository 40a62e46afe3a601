"""Partitioning of inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame) -> DataFrame:
    """Spread a plain scan that would keep less than half of the session's cores busy, ahead of
    CPU-heavy work: a file with one row group is one task, however many rows it holds. Scans with
    enough partitions, which is any large dataset, are returned as they are and not shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if 2 * scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def plain_scan(df: DataFrame) -> bool:
    """Whether the rows come straight from files, through filters and native projections at most: nothing
    runs to count their partitions, and little work is lost if fewer tasks read them.
    """
    node = df._jdf.queryExecution().sparkPlan()
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().head()
    return node.getClass().getSimpleName() == "FileSourceScanExec"
