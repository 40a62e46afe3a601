"""Operators over the catalog and the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The file a change event names, for the metadata event and the commit event.
META_FILE = ".dataset-meta.json"
COMMIT_FILE = ".dataset-meta.json.sign"
# The same for the event that a dead write was cleared away.
DISCARD_FILE = ".dataset-meta.json.discarded"


def list_prefix(catalog: DataFrame, prefix: str, *columns: str) -> DataFrame:
    """Datasets whose path starts with a prefix; ``path`` only, unless more columns are named.

    The prefix test reaches the Parquet scan, and the distinct combines inside each task before
    anything is shuffled."""
    return catalog.filter(F.col("path").startswith(prefix)).select("path", *columns).distinct()


def current_catalog(catalog: DataFrame, snapshot: int = 0) -> DataFrame:
    """The newest committed version of each path, or the newest up to a snapshot (0 = latest)."""
    rows = catalog if snapshot == 0 else catalog.filter(F.col("version") <= snapshot)
    rest = [c for c in catalog.columns if c != "path"]
    # should two attempts ever have one version, the earlier one counts
    order = F.struct(-F.col("version"), F.col("attempt")) if "attempt" in rest else -F.col("version")
    newest = rows.groupBy("path").agg(F.min_by(F.struct(*rest), order).alias("newest"))
    return newest.select("path", *[F.col(f"newest.{c}").alias(c) for c in rest])


def _kinds(changes: DataFrame) -> DataFrame:
    """One row for each version with the number of its events of both kinds."""

    def count_of(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    return changes.groupBy("path", "version").agg(
        count_of("meta").alias("meta_events"), count_of("commit").alias("commit_events")
    )


def committed_versions(changes: DataFrame) -> DataFrame:
    """Versions with both a metadata event and a commit event."""
    return (
        _kinds(changes)
        .filter((F.col("meta_events") > 0) & (F.col("commit_events") > 0))
        .select("path", "version")
    )


def change_log(changes: DataFrame) -> DataFrame:
    """Events of each kind and the time of the last one, for each version."""
    return changes.groupBy("path", "version", "kind").agg(
        F.count("*").alias("events"), F.max("ts").alias("last_ts")
    )
