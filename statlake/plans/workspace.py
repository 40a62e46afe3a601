"""Where queries keep the lakes they write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.errors import LakeError
from statlake.lake import Lake

# Secrets of the queries' policies.
KEYS = {"key1": "first secret of the queries", "key2": "second secret of the queries"}

_published: dict[tuple[str, str], Lake] = {}
_datasets: set[tuple[str, str, str]] = set()


def scratch_root(spark: SparkSession) -> str:
    """A new directory in the shared folder that ``spark.checkpoint.dir`` names. Only a local
    session may do without that setting; it gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise LakeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="statlake-")
    return f"{base.rstrip('/')}/statlake-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"


def fresh_lake(spark: SparkSession, **options) -> Lake:
    return Lake(spark, scratch_root(spark), keys=KEYS, **options)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def published_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake that the queries of a session share."""
    session = (spark.sparkContext.applicationId, sf_dir)
    if session not in _published:
        _published[session] = fresh_lake(spark)
    return _published[session]


def published(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table read back from the shared lake: each table is written once, however many queries
    scan it."""
    session = (spark.sparkContext.applicationId, sf_dir)
    lake = published_lake(spark, sf_dir)
    path = f"/tables/{name}"
    if (*session, path) not in _datasets:
        df = table(spark, sf_dir, name)
        if name == "lineitem":
            # the tables hold no nulls: line 1 stands for a missing line number
            df = df.withColumn("ln", F.nullif("l_linenumber", F.lit(1)))
        lake.write(df, path, valuation="INTERNAL", state="INPUT", version=1000)
        _datasets.add((*session, path))
    return lake.read(path)
