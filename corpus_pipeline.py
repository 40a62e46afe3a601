"""From raw documents to shards of a training mix, each stage written as Parquet and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.llm.common import materialize, narrowed, read
from statlake.llm.decontaminate import contaminated
from statlake.llm.kd_shards import kd_shards
from statlake.llm.mixing import mix_sources
from statlake.llm.near_dedup import near_duplicates
from statlake.llm.queries import training_labels
from statlake.llm.toxicity import fit_toxicity, toxicity_score

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def row_key() -> Column:
    """What tells rows apart: the id, which may be null or repeated, and the text."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    model = fit_toxicity(docs, training_labels(spark, sf_dir))
    return docs.filter(toxicity_score(docs, model) < 0.5).select(*COLUMNS)


def _nodes(docs: DataFrame) -> DataFrame:
    """The rows with a node: their doc_id, or above all usual ids one for each text of null ids and each further text of repeated ones."""
    rows = docs.select(*COLUMNS, row_key().alias("key"))
    # ids that stand for several texts are found without the texts; the smallest text of an id keeps it, a null id is no one's
    several = rows.groupBy("doc_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    several = materialize(several.filter("doc_id is not null and lo < hi").select("doc_id"))
    if several.head(1):
        again = narrowed(rows, several, "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "key"))["key"].alias("first"))
        several = materialize(again)
    own = F.col("key").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    if several.head(1):
        rows = rows.join(several, "doc_id", "left")
    else:
        rows = rows.withColumn("first", F.lit(None).cast("long"))
    further = F.col("doc_id").isNull() | F.coalesce(F.col("key") != F.col("first"), F.lit(False))
    return rows.select(*COLUMNS, F.when(further, own).otherwise(F.col("doc_id").cast("long")).alias("node"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, once: its smallest doc_id.

    Rows are one only if id and text are equal. A null id and the further texts of a repeated one stand
    for themselves and come after all other ids; they go if their text is near another's.
    """
    nodes = _nodes(docs)
    rest = near_duplicates(nodes.select(F.col("node").alias("doc_id"), "text")).filter("not kept").select(F.col("doc_id").alias("node")).distinct()
    whole = nodes.join(materialize(rest), "node", "left_anti")
    # equal rows: one stays
    several = materialize(nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").select("node"))
    if not several.head(1):
        return whole.select(*COLUMNS)
    again = whole.join(several, "node").groupBy("node").agg(F.min(F.struct(*COLUMNS)).alias("first")).select("first.*")
    return whole.join(several, "node", "left_anti").select(*COLUMNS).unionByName(again.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, each by its own text, whether its doc_id is null or repeated."""
    rows = docs.select(*COLUMNS, row_key().alias("key"))
    own = rows.select(F.col("key").alias("doc_id"), "text")
    leaks = contaminated(own, read(spark, sf_dir, "benchmark")).filter("contaminated").select(F.col("doc_id").alias("key")).distinct()
    return rows.join(materialize(leaks), "key", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    mixed = mix_sources(docs.select(*COLUMNS))
    return mixed.filter("copies > 0").select(*COLUMNS, F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_")).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row of the mix."""
    return kd_shards(docs, shards=40)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs


#: The toxicity model and the groups of near duplicates are not expressible in SQL.
ORACLE_SQL = None
