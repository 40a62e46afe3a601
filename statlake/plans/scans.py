"""Reading datasets: versions, scans, predicates, projections, listing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from statlake.functions.paths import is_valid_read_path, is_valid_write_path, with_lineage
from statlake.operators.access import accessible
from statlake.plans.registry import query
from statlake.plans.workspace import fresh_lake, published, published_lake, table
from statlake.sources.tables import append_frame

GOVERNED = {"valuation": "INTERNAL", "state": "INPUT"}


def _two_versions(spark, sf_dir):
    """The customers as they are, then a version with raised balances."""
    lake = fresh_lake(spark)
    customer = table(spark, sf_dir, "customer")
    lake.write(customer, "/tables/customer", version=1, **GOVERNED)
    raised = customer.withColumn("c_acctbal", F.col("c_acctbal") + 100)
    lake.write(raised, "/tables/customer", version=2, **GOVERNED)
    return lake


@query(
    "read_latest",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment FROM customer",
)
def read_latest(spark, sf_dir):
    return _two_versions(spark, sf_dir).read("/tables/customer")


@query("read_as_of", "SELECT * FROM customer")
def read_as_of(spark, sf_dir):
    return _two_versions(spark, sf_dir).read("/tables/customer", snapshot=1)


@query("scan_full", "SELECT * FROM orders")
def scan_full(spark, sf_dir):
    return published(spark, sf_dir, "orders")


@query(
    "scan_pruned_filtered",
    """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
       WHERE l_quantity > 45 AND l_returnflag = 'R'""",
)
def scan_pruned_filtered(spark, sf_dir):
    return (
        published(spark, sf_dir, "lineitem")
        .filter((F.col("l_quantity") > 45) & (F.col("l_returnflag") == "R"))
        .select("l_orderkey", "l_partkey", "l_quantity")
    )


@query("scan_count", "SELECT count(*) AS n FROM lineitem")
def scan_count(spark, sf_dir):
    return published(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@query(
    "scan_lineage_columns",
    """SELECT '/tables/orders' AS path, CAST(1000 AS BIGINT) AS version, o_orderstatus, count(*) AS n
       FROM orders GROUP BY o_orderstatus""",
)
def scan_lineage_columns(spark, sf_dir):
    rows = with_lineage(published(spark, sf_dir, "orders"), published_lake(spark, sf_dir).parent_uri)
    return rows.groupBy("path", "version", "o_orderstatus").agg(F.count("*").alias("n"))


# -- predicates ------------------------------------------------------------------------------


def _predicate(name, dataset, columns, predicate, condition):
    sql = f"SELECT {', '.join(columns.values())} FROM {dataset} WHERE {condition}"

    @query(name, sql)
    def run(spark, sf_dir):
        rows = published(spark, sf_dir, dataset).filter(predicate())
        return rows.select(*columns)

    return run


def _plain(*names):
    return {name: name for name in names}


_LINE = {
    **_plain("l_orderkey", "l_partkey", "l_linenumber"),
    "ln": "nullif(l_linenumber, 1) AS ln",
}
_ORDER = _plain("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
_CUSTOMER = _plain("c_custkey", "c_name", "c_nationkey", "c_mktsegment")

_predicate("pred_eq", "orders", _ORDER, lambda: F.col("o_orderstatus") == "O", "o_orderstatus = 'O'")
_predicate(
    "pred_eq_null_safe",
    "lineitem",
    _LINE,
    lambda: F.col("ln").eqNullSafe(2) | F.col("ln").eqNullSafe(None),
    "nullif(l_linenumber, 1) IS NOT DISTINCT FROM 2 OR nullif(l_linenumber, 1) IS NOT DISTINCT FROM NULL",
)
_predicate("pred_gt", "orders", _ORDER, lambda: F.col("o_totalprice") > 100000, "o_totalprice > 100000")
_predicate(
    "pred_ge",
    "orders",
    _ORDER,
    lambda: F.col("o_orderdate") >= F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz"),
    "o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'",
)
_predicate("pred_lt", "lineitem", _LINE, lambda: F.col("ln") < 4, "nullif(l_linenumber, 1) < 4")
_predicate("pred_le", "orders", _ORDER, lambda: F.col("o_totalprice") <= 2500.5, "o_totalprice <= 2500.5")
_predicate(
    "pred_in", "customer", _CUSTOMER, lambda: F.col("c_nationkey").isin(1, 3, 24), "c_nationkey IN (1, 3, 24)"
)
_predicate("pred_is_null", "lineitem", _LINE, lambda: F.col("ln").isNull(), "nullif(l_linenumber, 1) IS NULL")
_predicate(
    "pred_is_not_null",
    "lineitem",
    _LINE,
    lambda: F.col("ln").isNotNull(),
    "nullif(l_linenumber, 1) IS NOT NULL",
)
_predicate(
    "pred_contains",
    "orders",
    _ORDER,
    lambda: F.col("o_orderpriority").contains("T S"),
    "contains(o_orderpriority, 'T S')",
)
_predicate(
    "pred_starts_with",
    "customer",
    _CUSTOMER,
    lambda: F.col("c_mktsegment").startswith("M"),
    "starts_with(c_mktsegment, 'M')",
)
_predicate(
    "pred_ends_with",
    "customer",
    _CUSTOMER,
    lambda: F.col("c_name").endswith("7"),
    "ends_with(c_name, '7')",
)
_predicate(
    "pred_not",
    "orders",
    _ORDER,
    lambda: ~F.col("o_orderpriority").startswith("1") & ~(F.col("o_orderstatus") == "F"),
    "NOT starts_with(o_orderpriority, '1') AND NOT o_orderstatus = 'F'",
)
_predicate(
    "pred_and",
    "lineitem",
    _LINE,
    lambda: (F.col("ln") >= 3) & (F.col("l_quantity") <= 10) & F.col("l_returnflag").isin("A", "R"),
    "nullif(l_linenumber, 1) >= 3 AND l_quantity <= 10 AND l_returnflag IN ('A', 'R')",
)
_predicate(
    "pred_or",
    "orders",
    _ORDER,
    lambda: (F.col("o_orderstatus") == "P") | (F.col("o_totalprice") > 400000),
    "o_orderstatus = 'P' OR o_totalprice > 400000",
)
_predicate(
    "pred_on_unselected",
    "lineitem",
    _plain("l_orderkey", "l_suppkey"),
    lambda: (F.col("l_discount") >= 0.05) & (F.col("l_linestatus") == "F"),
    "l_discount >= 0.05 AND l_linestatus = 'F'",
)


# -- listing and paths -----------------------------------------------------------------------

# valuation and state of a document's dataset, from its length
_VALUATION = "CASE {n} % 4 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'INTERNAL' WHEN 2 THEN 'SHIELDED' ELSE 'SENSITIVE' END"
_STATE = "CASE {n} % 3 WHEN 0 THEN 'RAW' WHEN 1 THEN 'INPUT' ELSE 'OUTPUT' END"


def document_catalog(spark, sf_dir):
    """Each document as a version of the dataset of its source and language."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/docs/"), "source", F.lit("/"), "lang").alias("path"),
        (F.col("doc_id") + 1).alias("version"),
        F.expr(_VALUATION.format(n="n_chars")).alias("valuation"),
        F.expr(_STATE.format(n="n_chars")).alias("state"),
    )


@query("list_prefix", "SELECT DISTINCT '/docs/' || source || '/' || lang AS path FROM documents")
def list_prefix(spark, sf_dir):
    lake = fresh_lake(spark)
    web = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("/web/page"), "page_id").alias("path"), F.lit(1).cast("bigint").alias("version")
    )
    entries = document_catalog(spark, sf_dir).unionByName(web, allowMissingColumns=True)
    append_frame(entries, lake.root, "catalog")
    return lake.read("/docs/*")


@query(
    "list_accessible",
    f"""WITH entries AS (
          SELECT '/docs/' || source || '/' || lang AS path, doc_id + 1 AS version,
                 n_chars % 4 AS rank, {_STATE.format(n='n_chars')} AS state FROM documents),
        grants AS (
          SELECT '/docs/src' || n_nationkey AS prefix, n_nationkey % 4 AS max_rank,
                 CASE WHEN n_nationkey % 2 = 0 THEN ['RAW', 'OUTPUT'] END AS states
          FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))
        SELECT path, version, state FROM entries
        WHERE EXISTS (SELECT 1 FROM grants
                      WHERE (path = prefix OR starts_with(path, prefix || '/')) AND rank <= max_rank
                        AND (states IS NULL OR list_contains(states, state)))""",
)
def list_accessible(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    grants = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.when(F.col("r_name").isin("ASIA", "EUROPE"), "analyst").otherwise("other").alias("user"),
        F.concat(F.lit("/docs/src"), "n_nationkey").alias("path_prefix"),
        F.lit("READ").alias("privilege"),
        F.expr(_VALUATION.format(n="n_nationkey")).alias("max_valuation"),
        F.expr("CASE WHEN n_nationkey % 2 = 0 THEN array('RAW', 'OUTPUT') END").alias("states"),
    )
    visible = accessible(document_catalog(spark, sf_dir), grants, "analyst")
    return visible.select("path", "version", "state")


def _paths(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.regexp_replace("url", "^[a-z]+:/", "").alias("p"))


@query(
    "valid_read_paths",
    r"""SELECT page_id, p, regexp_full_match(p, '/[\p{L}\d_/.@-]+\*?') AS ok,
               regexp_full_match(p || '*', '/[\p{L}\d_/.@-]+\*?') AS ok_as_prefix
        FROM (SELECT page_id, regexp_replace(url, '^[a-z]+:/', '') AS p FROM pages)""",
)
def valid_read_paths(spark, sf_dir):
    return _paths(spark, sf_dir).select(
        "page_id",
        "p",
        is_valid_read_path(F.col("p")).alias("ok"),
        is_valid_read_path(F.concat("p", F.lit("*"))).alias("ok_as_prefix"),
    )


@query(
    "valid_write_paths",
    r"""SELECT page_id, p, regexp_full_match(p, '/[\p{L}\d_/.@-]+') AS ok,
               regexp_full_match(p || '*', '/[\p{L}\d_/.@-]+') AS ok_as_prefix
        FROM (SELECT page_id, regexp_replace(url, '^[a-z]+:/', '') AS p FROM pages)""",
)
def valid_write_paths(spark, sf_dir):
    return _paths(spark, sf_dir).select(
        "page_id",
        "p",
        is_valid_write_path(F.col("p")).alias("ok"),
        is_valid_write_path(F.concat("p", F.lit("*"))).alias("ok_as_prefix"),
    )
