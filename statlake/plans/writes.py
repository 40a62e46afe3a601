"""Writing datasets: versions, layout, documents, events and the commit protocol."""

from __future__ import annotations

import json

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from statlake.functions.paths import with_lineage
from statlake.operators import catalog as catalog_ops
from statlake.operators.documents import documents_of, meta_json, parsed_documents
from statlake.plans.registry import query
from statlake.plans.workspace import fresh_lake, table
from statlake.sources import tables
from statlake.sources.tables import append_frame
from statlake.streaming.changes import change_stream, commits, read_commits, write_commits

GOVERNED = {"valuation": "INTERNAL", "state": "INPUT"}


@query("write_new_version", "SELECT * FROM orders")
def write_new_version(spark, sf_dir):
    lake = fresh_lake(spark)
    lake.write(table(spark, sf_dir, "orders"), "/tables/orders", **GOVERNED)
    return lake.read("/tables/orders")


@query(
    "write_overwrite_is_new_version",
    """SELECT o_orderkey, o_custkey, o_orderstatus, -o_totalprice AS o_totalprice, o_orderdate,
              lower(o_orderpriority) AS o_orderpriority FROM orders""",
)
def write_overwrite_is_new_version(spark, sf_dir):
    lake = fresh_lake(spark)
    orders = table(spark, sf_dir, "orders")
    lake.write(orders, "/tables/orders", version=1, **GOVERNED)
    changed = orders.withColumns(
        {"o_totalprice": -F.col("o_totalprice"), "o_orderpriority": F.lower("o_orderpriority")}
    )
    lake.write(changed, "/tables/orders", **GOVERNED)
    return lake.read("/tables/orders")


@query(
    "write_explicit_version",
    "SELECT c_custkey, c_mktsegment, '/tables/customer' AS path, CAST(1000 AS BIGINT) AS version FROM customer",
)
def write_explicit_version(spark, sf_dir):
    lake = fresh_lake(spark)
    customer = table(spark, sf_dir, "customer")
    lake.save(customer, "/tables/customer", {**GOVERNED, "version": "1000"})
    rows = with_lineage(lake.read("/tables/customer"), lake.parent_uri)
    return rows.select("c_custkey", "c_mktsegment", "path", "version")


@query("write_repartition", "SELECT * FROM lineitem")
def write_repartition(spark, sf_dir):
    lake = fresh_lake(spark)
    lake.write(table(spark, sf_dir, "lineitem"), "/tables/lineitem", max_partitions=5, **GOVERNED)
    return lake.read("/tables/lineitem")


@query("write_no_repartition", "SELECT * FROM lineitem")
def write_no_repartition(spark, sf_dir):
    lake = fresh_lake(spark)
    options = {**GOVERNED, "auto-repartition": "false"}
    lake.save(table(spark, sf_dir, "lineitem"), "/tables/lineitem", options)
    return lake.read("/tables/lineitem")


# -- documents -------------------------------------------------------------------------------


def _part_entries(spark, sf_dir):
    """Each part as version 1 of a dataset of its own."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("/parts/"), F.col("p_partkey").cast("string")).alias("path"),
        F.lit(1).cast("bigint").alias("version"),
        "*",
    )


# Tables that are written with their documents; each row of parts stands for a bulk-loaded document.
_DOCUMENTED = ("region", "nation", "supplier", "customer", "orders")


def _documented(spark, sf_dir, bulk):
    """The documents of a lake that holds tables written with documentation and lineage, beside a bulk
    load of other documents."""
    lake = fresh_lake(spark)
    for name in _DOCUMENTED:
        rows = table(spark, sf_dir, name)
        fields = [{"name": n, "description": kind} for n, kind in rows.dtypes[:2]]
        lake.write(
            rows,
            f"/tables/{name}",
            version=7,
            dataset_doc=json.dumps({"title": name, "fields": fields}),
            lineage_doc=json.dumps({"sources": [f"/raw/{name}"], "price": float(rows.count())}),
            **GOVERNED,
        )
    append_frame(bulk, lake.root, "documents")
    lake.compact()
    return lake.documents()


def _each_documented(sql):
    return "".join(f" UNION ALL {sql.format(name=name)}" for name in _DOCUMENTED)


@query(
    "documents_meta",
    """SELECT '/parts/' || p_partkey AS path, CAST(1 AS BIGINT) AS version, '/parts/' || p_partkey AS id_path,
              '1' AS id_version, 'INTERNAL' AS valuation, 'INPUT' AS state, p_brand AS created_by FROM part"""
    + _each_documented("SELECT '/tables/{name}', CAST(7 AS BIGINT), '/tables/{name}', '7', 'INTERNAL', 'INPUT', NULL"),
)
def documents_meta(spark, sf_dir):
    documents = _part_entries(spark, sf_dir).select(
        "path",
        "version",
        F.lit("meta").alias("kind"),
        meta_json(
            F.col("path"), F.col("version"), F.lit("INTERNAL"), F.lit("INPUT"), F.col("p_brand")
        ).alias("json"),
    )
    schema = "id struct<path:string,version:string>, valuation string, state string, createdBy string"
    return parsed_documents(_documented(spark, sf_dir, documents), "meta", schema).select(
        "path",
        "version",
        F.col("id.path").alias("id_path"),
        F.col("id.version").alias("id_version"),
        "valuation",
        "state",
        F.col("createdBy").alias("created_by"),
    )


@query(
    "documents_doc",
    """SELECT '/parts/' || p_partkey AS path, p_name AS title, name, description FROM (
         SELECT p_partkey, p_name, 'type' AS name, p_type AS description FROM part
         UNION ALL SELECT p_partkey, p_name, 'brand', p_brand FROM part)"""
    + _each_documented(
        """SELECT '/tables/{name}', '{name}', column_name,
                  CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END
           FROM (SELECT *, row_number() OVER () AS n FROM (DESCRIBE SELECT * FROM {name})) WHERE n <= 2"""
    ),
)
def documents_doc(spark, sf_dir):
    entries = _part_entries(spark, sf_dir).select(
        "path",
        "version",
        F.col("p_name").alias("title"),
        F.array(
            F.struct(F.lit("type").alias("name"), F.col("p_type").alias("description")),
            F.struct(F.lit("brand").alias("name"), F.col("p_brand").alias("description")),
        ).alias("fields"),
    )
    documents = documents_of(entries, "doc", "title", "fields")
    schema = "title string, fields array<struct<name:string,description:string>>"
    return parsed_documents(_documented(spark, sf_dir, documents), "doc", schema).select(
        "path", "title", F.inline("fields")
    )


@query(
    "documents_lineage",
    """SELECT '/parts/' || p_partkey AS path, '/suppliers/' || p_size AS source_path, p_retailprice AS price
       FROM part"""
    + _each_documented("SELECT '/tables/{name}', '/raw/{name}', CAST(count(*) AS DOUBLE) FROM {name}"),
)
def documents_lineage(spark, sf_dir):
    entries = _part_entries(spark, sf_dir).select(
        "path",
        "version",
        F.array(F.concat(F.lit("/suppliers/"), F.col("p_size").cast("string"))).alias("sources"),
        F.col("p_retailprice").alias("price"),
    )
    documents = documents_of(entries, "lineage", "sources", "price")
    content = parsed_documents(_documented(spark, sf_dir, documents), "lineage", "sources array<string>, price double")
    return content.select("path", F.explode("sources").alias("source_path"), "price")


# -- catalog and change log ------------------------------------------------------------------

_STATE = "CASE o_orderstatus WHEN 'F' THEN 'OUTPUT' WHEN 'O' THEN 'INPUT' ELSE 'RAW' END"


@query(
    "catalog_current",
    f"""SELECT '/customers/' || o_custkey AS path, max(o_orderkey) AS version,
               arg_max({_STATE}, o_orderkey) AS state FROM orders GROUP BY o_custkey
        UNION ALL SELECT '/tables/nation', CAST(5 AS BIGINT), 'OUTPUT'
        UNION ALL SELECT '/tables/region', CAST(3 AS BIGINT), 'INPUT'""",
)
def catalog_current(spark, sf_dir):
    lake = fresh_lake(spark)
    for name, version, state in (("nation", 2, "RAW"), ("nation", 5, "OUTPUT"), ("region", 3, "INPUT")):
        lake.write(table(spark, sf_dir, name), f"/tables/{name}", version=version, valuation="INTERNAL", state=state)
    entries = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("/customers/"), F.col("o_custkey").cast("string")).alias("path"),
        F.col("o_orderkey").alias("version"),
        F.expr(_STATE).alias("state"),
    )
    append_frame(entries, lake.root, "catalog")
    lake.compact()
    return catalog_ops.current_catalog(lake.catalog()).select("path", "version", "state")


_EVENTS_SQL = """
  SELECT '/users/' || user_id AS path, date_diff('day', DATE '2020-01-01', CAST(ts AS DATE)) AS version,
         CASE event_type WHEN 'purchase' THEN 'commit' WHEN 'view' THEN 'meta' WHEN 'click' THEN 'meta'
              ELSE event_type END AS kind FROM events"""


def event_changes(spark, sf_dir):
    """User events as change events: the dataset of a user gets one version a day, views and clicks
    announce it, a purchase commits it."""
    events = table(spark, sf_dir, "events")
    kind = F.expr(
        "CASE event_type WHEN 'purchase' THEN 'commit' WHEN 'view' THEN 'meta' "
        "WHEN 'click' THEN 'meta' ELSE event_type END"
    )
    changes = events.select(
        F.concat(F.lit("/users/"), F.col("user_id").cast("string")).alias("path"),
        F.expr("cast(datediff(ts, DATE'2020-01-01') as bigint)").alias("version"),
        kind.alias("kind"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    return changes.withColumn("uri", F.concat_ws("/", "path", F.col("version").cast("string"), "kind"))


# A committed version without a catalog row: a writer that died between the two.
_UNCATALOGUED = "version % 7 = 0"


def _eventful_lake(spark, sf_dir):
    """A lake with the user events as bulk-loaded change events, catalog rows of the versions they commit
    but for some, two tables written, and a write that fails."""
    lake = fresh_lake(spark)
    for name in ("nation", "orders"):
        lake.write(table(spark, sf_dir, name), f"/tables/{name}", version=7, **GOVERNED)
    broken = table(spark, sf_dir, "region").withColumn("r_name", F.expr("raise_error(concat('broken ', r_name))").cast("string"))
    try:
        lake.write(broken, "/tables/region", version=7, **GOVERNED)
    except PySparkException:
        pass
    changes = event_changes(spark, sf_dir)
    append_frame(changes, lake.root, "changes")
    done = catalog_ops.committed_versions(changes).filter(f"NOT {_UNCATALOGUED}")
    append_frame(done, lake.root, "catalog")
    lake.compact()
    return lake


_WRITTEN_SQL = """
  SELECT '/tables/' || name AS path, CAST(7 AS BIGINT) AS version, kind
  FROM (VALUES ('nation', 'meta'), ('nation', 'commit'), ('orders', 'meta'), ('orders', 'commit'), ('region', 'meta')) AS t(name, kind)"""
_ALL_EVENTS_SQL = f"({_EVENTS_SQL} UNION ALL {_WRITTEN_SQL})"


@query(
    "committed_versions",
    f"""SELECT path, version FROM {_ALL_EVENTS_SQL} GROUP BY path, version
        HAVING count(*) FILTER (kind = 'meta') > 0 AND count(*) FILTER (kind = 'commit') > 0""",
)
def committed_versions(spark, sf_dir):
    return catalog_ops.committed_versions(_eventful_lake(spark, sf_dir).changes())


@query(
    "orphan_versions",
    f"""SELECT path, version FROM {_ALL_EVENTS_SQL} GROUP BY path, version
        HAVING count(*) FILTER (kind = 'meta') > 0
            AND (count(*) FILTER (kind = 'commit') = 0 OR ({_UNCATALOGUED} AND path LIKE '/users/%'))""",
)
def orphan_versions(spark, sf_dir):
    return _eventful_lake(spark, sf_dir).orphans()


@query(
    "change_log",
    f"SELECT path, version, kind, count(*) AS events FROM {_ALL_EVENTS_SQL} GROUP BY path, version, kind",
)
def change_log(spark, sf_dir):
    lake = _eventful_lake(spark, sf_dir)
    return catalog_ops.change_log(lake.changes()).select("path", "version", "kind", "events")


@query(
    "change_stream_commits",
    f"SELECT DISTINCT path, version FROM ({_EVENTS_SQL}) WHERE kind = 'commit'",
)
def change_stream_commits(spark, sf_dir):
    lake = fresh_lake(spark)
    uri = f"{lake.root}/streams/commits"
    append_frame(event_changes(spark, sf_dir), lake.root, "changes")
    for _ in range(2):  # the second run meets the events of the first again, as a compaction wrote them
        write_commits(commits(change_stream(spark, lake.root)), uri, f"{uri}-checkpoint")
        tables.compact(spark, lake.root, "changes")
        append_frame(event_changes(spark, sf_dir).filter("version % 5 = 0"), lake.root, "changes")
    return read_commits(spark, uri).select("path", "version")
