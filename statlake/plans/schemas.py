"""Schemas as data: of the given tables as ``Lake.write`` captures them, of nested data made of the
orders, and of bulk-loaded catalog rows. Each part stands for such a row: its name gives two fields, its
size their types, its brand the path."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.lake import Lake
from statlake.operators import schemas
from statlake.plans.registry import query
from statlake.plans.workspace import fresh_lake, table
from statlake.sources.tables import append_frame

_TYPES = ("bigint", "string", "double", "int", "boolean", "date", "float", "timestamp")
_AVRO = (
    '"long"',
    '"string"',
    '"double"',
    '"int"',
    '"boolean"',
    '{"type":"int","logicalType":"date"}',
    '"float"',
    '{"type":"long","logicalType":"timestamp-micros"}',
)
_TABLES = ("region", "nation", "supplier", "customer", "part", "events", "conversations")
_VERSION = 1000
# Two versions of the orders as nested data.
_NESTED = {
    1: (
        "o_orderkey",
        "named_struct('status', o_orderstatus, 'price', o_totalprice) AS head",
        "array(named_struct('day', o_orderdate, 'by', o_custkey)) AS days",
    ),
    2000: (
        "o_orderkey",
        "named_struct('status', o_orderstatus, 'price', cast(o_totalprice AS float), 'rank', o_orderpriority) AS head",
        "array(named_struct('day', cast(o_orderdate AS date), 'by', o_custkey)) AS days",
    ),
}
_lakes: dict[tuple[str, str], Lake] = {}


def _bulk(spark, sf_dir):
    types, avro = (F.array(*[F.lit(t) for t in side]) for side in (_TYPES, _AVRO))
    words = F.split("p_name", " ")

    def entry(word, shift, nullable):
        at = ((F.col("p_size") + shift) % len(_TYPES)).cast("int")
        text = F.get(avro, at)
        return F.struct(
            F.get(words, F.lit(word)).alias("name"),
            F.get(types, at).alias("spark_type"),
            nullable.alias("nullable"),
            F.when(nullable, F.concat(F.lit("["), text, F.lit(',"null"]'))).otherwise(text).alias("avro_type"),
        )

    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("/parts/"), F.replace("p_brand", F.lit("#"), F.lit("-"))).alias("path"),
        (F.col("p_partkey") + 1).alias("version"),
        F.array(entry(0, 0, F.lit(True)), entry(1, 3, F.col("p_size") % 2 == 0)).alias("fields"),
    )


def _catalog(spark, sf_dir):
    """The catalog of the lake into which all of these are written, once for a session's queries."""
    session = (spark.sparkContext.applicationId, sf_dir)
    if session not in _lakes:
        lake = fresh_lake(spark)
        governed = {"valuation": "INTERNAL", "state": "INPUT"}
        for name in _TABLES:
            lake.write(table(spark, sf_dir, name), f"/tables/{name}", version=_VERSION, **governed)
        for version, columns in _NESTED.items():
            rows = table(spark, sf_dir, "orders").selectExpr(*columns)
            lake.write(rows, "/nested/orders", version=version, **governed)
        append_frame(_bulk(spark, sf_dir), lake.root, "catalog")
        lake.compact()
        _lakes[session] = lake
    return _lakes[session].catalog()


def _sql_list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_BULK = f"""
  SELECT '/parts/' || replace(p_brand, '#', '-') AS path, p_partkey + 1 AS version,
         CAST(0 AS INT) AS position, split_part(p_name, ' ', 1) AS name,
         {_sql_list(_TYPES)}[p_size % 8 + 1] AS spark_type, true AS nullable,
         '[' || {_sql_list(_AVRO)}[p_size % 8 + 1] || ',"null"]' AS avro FROM part
  UNION ALL
  SELECT '/parts/' || replace(p_brand, '#', '-'), p_partkey + 1, CAST(1 AS INT), split_part(p_name, ' ', 2),
         {_sql_list(_TYPES)}[(p_size + 3) % 8 + 1], p_size % 2 = 0,
         CASE WHEN p_size % 2 = 0 THEN '[' || {_sql_list(_AVRO)}[(p_size + 3) % 8 + 1] || ',"null"]'
              ELSE {_sql_list(_AVRO)}[(p_size + 3) % 8 + 1] END FROM part"""

# Types of the given tables as the SQL engine, Spark and Avro name them.
_KINDS = {
    "BIGINT": ("bigint", '"long"'),
    "INTEGER": ("int", '"int"'),
    "VARCHAR": ("string", '"string"'),
    "DOUBLE": ("double", '"double"'),
    "DATE": ("date", '{"type":"int","logicalType":"date"}'),
    "TIMESTAMP": ("timestamp_ntz", '{"type":"long","logicalType":"local-timestamp-micros"}'),
}


def _case(which):
    return "CASE column_type " + " ".join(f"WHEN '{k}' THEN '{v[which]}'" for k, v in _KINDS.items()) + " END"


_WRITTEN = " UNION ALL ".join(
    f"""SELECT '/tables/{name}' AS path, CAST({_VERSION} AS BIGINT) AS version, CAST(row_number() OVER () - 1 AS INT) AS position,
               column_name AS name, {_case(0)} AS spark_type, true AS nullable, '[' || {_case(1)} || ',"null"]' AS avro
        FROM (DESCRIBE SELECT * FROM {name})"""
    for name in _TABLES
)


def _values(rows):
    lines = ", ".join(f"('/nested/orders', CAST({v} AS BIGINT), CAST({p} AS INT), '{n}', '{t}', {e}, '{a}')" for v, p, n, t, e, a in rows)
    return f"SELECT * FROM (VALUES {lines}) AS v(path, version, position, name, spark_type, nullable, avro)"


_STAMP = _KINDS["TIMESTAMP"][1]
_HEADS = {
    1: ("struct<status:string,price:double>", '{"name":"price","type":["double","null"]}'),
    2000: ("struct<status:string,price:float,rank:string>", '{"name":"price","type":["float","null"]},{"name":"rank","type":["string","null"]}'),
}
_DAYS = {1: ("timestamp_ntz", f"[{_STAMP},\"null\"]"), 2000: ("date", '[{"type":"int","logicalType":"date"},"null"]')}


def _columns(v):
    """The columns of a nested version as rows."""
    head = '{"type":"record","name":"head","fields":[{"name":"status","type":["string","null"]},' + _HEADS[v][1] + "]}"
    day = '{"name":"day","type":' + _DAYS[v][1] + '},{"name":"by","type":["long","null"]}'
    days = '{"type":"array","items":{"type":"record","name":"days","fields":[' + day + "]}}"
    return [
        (v, 0, "o_orderkey", "bigint", "true", '["long","null"]'),
        (v, 1, "head", _HEADS[v][0], "false", head),
        (v, 2, "days", f"array<struct<day:{_DAYS[v][0]},by:bigint>>", "false", days),
    ]


def _all_fields(v):
    """All fields of a nested version as rows."""
    inner = [("head.status", "string"), ("head.price", "double" if v == 1 else "float"), *([] if v == 1 else [("head.rank", "string")])]
    rows = [("o_orderkey", "bigint", "true"), ("head", "struct", "false"), *((n, t, "true") for n, t in inner)]
    rows += [("days", "array", "false"), ("days.element", "struct", "false"), ("days.element.day", _DAYS[v][0], "true"), ("days.element.by", "bigint", "true")]
    return [(v, p, n, t, e, "") for p, (n, t, e) in enumerate(rows)]


_TOP = f"{_BULK} UNION ALL {_WRITTEN} UNION ALL {_values([*_columns(1), *_columns(2000)])}"
_DEEP = f"{_BULK} UNION ALL {_WRITTEN} UNION ALL {_values([*_all_fields(1), *_all_fields(2000)])}"


@query("schema_rows", f"SELECT path, version, position, name, spark_type, nullable FROM ({_DEEP})")
def schema_rows(spark, sf_dir):
    return schemas.schema_rows(_catalog(spark, sf_dir), nested=True)


@query(
    "schema_avro",
    f"""SELECT path, version, '{{"type":"record","name":"row","namespace":"parts","fields":[' ||
               string_agg('{{"name":"' || name || '","type":' || avro || '}}', ',' ORDER BY position) || ']}}'
               AS avro FROM ({_TOP}) GROUP BY path, version""",
)
def schema_avro(spark, sf_dir):
    return schemas.avro_records(_catalog(spark, sf_dir), "row", "parts")


@query(
    "schema_diff",
    f"""WITH fields AS ({_DEEP}),
        old AS (SELECT path, name, spark_type, nullable FROM fields JOIN
                  (SELECT path, max(version) AS version FROM fields WHERE version <= 100 GROUP BY path)
                  USING (path, version)),
        new AS (SELECT path, name, spark_type, nullable FROM fields JOIN
                  (SELECT path, max(version) AS version FROM fields GROUP BY path) USING (path, version))
        SELECT path, name,
               CASE WHEN old.spark_type IS NULL THEN 'added' WHEN new.spark_type IS NULL THEN 'removed'
                    ELSE 'changed' END AS change,
               old.spark_type AS old_type, new.spark_type AS new_type
        FROM old FULL OUTER JOIN new USING (path, name)
        WHERE old.spark_type IS DISTINCT FROM new.spark_type OR old.nullable IS DISTINCT FROM new.nullable""",
)
def schema_diff(spark, sf_dir):
    return schemas.schema_diff(_catalog(spark, sf_dir), before=100, nested=True)


@query(
    "doc_template",
    f"""SELECT path, version, '{{"dataset":"' || path || '","fields":[' ||
               string_agg('{{"name":"' || name || '","type":"' || spark_type || '","nullable":' ||
                          CASE WHEN nullable THEN 'true' ELSE 'false' END || ',"description":""}}', ','
                          ORDER BY position) || ']}}' AS template
        FROM ({_TOP}) GROUP BY path, version""",
)
def doc_template(spark, sf_dir):
    return schemas.doc_templates(_catalog(spark, sf_dir))
