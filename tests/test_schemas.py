import json

from pyspark.sql import types as T

from statlake.functions.avro import avro_text, nested_fields
from statlake.operators import schemas

PERSON = (
    "PERSON_ID STRING, INCOME BIGINT, GENDER STRING, MARITAL_STATUS STRING, MUNICIPALITY STRING, DATA_QUALITY STRING"
)


def test_person_record(lake, spark, governed):
    lake.write(spark.createDataFrame([], PERSON), "/person", version=1, **governed)
    text = schemas.avro_records(lake.catalog(), "spark_schema", "namespace").first()["avro"]
    names = ["PERSON_ID", "INCOME", "GENDER", "MARITAL_STATUS", "MUNICIPALITY", "DATA_QUALITY"]
    fields = [{"name": n, "type": ["long" if n == "INCOME" else "string", "null"]} for n in names]
    assert json.loads(text) == {
        "type": "record",
        "name": "spark_schema",
        "namespace": "namespace",
        "fields": fields,
    }


def test_avro_text_of_types_and_names(spark):
    def text(ddl, namespace=""):
        made = avro_text(spark, T.StructType.fromDDL(ddl), False, "row", namespace)
        return made and json.loads(made)

    assert [f["type"] for f in text("a TINYINT NOT NULL, b BIGINT, c ARRAY<INT>, d MAP<STRING, DATE>")["fields"]] == [
        "int",
        ["long", "null"],
        [{"type": "array", "items": ["int", "null"]}, "null"],
        [{"type": "map", "values": [{"type": "int", "logicalType": "date"}, "null"]}, "null"],
    ]
    assert text("a STRUCT<x: INT>", "ns")["namespace"] == "ns"
    assert text("a STRUCT<`a b`: INT>") is None  # Avro has no such name


def test_no_record_stands_for_less_than_its_dataset(lake, spark, governed):
    lake.write(spark.sql("SELECT 1 a, named_struct('b c', 2) s, 3 z"), "/odd", version=1, **governed)
    lake.write(spark.sql("SELECT 1 a, INTERVAL '3' DAY b, 'x' c"), "/days", version=1, **governed)
    records = {r["path"]: r["avro"] for r in schemas.avro_records(lake.catalog()).collect()}
    assert records["/odd"] is None
    assert [f["name"] for f in json.loads(records["/days"])["fields"]] == ["a", "b", "c"]


def test_nested_fields_have_dotted_names():
    schema = T.StructType.fromDDL(
        "id BIGINT NOT NULL, s STRUCT<x: INT, `a.b`: STRUCT<z: DATE>>, l ARRAY<STRUCT<q: STRING>>, m MAP<STRING, ARRAY<INT>>"
    )
    assert [(f["name"], f["spark_type"], f["nullable"]) for f in nested_fields(schema)] == [
        ("id", "bigint", False),
        ("s", "struct", True),
        ("s.x", "int", True),
        ("s.`a.b`", "struct", True),
        ("s.`a.b`.z", "date", True),
        ("l", "array", True),
        ("l.element", "struct", True),
        ("l.element.q", "string", True),
        ("m", "map", True),
        ("m.key", "string", False),
        ("m.value", "array", True),
        ("m.value.element", "int", True),
    ]


def test_diff_finds_a_changed_inner_field(lake, spark, governed):
    lake.write(spark.sql("SELECT 1 id, named_struct('x', 1, 'y', array(named_struct('k', 2))) s"), "/n", version=1, **governed)
    lake.write(spark.sql("SELECT 1 id, named_struct('x', 1, 'y', array(named_struct('k', 2L, 'new', 'v'))) s"), "/n", version=2, **governed)
    lake.compact()
    rows = schemas.schema_diff(lake.catalog(), 1, nested=True).collect()
    assert {(r["name"], r["change"], r["old_type"], r["new_type"]) for r in rows} == {
        ("s.y.element.k", "changed", "int", "bigint"),
        ("s.y.element.new", "added", None, "string"),
    }
    assert [r["name"] for r in schemas.schema_diff(lake.catalog(), 1).collect()] == ["s"]
    names = [r["name"] for r in schemas.schema_rows(lake.catalog(), nested=True).filter("version = 1").orderBy("position").collect()]
    assert names == ["id", "s", "s.x", "s.y", "s.y.element", "s.y.element.k"]


def test_rows_diff_and_templates(lake, spark, governed):
    lake.write(spark.createDataFrame([], "a INT, b STRING, c DOUBLE"), "/x", version=1, **governed)
    lake.write(spark.createDataFrame([], 'a BIGINT, b STRING, `d"q` DATE'), "/x", version=2, **governed)
    lake.write(spark.createDataFrame([], "z INT"), "/y", version=2, **governed)
    rows = schemas.schema_rows(lake.catalog()).filter("path = '/x' AND version = 2").orderBy("position")
    assert [(r["name"], r["spark_type"]) for r in rows.collect()] == [
        ("a", "bigint"),
        ("b", "string"),
        ('d"q', "date"),
    ]
    diff = {(r["path"], r["name"]): r["change"] for r in schemas.schema_diff(lake.catalog(), 1).collect()}
    assert diff == {
        ("/x", "a"): "changed",
        ("/x", "c"): "removed",
        ("/x", 'd"q'): "added",
        ("/y", "z"): "added",
    }
    assert all(json.loads(r["avro"]) for r in schemas.avro_records(lake.catalog()).collect())
    newest = lake.catalog().filter("path = '/x' AND version = 2")
    template = json.loads(schemas.doc_templates(newest, simple=True).first()["template"])
    assert template == {
        "dataset": "/x",
        "fields": [{"name": n, "description": ""} for n in ("a", "b", 'd"q')],
    }
    assert "type" in json.loads(schemas.doc_templates(newest).first()["template"])["fields"][0]
