"""Schemas as data: rows, Avro records, differences and documentation templates.

The schema of a version is an array inside its catalog row, so everything here is a projection of
the catalog, except the difference, which needs one aggregation by path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fields(catalog: DataFrame, nested: bool) -> Column:
    """The columns of each version, or all nested fields; bulk-loaded rows may know only the former."""
    if nested and "nested" in catalog.columns:
        return F.coalesce("nested", "fields")
    return F.col("fields")


def schema_rows(catalog: DataFrame, nested: bool = False) -> DataFrame:
    """One row for each column of each dataset version, or with ``nested`` for each field at any depth
    under its dotted name."""
    return catalog.select(
        "path", "version", F.posexplode(_fields(catalog, nested)).alias("position", "field")
    ).select("path", "version", "position", "field.name", "field.spark_type", "field.nullable")


def _json_string(text: Column) -> Column:
    """A JSON string literal: an object with one key, cut down to its value."""
    whole = F.to_json(F.struct(text.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def avro_records(catalog: DataFrame, record_name: str = "spark_schema", namespace: str = "") -> DataFrame:
    """The Avro record of each dataset version as compact JSON text; null for a version with a column
    that Avro has no type for, so that no record stands for less than its dataset."""
    head = '{"type":"record","name":"' + record_name + '",'
    if namespace:
        head += '"namespace":"' + namespace + '",'
    entries = F.transform(
        "fields",
        lambda f: F.concat(
            F.lit('{"name":'), _json_string(f["name"]), F.lit(',"type":'), f["avro_type"], F.lit("}")
        ),
    )
    record = F.concat(F.lit(head + '"fields":['), F.array_join(entries, ","), F.lit("]}"))
    record = F.when(~F.exists("fields", lambda f: f["avro_type"].isNull()), record)
    return catalog.select("path", "version", record.alias("avro"))


def schema_diff(catalog: DataFrame, before: int, after: int = 0, nested: bool = False) -> DataFrame:
    """How each path's schema changed between two snapshots (0 = latest): one row for each column
    that was added, removed or changed, or with ``nested`` for each field at any depth.

    Both snapshots come from one aggregation whose partial results are one row for each path and
    task, so a path with very many versions is no bottleneck.
    """

    def newest(snapshot: int) -> Column:
        visible = F.lit(True) if snapshot == 0 else F.col("version") <= snapshot
        return F.max_by(_fields(catalog, nested), F.when(visible, F.col("version")))

    pairs = catalog.groupBy("path").agg(newest(before).alias("old"), newest(after).alias("new"))

    def lookup(fields: Column, name: Column) -> Column:
        return F.try_element_at(F.filter(fields, lambda f: f["name"] == name), F.lit(1))

    def names(fields: str) -> Column:
        return F.coalesce(F.transform(fields, lambda f: f["name"]), F.array().cast("array<string>"))

    fields = pairs.select(
        "path", "old", "new", F.explode(F.array_union(names("old"), names("new"))).alias("name")
    ).select(
        "path",
        "name",
        lookup(F.col("old"), F.col("name")).alias("old"),
        lookup(F.col("new"), F.col("name")).alias("new"),
    )
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(
            (F.col("old.spark_type") != F.col("new.spark_type"))
            | (F.col("old.nullable") != F.col("new.nullable")),
            "changed",
        )
    )
    return fields.select(
        "path",
        "name",
        change.alias("change"),
        F.col("old.spark_type").alias("old_type"),
        F.col("new.spark_type").alias("new_type"),
    ).filter(F.col("change").isNotNull())


def doc_templates(catalog: DataFrame, simple: bool = False) -> DataFrame:
    """A documentation template for each dataset version, to be filled in and passed back as its
    schema documentation. The simple form holds names and empty descriptions only."""

    def entry(f: Column) -> Column:
        if simple:
            return F.struct(f["name"].alias("name"), F.lit("").alias("description"))
        return F.struct(
            f["name"].alias("name"),
            f["spark_type"].alias("type"),
            f["nullable"].alias("nullable"),
            F.lit("").alias("description"),
        )

    template = F.to_json(
        F.struct(F.col("path").alias("dataset"), F.transform("fields", entry).alias("fields"))
    )
    return catalog.select("path", "version", template.alias("template"))
