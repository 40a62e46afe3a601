"""Documents that accompany dataset versions, kept as rows of one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def documents_of(entries: DataFrame, kind: str, *content: str) -> DataFrame:
    """One document for each (path, version) row, its JSON made of the content columns."""
    return entries.select(
        "path",
        "version",
        F.lit(kind).alias("kind"),
        F.to_json(F.struct(*content)).alias("json"),
    )


def parsed_documents(documents: DataFrame, kind: str, schema: str) -> DataFrame:
    """Documents of a kind with their JSON content as columns; malformed texts give nulls."""
    content = F.from_json(F.col("json"), schema, {"mode": "PERMISSIVE"})
    return (
        documents.filter(F.col("kind") == kind)
        .select("path", "version", content.alias("content"))
        .select("path", "version", "content.*")
    )


def meta_json(
    path: Column, version: Column, valuation: Column, state: Column, created_by: Column
) -> Column:
    """The metadata document; a missing author is left out."""
    return F.to_json(
        F.struct(
            F.struct(path.alias("path"), version.cast("string").alias("version")).alias("id"),
            valuation.alias("valuation"),
            state.alias("state"),
            created_by.alias("createdBy"),
        )
    )
