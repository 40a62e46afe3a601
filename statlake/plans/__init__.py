"""Queries over the test tables, one for each operator, with the SQL of the same result."""

from statlake.plans import scans, writes, schemas, pseudonyms  # noqa: I001 (the order of the registry)
from statlake.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "pseudonyms", "scans", "schemas", "writes"]
