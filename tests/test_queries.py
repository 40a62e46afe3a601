"""Every registered query against its SQL on the smallest tables."""

import datetime as dt
import glob
import os

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_point
from statlake.plans import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [
        tuple(v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v for v in (row[i] for i in order))
        for row in rows
    ]
    return sorted(plain, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    made = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(made.columns) == sorted(columns)
    assert _sorted_rows(made.columns, made.collect()) == _sorted_rows(columns, result.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
