import pytest
from pyspark.sql import functions as F

from statlake.errors import InvalidPath
from statlake.functions.paths import (
    ancestors,
    ancestors_of,
    check_path,
    is_valid_read_path,
    is_valid_write_path,
)

VALID_READ = ["/harbour/ships_2031-a/", "/harbour/*", "/fjøla/кит/v1.2-3", "/mail/mate@ship", "/har*"]
INVALID_READ = ["", "/", "harbour/ships", "harbour/ships*", "/harbour/*/ships", "/har bour", "/a\n"]
VALID_WRITE = ["/harbour/ships_2031-a/", "/harbour"]
INVALID_WRITE = ["", "/", "harbour/ships", "/harbour/ships*", "/har bour", "/a\n"]


def _flags(spark, paths, predicate):
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    return {r["p"]: r["ok"] for r in rows.select("p", predicate(F.col("p")).alias("ok")).collect()}


def test_predicates(spark):
    assert set(_flags(spark, VALID_READ, is_valid_read_path).values()) == {True}
    assert set(_flags(spark, INVALID_READ, is_valid_read_path).values()) == {False}
    assert set(_flags(spark, VALID_WRITE, is_valid_write_path).values()) == {True}
    assert set(_flags(spark, INVALID_WRITE, is_valid_write_path).values()) == {False}


@pytest.mark.parametrize("path", VALID_READ)
def test_guard_accepts_read(path):
    assert check_path(path, reading=True) == (path if path.endswith("*") else path.rstrip("/"))


@pytest.mark.parametrize("path", INVALID_READ + ["/a/../b", "/./a", "//"])
def test_guard_refuses_read(path):
    with pytest.raises(InvalidPath):
        check_path(path, reading=True)


@pytest.mark.parametrize("path", VALID_WRITE)
def test_guard_accepts_write(path):
    assert check_path(path, reading=False) == path.rstrip("/")


@pytest.mark.parametrize("path", INVALID_WRITE)
def test_guard_refuses_write(path):
    with pytest.raises(InvalidPath):
        check_path(path, reading=False)


def test_ancestors(spark):
    row = spark.createDataFrame([("/a/b/c",)], "p string").select(ancestors(F.col("p")).alias("a")).first()
    assert row["a"] == ["", "/a", "/a/b", "/a/b/c"] == ancestors_of("/a/b/c")
