"""Logical paths: validity as column predicates, URIs, and ancestor prefixes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.errors import InvalidPath

# Letters of any script, digits and - _ / . @ after a leading slash;
# the read form may end in one asterisk.
READ_PATH = r"^/[\p{L}\d_/.@-]+\*?$"
WRITE_PATH = r"^/[\p{L}\d_/.@-]+$"


def is_valid_read_path(path: Column) -> Column:
    return path.rlike(READ_PATH) & ~path.endswith("\n")


def is_valid_write_path(path: Column) -> Column:
    return path.rlike(WRITE_PATH) & ~path.endswith("\n")


def _allowed(char: str) -> bool:
    return char.isalpha() or (char.isascii() and char.isdigit()) or char in "-_/.@"


def check_path(path: str, reading: bool) -> str:
    """Driver-side guard for one path; returns it with single slashes and none at its end.

    ``.`` and ``..`` segments pass the character rule but would leave the lake root, so they are
    refused here.
    """
    body = path[:-1] if reading and path.endswith("*") else path
    if not body.startswith("/") or len(body) < 2 or not all(map(_allowed, body)):
        raise InvalidPath(
            f"path '{path}' is not valid: it begins with '/' and has letters, digits and - _ / . @ only"
        )
    if re.search(r"(^|/)\.{1,2}(/|$)", body):
        raise InvalidPath(f"path '{path}' is not valid: '.' and '..' segments are refused")
    path = re.sub("/+", "/", path)
    if path.endswith("*"):
        return path
    trimmed = path.rstrip("/")
    if not trimmed:
        raise InvalidPath(f"path '{path}' is not valid: it names no dataset")
    return trimmed


def ancestors(path: Column) -> Column:
    """Every prefix of a path that ends at a segment border, the path itself included:
    ``/a/b`` gives ``["", "/a", "/a/b"]`` (the empty prefix covers everything)."""
    segments = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(segments)),
        lambda n: F.array_join(F.slice(segments, F.lit(1), n), "/"),
    )


def ancestors_of(path: str) -> list[str]:
    parts = path.split("/")
    return ["/".join(parts[:n]) for n in range(1, len(parts) + 1)]


def with_lineage(df: DataFrame, parent_uri: str) -> DataFrame:
    """Add the logical path and the version of the file each row was read from.

    ``parent_uri`` is the lake's: what follows it in a file's URI is path, version and file name.
    """
    # percent-encoded, not form-encoded: a plus sign is a plus sign
    file_path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    parent = re.sub("/+", "/", re.sub(r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "", parent_uri))
    pattern = rf"^([a-zA-Z][\w+.-]*:)?(//[^/]*)?/*\Q{parent.strip('/')}\E(/.+)/(\d+)(?:/\d+-[0-9a-f]+)?/[^/]+$"
    return df.withColumns(
        {
            "path": F.regexp_extract(file_path, pattern, 3),
            "version": F.nullif(F.regexp_extract(file_path, pattern, 4), F.lit("")).cast("bigint"),
        }
    )
