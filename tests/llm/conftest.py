import pytest

KIND = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A small documents table from (doc_id, text) or (doc_id, text, source) rows, with more columns."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
        frame = spark.createDataFrame(full, KIND)
        # columns whose names the operators use themselves
        return frame.selectExpr("*", "'x' AS size", "1.5 AS score", "'y' AS shard", "'z' AS doc", "0 AS block", "'q' AS copies")

    return make


#: Null, empty, blank and very long texts, ties, repeated rows and null ids.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\r\x0b\x0c "),
    (4, "one"),
    (5, "ONE two  three"),
    (5, "ONE two  three"),
    (6, "one two three"),
    (7, "long " * 60_000 + "tail"),
    (8, "one two three", None),
    (None, "one two three"),
    (-9, "<|endoftext|> é日本 😀 　 end"),
]
