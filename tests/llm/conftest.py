from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """The documents of the smallest tables as a list of ids and texts."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return sorted(map(tuple, rows.collect()))


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, an empty and a very long text, repeated rows, odd names."""
    long = "A long sentence about nothing much. " * 20_000
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. It was here. So it was, twice.", "a", "x"),
        (1, "The quick brown fox jumps over the lazy dog. It was here. So it was, twice.", "a", "x"),
        (2, None, "a", None),
        (3, "", None, "x"),
        (None, "no id at all", "b", "x"),
        (4, long, "b", "x"),
        (5, " \n\t ", "b", "x"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, score string")
    return frame.selectExpr("*", "1 AS row", "'s' AS spans", "2 AS fingerprint", "'w' AS words", "0 AS shard", "3 AS id")


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.where("doc_id > 99")
