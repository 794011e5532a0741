"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}
FOLDERS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.fixture(scope="module", params=FOLDERS, ids=["sf0.001", "sf0.01"])
def folder(request):
    return request.param


def run_sql(folder, statement):
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
            )
        result = connection.execute(statement)
        names = [column[0] for column in result.description]
        types = [str(column[1]) for column in result.description]
        return names, types, result.fetchall()


def in_order(names, rows):
    positions = [names.index(name) for name in sorted(names)]
    keyed = [tuple(row[p] for p in positions) for row in rows]
    return sorted(keyed, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, folder, name):
    frame = entry_module.queries()[name](spark, folder)
    names, types, expected = run_sql(folder, entry_module.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(names)
    spark_types = {column: SPARK_TO_DUCKDB[kind] for column, kind in frame.dtypes}
    assert spark_types == dict(zip(names, types, strict=True))
    actual = [tuple(row) for row in frame.collect()]
    assert expected
    assert not any(isinstance(v, float) and math.isnan(v) for row in expected for v in row)
    assert in_order(frame.columns, actual) == in_order(names, expected)


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 25
    assert sum(row["n"] == 0 and row["value"] is None for row in rows) == 15
