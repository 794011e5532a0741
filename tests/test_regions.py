from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe import region_value_feed
from tests.helpers import plan_of

DIM = "key int, name string"
FACT = "region int, amount double"


def feed(spark, facts, dims, fact_schema=FACT):
    return region_value_feed(
        spark.createDataFrame(facts, fact_schema),
        spark.createDataFrame(dims, DIM),
        "region",
        "key",
        "name",
        "amount",
    )


def test_null_unknown_and_empty_regions(spark):
    facts = [(1, 5.0), (None, 7.0), (99, 9.0), (2, None)]
    result = feed(spark, facts, [(1, "a"), (2, "b"), (3, "c")])
    rows = {tuple(row) for row in result.collect()}
    assert rows == {("a", 1, 5.0), ("b", 1, None), ("c", 0, None)}
    dropped = len(facts) - result.agg(F.sum("n")).first()[0]
    assert dropped == 2
    assert result.dtypes == [("name", "string"), ("n", "bigint"), ("value", "double")]


def test_measures_that_are_no_numbers_pass_through(spark):
    facts = [(1, float("inf")), (1, 2.0), (2, float("nan"))]
    rows = {r["name"]: r["value"] for r in feed(spark, facts, [(1, "a"), (2, "b")]).collect()}
    assert rows["a"] == float("inf") and rows["b"] != rows["b"]


def test_no_facts(spark):
    assert [tuple(r) for r in feed(spark, [], [(1, "a")]).collect()] == [("a", 0, None)]


def test_integer_measure_and_expressions(spark):
    result = region_value_feed(
        spark.createDataFrame([(1, 5), (1, 6)], "region int, amount int"),
        spark.createDataFrame([(10, "a")], DIM),
        F.col("region") * 10,
        "key",
        F.upper("name"),
        F.col("amount") * 2,
    )
    assert [tuple(r) for r in result.collect()] == [("A", 2, 22.0)]


def test_same_table_on_both_sides(spark):
    people = spark.createDataFrame([(1, "a", None), (2, "b", 1)], "key int, name string, boss int")
    result = region_value_feed(people, people, "boss", "key", "name", "key")
    assert {tuple(r) for r in result.collect()} == {("a", 1, 2.0), ("b", 0, None)}


def test_facts_are_summed_before_they_are_shuffled(spark):
    facts = spark.range(100_000).selectExpr(
        "CAST(if(id % 3 = 0, 1, id % 50) AS int) AS region", "1D AS amount"
    )
    dims = spark.range(50).selectExpr("CAST(id AS int) AS key", "CAST(id AS string) AS name")
    result = region_value_feed(facts, dims, "region", "key", "name", "amount")
    plan = plan_of(result)
    assert "partial_sum" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    expected = {
        str(r[0]): r[1] for r in facts.groupBy("region").count().collect()
    }
    assert {r["name"]: r["n"] for r in result.collect()} == expected
