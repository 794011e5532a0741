"""Ranges of a key by counts, asked of Spark tables in the statements a database would get."""

from __future__ import annotations

from decimal import Decimal

import pytest

from tallyframe import jdbc_scan_by_counts
from tallyframe.sources.ranges import Piece, literal, pieces, predicates


@pytest.fixture
def asked(spark):
    statements = []

    def ask(statement):
        statements.append(statement)
        return spark.sql(statement).collect()

    ask.statements = statements
    return ask


def sizes(spark, ask, keys, partitions, kind="bigint"):
    """Rows of each range; every row is in exactly one of them."""
    frame = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"k {kind}, place int").repartition(3)
    frame.createOrReplaceTempView("keyed")
    found = predicates("k", pieces(ask, "keyed", "k", partitions), partitions)
    parts = [[r["place"] for r in frame.where(p).collect()] for p in found]
    assert sorted(sum(parts, [])) == list(range(len(keys)))
    return [len(p) for p in parts]


UNEVEN = {
    "even": [*range(3000)],
    "two clusters": [*range(2000), *range(10**15, 10**15 + 1000)],
    "squares": [i * i for i in range(3000)],
    "powers": [int(1.01**i) * 7 - 9 for i in range(3000)],
    "all of 64 bits": [-(2**63), *range(-500, 500), *range(2**62, 2**62 + 1500), 2**63 - 1],
}


@pytest.mark.parametrize("name", UNEVEN)
def test_ranges_are_even_where_no_value_is_hot(spark, asked, name):
    keys = UNEVEN[name]
    counts = sizes(spark, asked, [*keys, None, None], 8)
    assert len(counts) == 8 and max(counts) <= 1.5 * len(keys) / 8 + 2
    assert len(asked.statements) <= 1 + 16 * 7


def test_other_kinds_of_numbers(spark, asked):
    floats = [1.5 ** (i / 40) - 3 for i in range(1500)]
    assert max(sizes(spark, asked, floats, 5, "double")) <= 450
    decimals = [Decimal(i * i).scaleb(-2) for i in range(900)]
    assert max(sizes(spark, asked, decimals, 6, "decimal(18,2)")) <= 225


def test_a_hot_value_is_one_range_and_the_rest_is_even(spark, asked):
    keys = [*range(1000), *[500] * 3000, *range(2000, 3000)]
    counts = sizes(spark, asked, keys, 10)
    assert sorted(counts)[-1] >= 3000 and sorted(counts)[-2] <= 1.5 * 500


def test_few_keys(spark, asked):
    spark.createDataFrame([(None,)], "k bigint").createOrReplaceTempView("keyed")
    assert pieces(asked, "keyed", "k", 4) == []
    assert predicates("k", [], 4) == [] == predicates("k", [Piece(3, 3, 100)], 4)
    with pytest.raises(ValueError):
        pieces(asked, "keyed", "k", 0)
    spark.createDataFrame([("a",)], "k string").createOrReplaceTempView("keyed")
    with pytest.raises(TypeError, match="str"):
        pieces(asked, "keyed", "k", 2)
    spark.createDataFrame([(float("inf"),)], "k double").createOrReplaceTempView("keyed")
    with pytest.raises(ValueError, match="finite"):
        pieces(asked, "keyed", "k", 2)


def test_literals():
    assert [literal(v) for v in (3, -3, 1.5, -2.0, 1e-7, Decimal("-0.50"))] == [
        "3", "(-3)", "1.5E0", "(-2.0E0)", "1e-07", "(-0.50)"
    ]


class Reader:
    """A session whose JDBC source is a view of Spark."""

    def __init__(self, spark, calls):
        self.spark, self.calls, self.read = spark, calls, self

    def format(self, kind):
        assert kind == "jdbc"
        return self

    def options(self, **options):
        self.table = options["dbtable"]
        return self

    def load(self):
        return self.spark.sql(f"SELECT * FROM {self.table}")

    def jdbc(self, url, table, predicates, properties):
        self.calls.append((url, table, predicates, properties))


def test_the_scan_hands_the_ranges_to_spark(spark):
    spark.createDataFrame([(i,) for i in range(100)], "k bigint").createOrReplaceTempView("keyed")
    calls = []
    jdbc_scan_by_counts(Reader(spark, calls), "jdbc:x", "keyed", {"user": "u"}, "k", 4)
    assert calls == [("jdbc:x", "keyed", [
        "k < 25 OR k IS NULL", "k >= 25 AND k < 50", "k >= 50 AND k < 75", "k >= 75"
    ], {"fetchsize": "10000", "user": "u"})]
    spark.createDataFrame([(None,)] * 3, "k bigint").createOrReplaceTempView("keyed")
    assert jdbc_scan_by_counts(Reader(spark, calls), "jdbc:x", "keyed", {}, "k", 4).count() == 3
