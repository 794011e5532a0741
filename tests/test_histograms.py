from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe import histogram_feed
from tests.helpers import plan_of


def histogram(spark, values, bins, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return sorted(tuple(r) for r in histogram_feed(df, "v", bins).collect())


def test_constant_column(spark):
    assert histogram(spark, [5.0, 5.0], 3) == [(1, 5.0, 5.0, 2), (2, 5.0, 5.0, 0), (3, 5.0, 5.0, 0)]


def test_no_values(spark):
    expected = [(1, None, None, 0), (2, None, None, 0), (3, None, None, 0)]
    assert histogram(spark, [], 3) == expected
    assert histogram(spark, [None, float("nan"), float("inf")], 3) == expected


def test_missing_values_are_left_out(spark):
    values = [0.0, 10.0, 5.0, float("nan"), float("inf"), float("-inf"), None]
    assert histogram(spark, values, 2) == [(1, 0.0, 5.0, 1), (2, 5.0, 10.0, 2)]


def test_integers(spark):
    assert histogram(spark, [0, 10, 4], 2, "int") == [(1, 0.0, 5.0, 2), (2, 5.0, 10.0, 1)]


def test_range_wider_than_a_double(spark):
    rows = histogram(spark, [-1.7e308, 0.0, 1.7e308], 4)
    assert [r[3] for r in rows] == [1, 0, 1, 1]
    assert [r[1] for r in rows] == pytest.approx([-1.7e308, -0.85e308, 0.0, 0.85e308], rel=1e-14)
    assert rows[-1][2] == 1.7e308


def test_denormal_range(spark):
    assert [r[3] for r in histogram(spark, [0.0, 5e-324], 2)] == [1, 1]


@pytest.mark.parametrize("bins", [0, -2, 2.0, True])
def test_bad_bins(spark, bins):
    with pytest.raises(ValueError):
        histogram_feed(spark.range(2), "id", bins)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(st.floats(allow_nan=True, allow_infinity=True), min_size=1, max_size=40),
    bins=st.integers(1, 30),
)
def test_every_finite_value_is_counted_once(spark, values, bins):
    rows = histogram(spark, values, bins)
    assert [r[0] for r in rows] == list(range(1, bins + 1))
    finite = [v for v in values if abs(v) < float("inf")]
    assert sum(r[3] for r in rows) == len(finite)
    if finite:
        assert rows[-1][2] == max(finite)
        assert rows[0][3] >= 1


def test_a_hot_value_is_summed_in_the_map_tasks(spark):
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 100).alias("v")
    )
    result = histogram_feed(df, "v", 10)
    plan = plan_of(result)
    assert "Join" not in plan and "partial_sum" in plan
    assert result.agg(F.sum("n")).first()[0] == 300_000
