from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyframe import period_series
from tests.helpers import plan_of


def stamps(spark, *texts):
    rows = [(t, 1.0) for t in texts]
    return spark.createDataFrame(rows, "t string, v double").select(
        F.col("t").cast("timestamp_ntz").alias("t"), "v"
    )


def series(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_gaps_and_null_times(spark):
    df = stamps(spark, "2024-01-31 00:00:00", "2024-04-01 00:00:00", None)
    assert series(period_series(df, "t", "month", "v")) == [
        (date(2024, 1, 1), 1, 1.0),
        (date(2024, 2, 1), 0, None),
        (date(2024, 3, 1), 0, None),
        (date(2024, 4, 1), 1, 1.0),
    ]


@pytest.mark.parametrize(
    "period, expected",
    [
        ("day", 366 + 1),
        ("week", 53),
        ("month", 13),
        ("quarter", 5),
        ("year", 2),
    ],
)
def test_every_period_of_a_leap_year(spark, period, expected):
    df = stamps(spark, "2024-01-01 10:00:00", "2025-01-01 10:00:00")
    rows = series(period_series(df, "t", period, "v"))
    if period == "week":
        assert all(r[0].weekday() == 0 for r in rows)
        gaps = {(b[0] - a[0]).days for a, b in zip(rows, rows[1:])}
        assert gaps == {7}
    assert len(rows) == expected
    assert sum(r[1] for r in rows) == 2


def test_single_period_and_empty(spark):
    df = stamps(spark, "2024-05-05 01:00:00", "2024-05-05 23:59:59")
    assert series(period_series(df, "t", "day", "v")) == [(date(2024, 5, 5), 2, 2.0)]
    assert series(period_series(df.where("false"), "t", "day", "v")) == []


def test_null_measure_keeps_its_row(spark):
    df = stamps(spark, "2024-05-05 01:00:00").withColumn("v", F.lit(None).cast("double"))
    assert series(period_series(df, "t", "day", "v")) == [(date(2024, 5, 5), 1, None)]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "UTC"])
def test_session_zone_does_not_matter(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = stamps(spark, "2024-03-10 02:30:00")
        starts = {
            period: period_series(df, "t", period, "v").first()["period"]
            for period in ("day", "week", "month", "quarter", "year")
        }
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert starts == {
        "day": date(2024, 3, 10),
        "week": date(2024, 3, 4),
        "month": date(2024, 3, 1),
        "quarter": date(2024, 1, 1),
        "year": date(2024, 1, 1),
    }


@pytest.mark.parametrize("period", ["day", "week", "month", "quarter", "year"])
def test_every_row_with_a_time_is_counted_once(spark, period):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rows = series(period_series(df, "o_orderdate", period, "o_totalprice"))
    assert sum(r[1] for r in rows) == df.where("o_orderdate IS NOT NULL").count()
    assert len({r[0] for r in rows}) == len(rows)
    assert all((r[1] == 0) == (r[2] is None) for r in rows)


def test_measures_that_are_no_numbers_pass_through(spark):
    df = stamps(spark, "2024-05-05 01:00:00", "2024-05-06 01:00:00")
    measure = F.when(F.col("t") < "2024-05-06", float("inf")).otherwise(float("nan"))
    rows = series(period_series(df, "t", "day", measure))
    assert rows[0][2] == float("inf") and rows[1][2] != rows[1][2]


def test_a_gap_of_centuries(spark):
    df = stamps(spark, "1600-02-29 00:00:00", "2400-02-29 00:00:00")
    rows = period_series(df, "t", "day", "v")
    assert rows.count() == (date(2400, 2, 29) - date(1600, 2, 29)).days + 1
    assert rows.where("n > 0").count() == 2


def test_bad_period(spark):
    with pytest.raises(ValueError):
        period_series(stamps(spark, "2024-01-01 00:00:00"), "t", "hour", "v")


def test_one_scan_and_partial_sums(spark):
    result = period_series(
        spark.read.parquet("/root/testdata/sf0.001/orders.parquet"),
        "o_orderdate",
        "month",
        "o_totalprice",
    )
    plan = plan_of(result)
    assert plan.count("FileScan parquet") == 1
    assert "partial_sum" in plan and "Join" not in plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "IsNotNull(o_orderdate)" in plan


@pytest.mark.parametrize("session", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_instants_take_the_zone_they_are_given(spark, session):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        rows = [("2023-12-31 20:00:00 UTC", 1.0), ("2024-03-10 10:30:00 UTC", 2.0), (None, 3.0), ("1960-01-01 00:00:00 UTC", 4.0)]
        df = spark.createDataFrame(rows, "t string, v double").withColumn("t", F.col("t").cast("timestamp"))
        years = {
            zone: [r[0].year for r in series(period_series(df, "t", "year", "v", zone)) if r[1]]
            for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles")
        }
        with pytest.raises(ValueError, match="zone"):
            period_series(df, "t", "day", "v")
        with pytest.raises(ValueError, match="zone"):
            period_series(df.withColumn("t", F.col("t").cast("timestamp_ntz")), "t", "day", "v", "UTC")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert years == {
        "UTC": [1960, 2023, 2024],
        "Asia/Tokyo": [1960, 2024],
        "America/Los_Angeles": [1959, 2023, 2024],
    }
