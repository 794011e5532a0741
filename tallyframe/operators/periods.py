"""Counts and sums per calendar period, the table behind a line chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tallyframe.functions import as_column, local_time, period_start, period_step


def period_series(
    df: DataFrame,
    ts: str | Column,
    period: str,
    measure: str | Column,
    zone: str | None = None,
) -> DataFrame:
    """``period, n, value`` without gaps between the first and the last period.

    ``period`` is day, week (from Monday), month, quarter or year, and the result
    column holds its first date. A period without rows has ``n`` = 0 and a null
    ``value``. Rows without a time are left out; no rows give no periods. NaN and
    infinite measures are summed as they are.

    A ``timestamp`` is an instant, and its period depends on where it is read: it needs
    a ``zone``, such as ``Asia/Tokyo``, and the zone of the session does not matter.
    Dates and ``timestamp_ntz`` have no zone and take none.

    The data is read and shuffled once, as one partial row per period and task.
    Gaps are filled from the grouped rows: each one looks ahead to the next
    period that has data and emits the empty ones before it. That window has no
    partition key, but sees at most one row per period of the calendar.
    """
    step = period_step(period)
    rows = df.select(as_column(ts).alias("ts"), as_column(measure).cast("double").alias("measure"))
    is_instant = isinstance(rows.schema["ts"].dataType, TimestampType)
    if is_instant != (zone is not None):
        raise ValueError("a timestamp column needs a zone, and no other column takes one")
    if is_instant:
        rows = rows.withColumn("ts", local_time("ts", zone))
    groups = (
        rows.where(F.col("ts").isNotNull())
        .groupBy(period_start(F.col("ts"), period).alias("start"))
        .agg(F.count("*").alias("n"), F.sum("measure").alias("value"))
    )
    following = F.lead("start").over(Window.orderBy("start"))
    last_day = F.coalesce(F.date_sub(following, 1), F.col("start"))
    filled = groups.withColumn("last_day", last_day).select(
        "start", "n", "value", F.explode(F.sequence("start", "last_day", step)).alias("period")
    )
    has_rows = F.col("period") == F.col("start")
    return filled.select(
        "period",
        F.when(has_rows, F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("n"),
        F.when(has_rows, F.col("value")).alias("value"),
    )
