"""Values per region, the table behind a map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import as_column


def region_value_feed(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str | Column,
    dim_key: str | Column,
    dim_name: str | Column,
    measure: str | Column,
) -> DataFrame:
    """``name, n, value``: one row per row of ``dim``, in no fixed order.

    ``n`` counts the fact rows of the region and ``value`` sums their measure. A
    region without fact rows has ``n`` = 0 and a null ``value``; a region whose
    measures are all null has its true ``n`` and a null ``value``. Fact rows with
    a null or unknown key belong to no region. NaN and infinite measures are summed
    as they are. ``dim_key`` must be unique.

    The facts are summed before the join, on the map side first. So a key that
    holds a third of all facts costs one row per task, and the join only sees
    one row per key, already partitioned on it.
    """
    totals = (
        fact.select(
            as_column(fact_key).alias("fact_key"),
            as_column(measure).cast("double").alias("measure"),
        )
        .where(F.col("fact_key").isNotNull())
        .groupBy("fact_key")
        .agg(F.count("*").alias("n"), F.sum("measure").alias("value"))
    )
    regions = dim.select(
        as_column(dim_key).alias("dim_key"),
        as_column(dim_name).cast("string").alias("name"),
    )
    return regions.join(totals, F.col("dim_key") == F.col("fact_key"), "left").select(
        "name",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        "value",
    )
