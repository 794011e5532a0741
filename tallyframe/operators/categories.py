"""Counts per category, the table behind a bar or pie chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import as_column


def category_counts(df: DataFrame, col: str | Column, k: int | None = None) -> DataFrame:
    """``category, n, share``, largest first; the ``k`` largest if ``k`` is given.

    A null category is a row of its own. Ties are ordered by category, nulls
    last. ``share`` is the part of all rows, also of those outside the top ``k``.

    The total is a scalar subquery over the counts: Spark reuses their shuffle,
    so the data is read once, and no join is needed.
    """
    if k is not None and (isinstance(k, bool) or not isinstance(k, int) or k < 1):
        raise ValueError("k must be a positive integer")
    counts = df.groupBy(as_column(col).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    ranked = counts.select(
        F.col("value").cast("string").alias("category"),
        "n",
        F.try_divide(F.col("n").cast("double"), total.scalar()).alias("share"),
    ).orderBy(F.desc("n"), F.asc_nulls_last("category"))
    return ranked if k is None else ranked.limit(k)
