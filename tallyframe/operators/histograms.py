"""Equal-width histogram, the table behind a histogram chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import as_column, finite


def histogram_feed(df: DataFrame, col: str | Column, bins: int) -> DataFrame:
    """``bin, lo, hi, n``: exactly ``bins`` rows, numbered from 1, in no fixed order.

    Bins are closed below and open above; the last one is closed on both sides.
    A constant column is all in bin 1. Null, NaN and infinite values are left
    out; with no values left the edges are null and all counts 0.

    The column is read twice, once for its range and once to count, and nothing
    else is. The range is a scalar subquery. Empty bins come from a zero row per
    bin, added before the counts are summed, so the counts need no join.
    """
    if isinstance(bins, bool) or not isinstance(bins, int) or bins < 1:
        raise ValueError("bins must be a positive integer")
    values = df.select(as_column(col).cast("double").alias("x")).where(finite("x"))

    # Halving keeps the width of a range finite that spans most of the doubles.
    lo, hi = F.min("x"), F.max("x")
    scale = F.when(hi - lo < F.lit(float("inf")), F.lit(1.0)).otherwise(F.lit(0.5))
    extent = values.agg(
        F.struct((lo * scale).alias("lo"), (hi * scale).alias("hi"), scale.alias("scale"))
    )

    def with_extent(frame: DataFrame) -> DataFrame:
        return frame.withColumn("extent", extent.scalar())

    width = F.col("extent.hi") - F.col("extent.lo")
    position = F.coalesce(
        F.try_divide(F.col("x") * F.col("extent.scale") - F.col("extent.lo"), width), F.lit(0.0)
    )
    number = F.least(F.floor(position * F.lit(bins)).cast("bigint") + 1, F.lit(bins))
    counted = with_extent(values).select(number.cast("bigint").alias("bin"), F.lit(1).alias("n"))
    numbers = df.sparkSession.range(1, bins + 1, numPartitions=1)
    empty = numbers.select(F.col("id").alias("bin"), F.lit(0).alias("n"))
    totals = counted.unionByName(empty).groupBy("bin").agg(F.sum("n").alias("n"))

    def edge(steps: Column) -> Column:
        return (F.col("extent.lo") + width * (steps / F.lit(float(bins)))) / F.col("extent.scale")

    last = F.col("extent.hi") / F.col("extent.scale")
    return with_extent(totals).select(
        "bin",
        edge(F.col("bin") - 1).alias("lo"),
        F.when(F.col("bin") == bins, last).otherwise(edge(F.col("bin"))).alias("hi"),
        "n",
    )
