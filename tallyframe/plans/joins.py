"""Join of a large table with one row, or a few, per group of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group table is broadcast up to this size. Chooses a plan and nothing else.
BROADCAST_BYTES = 64 * 1024 * 1024
# A row of a group table takes this much in a hash table, without its key.
ROW_BYTES = 160
# Beyond that size, groups with more than this fraction of all rows are hot.
# There are at most as many of them as the fraction says.
HOT_FRACTION = 1 / 10_000
# Hot groups with a key up to this long are broadcast: together they take 50 MB at
# most, even with the six rows per group that box summaries join.
HOT_KEY_BYTES = 512
# Hot groups with a longer key are shuffled in this many parts.
SALTS = 64


def _key_bytes(column: Column) -> Column:
    return F.coalesce(F.octet_length(column.cast("string")), F.lit(0))


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    sizes: DataFrame,
    match: Column | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Inner join on ``rows.by <=> groups.key`` and the condition ``match``.

    ``groups`` has a column ``key`` and some groups of ``rows``, not always all.
    ``sizes`` has the columns ``key`` and ``total``, the number of rows, for every
    group. Both have to be cheap to read more than once.

    The size of ``groups`` is measured first. Up to ``broadcast_bytes`` it is
    broadcast, and ``rows`` are not shuffled. Beyond, only groups with a small part
    of all rows are shuffled by their key. The few with a large part are joined by
    broadcast, whether they have a match or not, and if their key is too long for
    that, their rows are shuffled in 64 parts: which these are is broadcast as a
    hash of 8 bytes per key. The sizes choose a plan and nothing else; the result
    is the same.
    """
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    size = groups.agg(F.sum(_key_bytes(F.col("key")) + ROW_BYTES)).first()[0] or 0
    if size <= limit:
        return rows.join(F.broadcast(groups), _on(rows, groups, match))

    totals = sizes.groupBy("key").agg(F.max("total").alias("total"))
    all_rows = totals.agg(F.sum("total")).first()[0]
    hot = totals.where(F.col("total") > F.lit(all_rows * HOT_FRACTION))
    is_long = _key_bytes(F.col("key")) > HOT_KEY_BYTES
    hot_keys = hot.where(~is_long).select(F.col("key").alias("hot_key"))
    long_keys = hot.where(is_long).select(F.xxhash64("key").alias("hot_hash")).distinct()

    is_hot = F.broadcast(hot_keys), F.col("key").eqNullSafe(F.col("hot_key"))
    near, far = groups.join(*is_hot, "left_semi"), groups.join(*is_hot, "left_anti")
    near_joined = rows.join(F.broadcast(near), _on(rows, near, match))
    far_rows = rows.join(
        F.broadcast(hot_keys), F.col("by").eqNullSafe(F.col("hot_key")), "left_anti"
    )
    part = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    far_rows = _salted(far_rows, "by", long_keys, part)
    far = _salted(far, "key", long_keys, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    together = _on(far_rows, far, match) & (far_rows["salt_by"] == far["salt_key"])
    far_joined = far_rows.join(far, together).drop("salt_by", "salt_key")
    return near_joined.unionByName(far_joined)


def _salted(table: DataFrame, key: str, long_keys: DataFrame, salt: Column) -> DataFrame:
    """``table`` with ``salt`` for the rows of long hot keys, and 0 for all others."""
    marked = table.join(
        F.broadcast(long_keys), F.xxhash64(key) == F.col("hot_hash"), "left"
    ).withColumn("is_long", F.col("hot_hash").isNotNull()).drop("hot_hash")
    name = f"salt_{key}"
    return (
        marked.where("NOT is_long").withColumn(name, F.lit(0))
        .unionByName(marked.where("is_long").withColumn(name, salt))
        .drop("is_long")
    )


def _on(rows: DataFrame, groups: DataFrame, match: Column | None = None) -> Column:
    same_group = rows["by"].eqNullSafe(groups["key"])
    return same_group if match is None else same_group & match
