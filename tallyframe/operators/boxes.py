"""Five-number summaries with outliers, the table behind a box plot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import as_column, finite, log_cell
from tallyframe.plans import durable, join_groups

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
# Whiskers reach this many interquartile ranges beyond the box.
WHISKER = 1.5

# A group with at most this many rows is sorted in one task. Chooses a plan and nothing
# else: results are the same to the last digit.
SORTED_ROWS = 20_000

# A bracket with at most this many rows is resolved by listing its values.
LISTED_ROWS = 1_000_000
# A larger one is cut into this many cells of equal width. Neither changes a result.
BRACKET_CELLS = 65_536

# Places of the quartiles among the ordered rows of a group, counted from 0, and
# the ranks of the two rows that each lies between.
PLACES = [f"((total - 1) * {p}D)" for p in QUARTILES.values()]
RANKS = [f"{side}({place})" for place in PLACES for side in ("floor", "ceil")]

CELL_AGGREGATES = ["count(*) AS n", "min(x) AS lo", "max(x) AS hi"]
CARRIED = [f"any_value({name}) AS {name}" for name in ("base", "total", "low", "high")]

# Keys of large groups are broadcast up to this many, and shuffled beyond.
BROADCAST_GROUPS = 10_000

# Approximate quartiles are off by at most this part of the rows of their group. The
# summaries are made ten times as fine, as they are merged many times.
RANK_ERROR = 1 / 1000
SUMMARY_ACCURACY = 10_000


def box_summary(
    df: DataFrame, col: str | Column, by: str | Column, approx: bool = False
) -> DataFrame:
    """``by, n, min, whisker_lo, q1, median, q3, whisker_hi, max, outliers``.

    Quartiles interpolate linearly between neighbouring values. The whiskers are
    the most extreme values within 1.5 interquartile ranges of the box, and
    ``outliers`` counts the values beyond. Null, NaN and infinite values are left
    out, and so is a group without any others. A null group is a group.

    With ``approx`` the quartiles are existing values from one pass, whose rank is off
    by at most 1/1000 of the rows of their group; all else is exact for them.

    Rows are counted per group and logarithmic cell of the value first. Groups of up to
    SORTED_ROWS rows are then shuffled once and summarised in one task each. The
    quartiles of larger groups are computed from their cells while the call runs, as the
    number of passes depends on the data; no task ever holds their values: see
    ``_exact_quartiles``.
    """
    rows = df.select(
        as_column(by).alias("by"), as_column(col).cast("double").alias("x")
    ).where(finite("x"))
    if approx:
        return _with_whiskers(rows, _approximate_quartiles(rows))
    celled = rows.selectExpr("by", "x", f"{log_cell('x')} AS cell")
    cells = durable(celled.groupBy("by", "cell").agg(*map(F.expr, CELL_AGGREGATES)))
    sizes = cells.groupBy(F.col("by").alias("key")).agg(F.sum("n").alias("total"))
    large = sizes.where(F.col("total") > SORTED_ROWS).select("key")
    groups, large_groups = sizes.agg(
        F.count("*"), F.count_if(F.col("total") > SORTED_ROWS)
    ).first()
    if not large_groups:
        return _sorted_boxes(rows)
    if large_groups == groups:
        return _with_whiskers(rows, _exact_quartiles(celled, cells))
    keys = durable(large)
    few = F.broadcast(keys) if large_groups <= BROADCAST_GROUPS else keys

    def among(table: DataFrame, how: str) -> DataFrame:
        return table.join(few, table["by"].eqNullSafe(keys["key"]), how)

    quartiles = _exact_quartiles(among(celled, "left_semi"), among(cells, "left_semi"))
    boxes = _with_whiskers(among(rows, "left_semi"), quartiles)
    return boxes.unionByName(_sorted_boxes(among(rows, "left_anti")))


def _sorted_boxes(rows: DataFrame) -> DataFrame:
    """Boxes of groups that fit into one task, by one exchange of their rows."""
    quartiles = [
        f"x[CAST(floor({place}) AS INT)] * (1 - ({place} - floor({place})))"
        f" + x[CAST(ceil({place}) AS INT)] * ({place} - floor({place})) AS {name}"
        for name, place in zip(QUARTILES, PLACES, strict=True)
    ]
    reach = f"{WHISKER}D * (q3 - q1)"
    return (
        rows.groupBy("by")
        .agg(F.count("*").alias("total"), F.sort_array(F.collect_list("x")).alias("x"))
        .selectExpr("*", *quartiles)
        .selectExpr("*", f"filter(x, v -> v BETWEEN q1 - {reach} AND q3 + {reach}) AS inside")
        .selectExpr(
            "by",
            "total AS n",
            "x[0] AS min",
            "inside[0] AS whisker_lo",
            *QUARTILES,
            "inside[size(inside) - 1] AS whisker_hi",
            "x[size(x) - 1] AS max",
            "CAST(size(x) - size(inside) AS BIGINT) AS outliers",
        )
    )


def _with_whiskers(rows: DataFrame, quartiles: DataFrame) -> DataFrame:
    """Whiskers and outliers of groups whose quartiles are known."""
    # Kept because it is read several times.
    boxes = durable(
        quartiles.selectExpr(
            "*",
            f"q1 - {WHISKER}D * (q3 - q1) AS fence_lo",
            f"q3 + {WHISKER}D * (q3 - q1) AS fence_hi",
        )
    )

    # Only groups that reach beyond a fence have to be looked through once more.
    calm = "low >= fence_lo AND high <= fence_hi"
    inside = "x BETWEEN fence_lo AND fence_hi"
    known = ["total", "low", "high", *QUARTILES]
    keyed = boxes.withColumnRenamed("by", "key")
    wide = join_groups(rows, keyed.where(f"NOT ({calm})"), keyed)
    searched = wide.groupBy("by").agg(
        *(F.any_value(name).alias(name) for name in known),
        F.expr(f"min(CASE WHEN {inside} THEN x END)").alias("whisker_lo"),
        F.expr(f"max(CASE WHEN {inside} THEN x END)").alias("whisker_hi"),
        F.expr(f"count_if(NOT ({inside}))").alias("outliers"),
    )
    settled = boxes.where(calm).selectExpr(
        "by", *known, "low AS whisker_lo", "high AS whisker_hi", "0L AS outliers"
    )
    return settled.unionByName(searched).selectExpr(
        "by",
        "total AS n",
        "low AS min",
        "whisker_lo",
        *QUARTILES,
        "whisker_hi",
        "high AS max",
        "outliers",
    )


def _exact_quartiles(celled: DataFrame, cells: DataFrame) -> DataFrame:
    """``by, total, low, high, q1, median, q3``, exactly and with bounded tasks.

    ``cells`` counts the rows of ``celled`` per group and logarithmic cell, a table of
    bounded size per group. Its running counts tell which cells hold the rows that the
    quartiles need: the brackets, six per group at most. Further passes look at
    the rows of the brackets alone. A bracket with few rows is resolved by
    counting its distinct values, a larger one is first cut into finer cells. As
    each cell keeps its least and greatest value, brackets shrink to what is
    really there, and one with a single value is resolved.
    """
    first = cells.selectExpr(
        "*",
        "sum(n) OVER (PARTITION BY by) AS total",
        "min(lo) OVER (PARTITION BY by) AS low",
        "max(hi) OVER (PARTITION BY by) AS high",
        "0L AS base",
    )
    brackets = durable(_narrow(first, "by"))
    while True:
        unresolved = brackets.where("lo < hi")
        largest = unresolved.agg(F.max("n")).first()[0]
        if largest is None:
            break
        wanted = unresolved.selectExpr(
            "by AS key", "cell AS in_cell", "lo AS from", "hi AS to", "before AS base",
            "total", "low", "high",
        )
        inside = F.expr("cell = in_cell AND x BETWEEN from AND to")
        listed = largest <= LISTED_ROWS
        part = "x" if listed else f"floor((x - from) / (to - from) * {BRACKET_CELLS})"
        finer = (
            join_groups(celled, wanted, brackets.withColumnRenamed("by", "key"), inside)
            .groupBy("by", "cell", "from", F.expr(part).alias("part"))
            .agg(*map(F.expr, CELL_AGGREGATES + CARRIED))
        )
        resolved = brackets.where("lo = hi")
        brackets = resolved.unionByName(_narrow(finer, "by, cell, from"))
        if listed:
            break
        brackets = durable(brackets)
    return _interpolate(brackets)


def _narrow(cells: DataFrame, within: str) -> DataFrame:
    """Keep the cells that hold a wanted rank, with the row count ``before`` them."""
    earlier = (
        f"sum(n) OVER (PARTITION BY {within} ORDER BY lo "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    return (
        cells.selectExpr("*", f"base + coalesce({earlier}, 0) AS before")
        .where(" OR ".join(map(_holds, RANKS)))
        .select("by", "cell", "n", "lo", "hi", "before", "total", "low", "high")
    )


def _holds(rank: str) -> str:
    return f"(before <= {rank} AND {rank} < before + n)"


def _interpolate(brackets: DataFrame) -> DataFrame:
    """Quartiles of each group from resolved brackets, which hold one value each."""
    at_rank = [f"max(CASE WHEN {_holds(rank)} THEN lo END) AS v{i}" for i, rank in enumerate(RANKS)]
    once = [f"any_value({name}) AS {name}" for name in ("total", "low", "high")]
    quartiles = []
    for i, (name, place) in enumerate(zip(QUARTILES, PLACES, strict=True)):
        weight = f"({place} - floor({place}))"
        quartiles.append(f"v{2 * i} * (1 - {weight}) + v{2 * i + 1} * {weight} AS {name}")
    return (
        brackets.groupBy("by")
        .agg(*map(F.expr, once + at_rank))
        .selectExpr("by", "total", "low", "high", *quartiles)
    )


def _approximate_quartiles(rows: DataFrame) -> DataFrame:
    """The same table from one pass of mergeable summaries of bounded size.

    A map task makes one summary per group, so a group gives one row per task.
    """
    found = rows.groupBy("by").agg(
        F.count("*").alias("total"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.percentile_approx("x", list(QUARTILES.values()), SUMMARY_ACCURACY).alias("found"),
    )
    quartiles = [F.col("found")[i].alias(name) for i, name in enumerate(QUARTILES)]
    return found.select("by", "total", "low", "high", *quartiles)
