"""Tables of a relational database, through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Rows per round trip, unless ``properties`` say otherwise.
FETCH_ROWS = "10000"
BATCH_ROWS = "10000"

# Connections of a write, unless told otherwise.
WRITE_CONNECTIONS = 16

SAVE_MODES = ("append", "overwrite", "errorifexists", "ignore")


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    key: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int | None = None,
) -> DataFrame:
    """Read ``table``, or a subquery in parentheses with an alias.

    With ``key``, a number, date or timestamp column, and ``partitions``, the table
    is read over that many connections, each a range of the key. The bounds only
    set the width of the ranges: every row is read, rows outside in the first or
    last range and rows with a null key in the first. Without bounds the database
    is asked for the least and greatest key. Choose a key with spread-out values,
    best a unique one: a value that many rows share cannot be split.

    Spark pushes filters and the choice of columns to the database, but no
    aggregation; pass a subquery as ``table`` if the database should aggregate.
    """
    options = {"fetchsize": FETCH_ROWS, **properties, "url": url, "dbtable": table}
    if (key is None) != (partitions is None):
        raise ValueError("key and partitions go together")
    if (lower is None) != (upper is None):
        raise ValueError("lower and upper go together")
    if key is None:
        if lower is not None:
            raise ValueError("bounds need a key")
    else:
        if partitions < 1:
            raise ValueError("partitions must be positive")
        if lower is None:
            lower, upper = jdbc_bounds(spark, url, table, properties, key)
        if lower is not None:
            options |= {
                "partitionColumn": key,
                "lowerBound": str(lower),
                "upperBound": str(upper),
                "numPartitions": str(partitions),
            }
    return spark.read.format("jdbc").options(**options).load()


def jdbc_bounds(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], key: str
) -> tuple[Any, Any]:
    """Least and greatest ``key`` as the database sees them; nulls if it has none.

    ``key`` goes into the statement as it is: a name in mixed case, or one that the
    database reserves, has to be quoted by the caller in the way of the database.
    """
    statement = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) bounds"
    options = {**properties, "url": url, "dbtable": statement}
    return tuple(spark.read.format("jdbc").options(**options).load().first())


def jdbc_write(
    df: DataFrame,
    url: str,
    table: str,
    mode: str,
    properties: Mapping[str, str],
    connections: int = WRITE_CONNECTIONS,
) -> None:
    """Write ``df`` to ``table``, one transaction per partition.

    ``overwrite`` drops and recreates the table; with ``truncate`` = ``true`` in
    ``properties`` it keeps its definition. The rows are dealt to ``connections``
    partitions, each written over a connection of its own, 16 unless told otherwise:
    a shuffle of their own, so the steps before it keep all their tasks.

    A partition whose task is lost after its commit is written again. So write to
    a staging table with a unique key, which refuses the second copy, or compare
    the number of rows, and swap the tables afterwards. Speculative execution
    commits copies on purpose and is refused.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}, not {mode!r}")
    if connections < 1:
        raise ValueError("connections must be positive")
    if df.sparkSession.conf.get("spark.speculation", "false").lower() == "true":
        raise ValueError("turn spark.speculation off: it would write rows twice")
    options = {"batchsize": BATCH_ROWS, **properties, "url": url, "dbtable": table}
    df.repartition(connections).write.format("jdbc").options(**options).mode(mode).save()
