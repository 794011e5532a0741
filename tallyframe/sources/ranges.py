"""Reads of a database table in ranges of a key that hold about as many rows each."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import Decimal
from math import isfinite
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sources.jdbc import FETCH_ROWS

# Cells of a histogram that the database is asked for at once.
CELLS = 1024
# A cell with more than this part of a range's share of rows is cut again.
COARSE = 0.5
# Rounds of cutting: each makes cells a thousandth as wide, so 64-bit keys need seven.
ROUNDS = 8

Number = int | float | Decimal
#: Runs a statement and returns its rows, of a bounded number.
Ask = Callable[[str], list]


class Piece(NamedTuple):
    """The rows with a key from ``low`` to ``high``, which both occur."""

    low: Number
    high: Number
    rows: int


def jdbc_scan_by_counts(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    key: str,
    partitions: int,
) -> DataFrame:
    """Read ``table`` over ``partitions`` connections, in ranges of about as many rows.

    Where ``jdbc_scan`` cuts the key into equal strides, this asks the database for
    counts first, so keys may lie as unevenly as they like. ``key`` is a number column,
    whole, decimal or floating, and goes into the statements as it is. No range has more
    than one and a half times its share of the rows, unless rows of one key value alone
    do: these cannot be split. Every row is in exactly one range, those without a key in
    the first, and also those that are written between the count and the read. A table
    without keys is read over one connection.
    """
    ask = ask_jdbc(spark, url, properties)
    found = predicates(key, pieces(ask, table, key, partitions), partitions)
    options = {"fetchsize": FETCH_ROWS, **properties}
    if not found:
        return spark.read.format("jdbc").options(**options, url=url, dbtable=table).load()
    return spark.read.jdbc(url, table, predicates=found, properties=options)


def pieces(ask: Ask, table: str, key: str, partitions: int) -> list[Piece]:
    """Counts of disjoint pieces of the key, ascending, that cover all of its values.

    The first statement counts CELLS cells of equal width. Each cell with more than half
    of a range's share is counted again in cells of its own, between its least and its
    greatest key, until it is small or a single value. At most twice ``partitions`` cells
    are that large at a time, so the driver holds CELLS rows for each of them at most.
    """
    if partitions < 1:
        raise ValueError("partitions must be positive")
    total, low, high = ask(
        f"SELECT COUNT({key}) AS n, MIN({key}) AS lo, MAX({key}) AS hi FROM {table}"
    )[0]
    if not total:
        return []
    if not isinstance(low, Number) or isinstance(low, bool):
        raise TypeError(f"the key has to be a number, not {type(low).__name__}")
    if not (isfinite(low) and isfinite(high)):
        raise ValueError("the key has values that are no finite numbers")
    most = COARSE * total / partitions
    found = [Piece(low, high, total)]
    for _ in range(ROUNDS):
        coarse = [p for p in found if p.rows > most and p.low < p.high]
        if not coarse:
            break
        found = [p for p in found if p.rows <= most or p.low == p.high]
        for piece in coarse:
            found += _cut(ask, table, key, piece)
    return sorted(found)


def _cut(ask: Ask, table: str, key: str, piece: Piece) -> list[Piece]:
    width = piece.high - piece.low
    if isinstance(piece.low, int):
        width = -(-(width + 1) // CELLS)
        # The difference of keys on either side of zero may be beyond 64 bits.
        wide = piece.high - piece.low >= 1 << 63
        cell = f"CASE WHEN {key} < 0 THEN 0 ELSE 1 END" if wide else None
    else:
        width, cell = piece.high / CELLS - piece.low / CELLS, None
        if not width:
            return [piece]
    cell = cell or f"FLOOR(({key} - {literal(piece.low)}) / {literal(width)})"
    rows = ask(
        f"SELECT COUNT({key}) AS n, MIN({key}) AS lo, MAX({key}) AS hi FROM {table} "
        f"WHERE {key} >= {literal(piece.low)} AND {key} <= {literal(piece.high)} GROUP BY {cell}"
    )
    return [Piece(lo, hi, n) for n, lo, hi in rows]


def literal(value: Number) -> str:
    """A number as all databases read it; a negative one in parentheses."""
    spoken = format(value, "f") if isinstance(value, Decimal) else repr(value)
    if isinstance(value, float) and "e" not in spoken:
        spoken += "E0"
    return f"({spoken})" if value < 0 else spoken


def predicates(key: str, found: list[Piece], partitions: int) -> list[str]:
    """Conditions that every row meets exactly one of: ranges of about as many rows.

    A range ends where it has its share of what is left. The first has no lower limit
    and the rows without a key, the last no upper one.
    """
    left, ranges, limits, held = sum(p.rows for p in found), partitions, [], 0
    for piece, after in zip(found, found[1:], strict=False):
        held += piece.rows
        # Closed now, or with one piece more: whichever is nearer to its share.
        if ranges > 1 and held + after.rows / 2 >= left / ranges:
            limits.append(literal(after.low))
            left, held, ranges = left - held, 0, ranges - 1
    if not limits:
        return []
    first = f"{key} < {limits[0]} OR {key} IS NULL"
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(limits, limits[1:], strict=False)]
    return [first, *inner, f"{key} >= {limits[-1]}"]


def ask_jdbc(spark: SparkSession, url: str, properties: Mapping[str, Any]) -> Ask:
    """A function that runs a statement in the database and returns its rows."""

    def ask(statement: str) -> list:
        options = {**properties, "url": url, "dbtable": f"({statement}) asked"}
        return spark.read.format("jdbc").options(**options).load().collect()

    return ask
