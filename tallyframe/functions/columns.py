"""Expressions shared by the operators. All are built-in functions.

Those that operators use many times over return SQL text: one text is parsed once,
where the same built from columns costs a call into the JVM per operation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar step of every supported period.
PERIOD_STEPS = {
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAY",
    "month": "INTERVAL 1 MONTH",
    "quarter": "INTERVAL 3 MONTH",
    "year": "INTERVAL 1 YEAR",
}

# Logarithmic cells per factor of e: one cell is 0.8 % wide.
CELLS_PER_E = 128
# Above -ln(smallest positive double), so that cells of positive values are positive.
LN_SHIFT = 746


def as_column(column: str | Column) -> Column:
    """Accept a column name or an expression."""
    return F.col(column) if isinstance(column, str) else column


def finite(x: str) -> str:
    """True for numbers; false or null for null, NaN and the infinities.

    Two comparisons rather than ``isnan``, because comparisons are pushed into
    the Parquet scan. NaN sorts above infinity in Spark, so the upper bound
    drops it.
    """
    return f"({x} > double('-Infinity') AND {x} < double('Infinity'))"


def log_cell(x: str) -> str:
    """Number of the logarithmic cell that holds a finite double.

    Never decreases with ``x``, so all values of a lower cell are smaller than
    all values of a higher one. Needs nothing known about the data in advance
    and has at most about 380,000 cells over the whole range of doubles.
    """
    magnitude = f"floor(ln(abs({x})) * {CELLS_PER_E}) + {LN_SHIFT * CELLS_PER_E}"
    return f"CASE WHEN {x} > 0 THEN {magnitude} WHEN {x} < 0 THEN -({magnitude}) ELSE 0L END"


def period_step(period: str) -> Column:
    """Interval between the starts of two neighbouring periods."""
    if period not in PERIOD_STEPS:
        raise ValueError(f"period must be one of {sorted(PERIOD_STEPS)}, not {period!r}")
    return F.expr(PERIOD_STEPS[period])


def period_start(ts: Column, period: str) -> Column:
    """First date of the period that holds ``ts``.

    ``date_trunc`` would turn a ``timestamp_ntz`` into a zoned timestamp and so
    depend on the session zone; ``trunc`` returns a date. It has no day unit,
    where a cast does the same.
    """
    return ts.cast("date") if period == "day" else F.trunc(ts, period)


def local_time(ts: str, zone: str) -> Column:
    """The ``timestamp_ntz`` that clocks of ``zone`` show at the instant in column ``ts``.

    Goes through the microseconds since 1970, as a cast would use the session zone.
    """
    seconds = f"CAST(unix_micros({ts}) / 1000000BD AS DECIMAL(18, 6))"
    utc = f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.expr(utc))
