"""Pairwise Pearson correlation, the table behind a correlation heat map."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions that tasks run are sent along, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What is kept of a pair of columns: the rows that have both values, the scales, then
# means, squared deviations, extremes, and the products of deviations. Means and
# deviations are of the values divided by two to the power of their scale.
STATE = ["n", "ex", "ey", "mean_x", "mean_y", "m2_x", "m2_y", "lo_x", "lo_y", "hi_x", "hi_y", "c"]
# Rows that a task looks at together.
BLOCK_ROWS = 16_384


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``x, y, r, n``: the upper triangle with the diagonal, in no fixed order.

    Null, NaN and infinite values are missing. Each pair uses the ``n`` rows that
    have both values. ``r`` is null where either side is constant over them. ``cols``
    are names of columns as they are, also with dots.

    The table is read once, whatever the number of columns. A task sums up each block
    of rows by matrix products and keeps one state per pair. It sends those, and they
    are merged per pair, at most one from each task. Values are scaled by powers of two,
    so squares of very large or small ones stay in the range of doubles.
    """
    cols = list(cols)
    if not cols or len(set(cols)) != len(cols):
        raise ValueError("cols must be distinct column names, at least one")
    numbers = df.select(
        *(F.col(_quoted(name)).cast("double").alias(f"c{i}") for i, name in enumerate(cols))
    )
    upper = np.triu_indices(len(cols))

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                columns = batch.slice(at, BLOCK_ROWS).columns
                values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
                found = block_state(values.astype(float), upper)
                state = found if state is None else merged(np.stack([state, found], axis=1))
        if state is not None:
            named = dict(zip(STATE, state, strict=True))
            columns = [pa.array(upper[0]), pa.array(upper[1]), *(pa.array(named[s]) for s in STATE)]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", *STATE])

    def joined(states: pd.DataFrame) -> pd.DataFrame:
        state = merged(states[STATE].to_numpy().T[:, :, None])
        first = states.iloc[0]
        i, j = int(first["i"]), int(first["j"])
        r = correlation(state)[0]
        r = 1.0 if i == j and not np.isnan(r) else r
        return pd.DataFrame(
            {"x": [cols[i]], "y": [cols[j]], "r": pd.array([None if np.isnan(r) else r], "Float64"), "n": [int(state[0][0])]}
        )

    fields = ", ".join(f"{name} double" for name in STATE)
    states = numbers.mapInArrow(summed, f"i bigint, j bigint, {fields}")
    found = states.groupBy("i", "j").applyInPandas(joined, "x string, y string, r double, n bigint")
    # Without any rows there is no state, and all pairs have no correlation.
    pairs = [(cols[i], cols[j]) for i, j in zip(*upper, strict=True)]
    empty = df.sparkSession.createDataFrame(pairs, "x string, y string").selectExpr(
        "x", "y", "CAST(NULL AS DOUBLE) AS r", "0L AS n"
    )
    return found.unionByName(empty).groupBy("x", "y").agg(F.max("r").alias("r"), F.sum("n").alias("n"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def block_state(values: np.ndarray, upper: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The state of all pairs over the rows of a block: a row per field of STATE."""
    known = np.isfinite(values)
    values = np.where(known, values, 0.0)
    largest = np.abs(values).max(0)
    scale = np.where(largest > 0, np.frexp(largest)[1], 0).astype(float)
    scaled = _scaled(values, scale)
    mask = known.astype(float)
    # Deviations from a value in the middle: products of those lose no digits.
    middle = scaled.sum(0) / np.maximum(1, mask.sum(0))
    centred = np.where(known, scaled - middle, 0.0)
    n = mask.T @ mask
    total = centred.T @ mask  # of the first column, over the rows of the pair
    size = np.maximum(1, n)
    mean = total / size
    m2 = np.maximum(0.0, (centred**2).T @ mask - total * mean)
    c = centred.T @ centred - total * mean.T
    lo, hi = np.empty_like(n), np.empty_like(n)
    whole = known.all(0)
    for j in range(values.shape[1]):
        rows = slice(None) if whole[j] else known[:, j]
        lo[:, j] = np.where(known[rows], values[rows], np.inf).min(0, initial=np.inf)
        hi[:, j] = np.where(known[rows], values[rows], -np.inf).max(0, initial=-np.inf)
    i, j = upper
    mean = mean + middle[:, None]
    return np.stack(
        [n[i, j], scale[i], scale[j], mean[i, j], mean[j, i], m2[i, j], m2[j, i],
         lo[i, j], lo[j, i], hi[i, j], hi[j, i], c[i, j]]
    )


def _scaled(values: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """``values / 2**scale``; in two steps, as the power itself may leave the doubles."""
    half = np.floor(scale / 2).astype(int)
    return np.ldexp(np.ldexp(values, -half), half - scale.astype(int))


def merged(states: np.ndarray) -> np.ndarray:
    """One state per pair from several, along the second axis."""
    n, ex, ey, mean_x, mean_y, m2_x, m2_y, lo_x, lo_y, hi_x, hi_y, c = states
    used = n > 0
    ex, ey = np.where(used, ex, -5000.0), np.where(used, ey, -5000.0)
    top_x, top_y = ex.max(0), ey.max(0)
    down_x, down_y = (np.minimum(t - e, 5000.0) for t, e in ((top_x, ex), (top_y, ey)))
    mean_x, mean_y = _scaled(mean_x, down_x), _scaled(mean_y, down_y)
    total = np.maximum(1, n.sum(0))
    x, y = (n * mean_x).sum(0) / total, (n * mean_y).sum(0) / total
    off_x, off_y = mean_x - x, mean_y - y
    return np.stack(
        [n.sum(0), top_x, top_y, x, y,
         (_scaled(m2_x, 2 * down_x) + n * off_x**2).sum(0),
         (_scaled(m2_y, 2 * down_y) + n * off_y**2).sum(0),
         lo_x.min(0), lo_y.min(0), hi_x.max(0), hi_y.max(0),
         (_scaled(c, down_x + down_y) + n * off_x * off_y).sum(0)]
    )


def correlation(state: np.ndarray) -> np.ndarray:
    """Pearson correlation of each pair, NaN where there is none.

    Constancy is decided by comparing extremes, as rounding leaves a constant column
    a tiny deviation.
    """
    _, _, _, _, _, m2_x, m2_y, lo_x, lo_y, hi_x, hi_y, c = state
    spread = np.sqrt(m2_x) * np.sqrt(m2_y)
    varies = (lo_x < hi_x) & (lo_y < hi_y) & (spread > 0)
    r = np.clip(c / np.where(varies, spread, 1.0), -1.0, 1.0)
    return np.where(varies, r, np.nan)
