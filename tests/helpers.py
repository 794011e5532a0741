"""Brute-force answers on the driver, for small fixtures only."""

from __future__ import annotations

import math


def quantile(values, p):
    ordered = sorted(values)
    place = p * (len(ordered) - 1)
    low, high = math.floor(place), math.ceil(place)
    weight = place - low
    return ordered[low] * (1 - weight) + ordered[high] * weight


def box(values):
    """One box as a tuple in the column order of ``box_summary``, without ``by``."""
    q1, median, q3 = (quantile(values, p) for p in (0.25, 0.5, 0.75))
    reach = 1.5 * (q3 - q1)
    inside = [v for v in values if q1 - reach <= v <= q3 + reach]
    return (
        len(values),
        min(values),
        min(inside),
        q1,
        median,
        q3,
        max(inside),
        max(values),
        len(values) - len(inside),
    )


def boxes(rows):
    groups = {}
    for by, value in rows:
        if value is not None and math.isfinite(value):
            groups.setdefault(by, []).append(value)
    return {by: box(values) for by, values in groups.items()}


def collected_boxes(frame):
    return {row[0]: tuple(row)[1:] for row in frame.collect()}


def plan_of(frame):
    """Physical plan as text, before it has run."""
    return frame._jdf.queryExecution().executedPlan().toString()
