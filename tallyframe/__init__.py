"""Plot-ready tables from data of any size, on Spark."""

from tallyframe.operators import (
    box_summary,
    category_counts,
    correlation_matrix,
    histogram_feed,
    period_series,
    region_value_feed,
)
from tallyframe.plans import durable
from tallyframe.sources import (
    jdbc_bounds,
    jdbc_scan,
    jdbc_scan_by_counts,
    jdbc_staged_write,
    jdbc_write,
    read_table,
)

__all__ = [
    "box_summary",
    "category_counts",
    "correlation_matrix",
    "durable",
    "histogram_feed",
    "jdbc_bounds",
    "jdbc_scan",
    "jdbc_scan_by_counts",
    "jdbc_staged_write",
    "jdbc_write",
    "period_series",
    "read_table",
    "region_value_feed",
]
