"""Reductions of a table of any size to a small table for a chart or report."""

from tallyframe.operators.boxes import box_summary
from tallyframe.operators.categories import category_counts
from tallyframe.operators.correlations import correlation_matrix
from tallyframe.operators.histograms import histogram_feed
from tallyframe.operators.periods import period_series
from tallyframe.operators.regions import region_value_feed

__all__ = [
    "box_summary",
    "category_counts",
    "correlation_matrix",
    "histogram_feed",
    "period_series",
    "region_value_feed",
]
