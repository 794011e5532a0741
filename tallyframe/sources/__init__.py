"""Where tables come from and where results go."""

from tallyframe.sources.jdbc import jdbc_bounds, jdbc_scan, jdbc_write
from tallyframe.sources.ranges import jdbc_scan_by_counts
from tallyframe.sources.staged import jdbc_staged_write
from tallyframe.sources.tables import read_table

__all__ = [
    "jdbc_bounds",
    "jdbc_scan",
    "jdbc_scan_by_counts",
    "jdbc_staged_write",
    "jdbc_write",
    "read_table",
]
