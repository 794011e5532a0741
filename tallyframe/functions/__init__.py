"""Column expressions shared by the operators."""

from tallyframe.functions.columns import (
    as_column,
    finite,
    local_time,
    log_cell,
    period_start,
    period_step,
)

__all__ = ["as_column", "finite", "local_time", "log_cell", "period_start", "period_step"]
