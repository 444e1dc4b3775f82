"""Whole jobs, and the queries over the given tables."""

from .batch import close_windows, run_lookback, run_range

__all__ = ["close_windows", "run_lookback", "run_range"]
