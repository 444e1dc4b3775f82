"""Writing insights."""

from .insights import (
    ensure_insights_table,
    insight_rows,
    jdbc_rows,
    jdbc_write_options,
    write_checked,
    write_insights,
)

__all__ = [
    "ensure_insights_table",
    "insight_rows",
    "jdbc_rows",
    "jdbc_write_options",
    "write_checked",
    "write_insights",
]
