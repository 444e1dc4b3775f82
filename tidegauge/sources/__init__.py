"""Reading metrics and insights."""

from .insights import jdbc_read_options, read_insights
from .metrics import latest_metrics, load_metrics, metric_table, read_quarantine, scan_metrics

__all__ = [
    "jdbc_read_options",
    "latest_metrics",
    "load_metrics",
    "metric_table",
    "read_insights",
    "read_quarantine",
    "scan_metrics",
]
