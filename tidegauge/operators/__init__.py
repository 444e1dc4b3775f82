"""DataFrame to DataFrame operators; all lazy, none collects rows."""

from .alerts import alert_counts, explode_alerts, with_alerts
from .enrich import enrich_insights
from .forecast import capacity_forecast
from .periods import process_metrics, window_metrics
from .rows import coerce_metrics, flag_rows, insight_columns, metrics_from_rows, split_valid
from .trends import trend_vs_history
from .views import (
    device_insights,
    device_kpis,
    device_list,
    device_statistics,
    hourly_trends,
    insight_series,
    live_lines,
    live_series,
    metrics_count,
    recent_display,
    recent_metrics,
    scan_lookback,
)

__all__ = [
    "alert_counts",
    "capacity_forecast",
    "coerce_metrics",
    "device_insights",
    "device_kpis",
    "device_list",
    "device_statistics",
    "enrich_insights",
    "explode_alerts",
    "flag_rows",
    "hourly_trends",
    "insight_columns",
    "insight_series",
    "live_lines",
    "live_series",
    "metrics_count",
    "metrics_from_rows",
    "process_metrics",
    "recent_display",
    "recent_metrics",
    "scan_lookback",
    "split_valid",
    "trend_vs_history",
    "window_metrics",
    "with_alerts",
]
