"""Device telemetry on Spark: ingest, periodic insights, alerts and served views."""

from .schemas import INSIGHT_SCHEMA, METRIC_SCHEMA, Thresholds
from .session import build_session

__all__ = ["INSIGHT_SCHEMA", "METRIC_SCHEMA", "Thresholds", "build_session"]
