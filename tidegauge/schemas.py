"""Table schemas and parameters shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MEASURES = ("iops", "latency", "capacity_used")

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("iops", T.IntegerType()),
        T.StructField("latency", T.DoubleType()),
        T.StructField("capacity_used", T.DoubleType()),
    ]
)

# Layout of the raw metrics table on disk. `quality` ("valid" / "quarantined") and
# `event_date` are the first partition columns, so one stream writes both the good
# rows and the rejected ones and a time scan opens only the days it needs. `batch` names
# the micro-batch, so that a replayed one replaces what it wrote before.
METRIC_TABLE_SCHEMA = T.StructType(
    METRIC_SCHEMA.fields
    + [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
        T.StructField("quality", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("batch", T.StringType()),
    ]
)
METRIC_PARTITIONS = ("quality", "event_date", "batch")

INSIGHT_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("period_start", T.TimestampType()),
        T.StructField("period_end", T.TimestampType()),
        T.StructField("avg_iops", T.DoubleType()),
        T.StructField("avg_latency", T.DoubleType()),
        T.StructField("avg_capacity_used", T.DoubleType()),
        T.StructField("max_iops", T.DoubleType()),
        T.StructField("max_latency", T.DoubleType()),
        T.StructField("max_capacity_used", T.DoubleType()),
        T.StructField("min_iops", T.DoubleType()),
        T.StructField("min_latency", T.DoubleType()),
        T.StructField("min_capacity_used", T.DoubleType()),
        T.StructField("metrics_count", T.LongType()),
        T.StructField("alerts", T.ArrayType(T.StringType())),
    ]
)

# On disk an insight also carries when it was written and the two partition columns:
# `period_date` (day of period_end) lets a lookback prune, `period_key` names one exact
# (start, end) period so that a rerun replaces just that period.
INSIGHT_TABLE_SCHEMA = T.StructType(
    INSIGHT_SCHEMA.fields
    + [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("period_date", T.DateType()),
        T.StructField("period_key", T.StringType()),
    ]
)
INSIGHT_PARTITIONS = ("period_date", "period_key")

# Columns that may not be NULL, in schema order.
METRIC_REQUIRED = ("device_id", "timestamp")
INSIGHT_REQUIRED = tuple(n for n in INSIGHT_SCHEMA.names if n != "alerts")


@dataclass(frozen=True)
class Thresholds:
    """Alert limits; all comparisons are strict."""

    # Milliseconds, operations per second, gigabytes.
    high_latency: float = 10.0
    low_iops: float = 500
    high_capacity: float = 800.0
