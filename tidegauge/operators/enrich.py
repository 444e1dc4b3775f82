"""Device metadata and performance tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_insights(
    insights: DataFrame,
    devices: DataFrame,
    gold_latency: float = 5.0,
    gold_iops: float = 5000,
    bronze_latency: float = 10.0,
    bronze_iops: float = 500,
) -> DataFrame:
    """Join the device dimension (one row per device) and grade each insight.

    No broadcast hint: AQE broadcasts `devices` once its measured size is below the
    session's limit, and otherwise sorts and merges, splitting skewed partitions. A device
    can only be hot here while devices are few, and then the dimension is small.
    """
    poor = (F.col("avg_latency") > bronze_latency) | (F.col("avg_iops") < bronze_iops)
    good = (F.col("avg_latency") <= gold_latency) & (F.col("avg_iops") >= gold_iops)
    tier = F.when(poor, "bronze").when(good, "gold").otherwise("silver")
    return insights.join(devices, "device_id", "left").withColumn("tier", tier)
