"""Capacity outlook per device."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .views import period_rank


def capacity_forecast(insights: DataFrame, threshold: float = 800.0) -> DataFrame:
    """Linear growth of the average capacity, and hours until it reaches `threshold`.

    0 hours if the latest value is already there, NULL if the line does not rise. Devices
    with fewer than two periods have no line and are left out.
    """
    hours = F.unix_micros("period_start") / 3_600_000_000
    lines = (
        insights.select(
            "device_id", "avg_capacity_used", hours.alias("at"), period_rank().alias("rank")
        )
        .groupBy("device_id")
        .agg(
            F.count("*").alias("periods"),
            F.regr_slope("avg_capacity_used", "at").alias("slope_per_hour"),
            F.max_by("avg_capacity_used", "rank").alias("latest_capacity"),
        )
        .where(F.col("periods") >= 2)
    )
    left = F.lit(threshold) - F.col("latest_capacity")
    return lines.select(
        "device_id",
        "slope_per_hour",
        "latest_capacity",
        F.when(F.col("latest_capacity") >= threshold, 0.0)
        .when(F.col("slope_per_hour") > 0, F.try_divide(left, F.col("slope_per_hour")))
        .alias("hours_to_threshold"),
    )
