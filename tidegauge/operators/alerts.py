"""Raising alerts on summaries and listing them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import alert_array
from ..schemas import Thresholds


def with_alerts(
    df: DataFrame, thresholds: Thresholds = Thresholds(), style: str = "value"
) -> DataFrame:
    """Add the `alerts` array to a frame of averages."""
    return df.withColumn("alerts", alert_array(thresholds, style))


def explode_alerts(insights: DataFrame) -> DataFrame:
    """One row per non-empty alert, stamped with the end of its period.

    `alerts` may be an array or JSON text; text that is no JSON array gives no row.
    """
    alerts = F.col("alerts")
    if isinstance(insights.schema["alerts"].dataType, T.StringType):
        alerts = F.from_json(alerts, "array<string>")
    return (
        insights.select(
            F.col("period_end").alias("timestamp"), F.explode(alerts).alias("alert"), "device_id"
        )
        .where(F.col("alert").isNotNull() & (F.col("alert") != ""))
    )


def alert_counts(insights: DataFrame) -> DataFrame:
    """How often each alert text occurs."""
    return explode_alerts(insights).groupBy("alert").agg(F.count("*").alias("occurrences"))
