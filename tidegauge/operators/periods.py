"""Per-device summaries of one period or of many fixed-length periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_micros, moment, with_event_time, within
from ..schemas import MEASURES, Thresholds
from .alerts import with_alerts
from .rows import insight_columns

MICROS_PER_MINUTE = 60_000_000


def summary_columns() -> list[Column]:
    """Average, maximum and minimum of each measure, and the row count.

    All buffers are fixed-width numbers, so Spark hash-aggregates them before the shuffle:
    a device with a third of all rows sends one partial row per task and period.
    """
    numbers = {
        f"{kind}_{m}": fn(m).cast("double")
        for kind, fn in (("avg", F.avg), ("max", F.max), ("min", F.min))
        for m in MEASURES
    }
    return [c.alias(n) for n, c in numbers.items()] + [F.count("*").alias("metrics_count")]


def process_metrics(
    df: DataFrame,
    start,
    end,
    thresholds: Thresholds = Thresholds(),
    style: str = "value",
) -> DataFrame:
    """All given rows as one period `[start, end)`: one insight per device.

    The caller has already scanned the range; rows are not filtered again.
    """
    summed = df.groupBy("device_id").agg(*summary_columns())
    bounded = summed.select(
        "*", moment(start).alias("period_start"), moment(end).alias("period_end")
    )
    return insight_columns(with_alerts(bounded, thresholds, style))


def window_metrics(
    df: DataFrame,
    start,
    end,
    minutes: float = 60,
    thresholds: Thresholds = Thresholds(),
    style: str = "value",
) -> DataFrame:
    """Insights for every `minutes`-long slice of `[start, end)` in one pass.

    Slices are anchored at `start` and the last one is clipped to `end`. A device without
    rows in a slice gives no insight for it.
    """
    first, last = epoch_micros(start), epoch_micros(end)
    width = round(minutes * MICROS_PER_MINUTE)
    if width <= 0:
        raise ValueError("minutes must be positive")
    timed = with_event_time(df)
    into_run = F.unix_micros("event_time") - first
    slot = (F.lit(first) + into_run - into_run % width).alias("slot")
    summed = (
        timed.where(within(timed, start, end))
        .select("device_id", slot, *MEASURES)
        .groupBy("device_id", "slot")
        .agg(*summary_columns())
    )
    bounded = summed.select(
        "*",
        F.timestamp_micros("slot").alias("period_start"),
        F.timestamp_micros(F.least(F.col("slot") + width, F.lit(last))).alias("period_end"),
    )
    return insight_columns(with_alerts(bounded, thresholds, style))
