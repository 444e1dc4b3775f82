"""Served views over raw metrics and over insights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import since, with_event_time, within
from ..schemas import MEASURES
from ..session import use_table_settings


def scan_lookback(df: DataFrame, hours: float, as_of) -> DataFrame:
    """Metrics of the last `hours` before `as_of`, with no upper bound."""
    timed = with_event_time(df)
    return timed.where(within(timed, since(as_of, hours)))


def metrics_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("metrics_total"))


def newest_first() -> list[Column]:
    return [F.desc("timestamp"), F.desc("_id")]


def recent_metrics(df: DataFrame, limit: int = 50) -> DataFrame:
    """The `limit` newest metrics, newest first.

    `sources.latest_metrics` gives the same rows of a stored table while reading only its
    newest days.
    """
    return with_event_time(df).orderBy(*newest_first()).limit(limit)


def recent_display(df: DataFrame, n: int = 10) -> DataFrame:
    """The newest `n` metrics under the column titles of the dashboard."""
    # Display titles.
    return recent_metrics(df, n).select(
        F.col("device_id").alias("Device ID"),
        F.col("event_time").alias("Timestamp"),
        F.col("iops").alias("IOPS"),
        F.col("latency").alias("Latency (ms)"),
        F.col("capacity_used").alias("Capacity Used (GB)"),
    )


def live_series(df: DataFrame, limit: int = 50) -> DataFrame:
    """The points of the live charts: measures over time per device."""
    return recent_metrics(df, limit).select("device_id", "event_time", *MEASURES)


def live_lines(tail: DataFrame, n: int = 10) -> DataFrame:
    """The newest `n` arrivals as text lines, newest first; a missing value reads `None`."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    # The texts of a line.
    use_table_settings(tail.sparkSession)
    newest = tail.orderBy(F.desc("received_at"), *newest_first()).limit(n)
    return newest.select(
        F.concat(
            F.lit("**"),
            F.coalesce(F.date_format("received_at", "HH:mm:ss"), F.lit("None")),
            F.lit("** - Device: "),
            shown("device_id"),
            F.lit(", IOPS: "),
            shown("iops"),
            F.lit(", Latency: "),
            shown("latency"),
            F.lit("ms, Capacity: "),
            shown("capacity_used"),
            F.lit("GB"),
        ).alias("line")
    )


def hourly_trends(df: DataFrame) -> DataFrame:
    """Mean of each measure per device and UTC hour; rows without device or time drop out."""
    at = F.unix_micros("event_time")
    hour = (at - F.pmod(at, F.lit(3_600_000_000))).alias("hour")
    means = (
        with_event_time(df)
        .where(F.col("device_id").isNotNull() & F.col("event_time").isNotNull())
        .groupBy("device_id", hour)
        .agg(*[F.avg(m).alias(m) for m in MEASURES])
    )
    return means.withColumn("hour", F.timestamp_micros("hour"))


def device_statistics(df: DataFrame, display: bool = False) -> DataFrame:
    """Mean, minimum and maximum of each measure per device; `display` gives column titles."""
    kinds = (("avg", F.avg), ("min", F.min), ("max", F.max))
    numbers = (
        df.where(F.col("device_id").isNotNull())
        .groupBy("device_id")
        .agg(*[fn(m).cast("double").alias(f"{kind}_{m}") for m in MEASURES for kind, fn in kinds])
    )
    if not display:
        return numbers
    # Display titles.
    titles = [f"{kind} {m}" for m in ("IOPS", "Latency", "Capacity") for kind in ("Avg", "Min", "Max")]
    return numbers.toDF("Device ID", *titles)


def period_rank() -> Column:
    """One number that sorts insights by (period_end, period_start).

    A struct would order the same way, but Spark can only hash-aggregate fixed-width
    buffers and would sort all rows for a struct.
    """
    end = F.unix_micros("period_end").cast("decimal(19,0)")
    start = F.unix_micros("period_start").cast("decimal(19,0)")
    return end * F.lit("1" + "0" * 18).cast("decimal(19,0)") + start


def device_kpis(insights: DataFrame, display: bool = True) -> DataFrame:
    """Latest averages of every device and their change since the oldest row given.

    A device with a single row has no change (NULL). For display, latency and capacity are
    rounded to two decimals and IOPS to none, ties to even; otherwise nothing is rounded.
    """
    # Output name, column, decimals.
    cards = (
        ("latency", "avg_latency", 2),
        ("iops", "avg_iops", 0),
        ("capacity", "avg_capacity_used", 2),
    )
    aggregates = [F.count("*").alias("periods")]
    for name, column, _ in cards:
        aggregates.append(F.max_by(column, "rank").alias(f"newest_{name}"))
        aggregates.append(F.min_by(column, "rank").alias(f"oldest_{name}"))
    ends = (
        insights.select("device_id", period_rank().alias("rank"), *[c for _, c, _ in cards])
        .groupBy("device_id")
        .agg(*aggregates)
    )
    shown = []
    for name, _, digits in cards:
        newest, oldest = F.col(f"newest_{name}"), F.col(f"oldest_{name}")
        change = F.when(F.col("periods") > 1, newest - oldest)
        for label, value in (("latest", newest), ("delta", change)):
            shown.append((F.bround(value, digits) if display else value).alias(f"{label}_{name}"))
    return ends.select("device_id", *shown)


def device_list(insights: DataFrame) -> DataFrame:
    """Each device once, the most recently reported first."""
    return (
        insights.groupBy("device_id")
        .agg(F.max("period_end").alias("last_seen"))
        .orderBy(F.desc("last_seen"), "device_id")
        .select("device_id")
    )


def device_insights(insights: DataFrame, device_id: str) -> DataFrame:
    """Insights of one device."""
    return insights.where(F.col("device_id") == device_id)


def insight_series(insights: DataFrame, device_id: str) -> DataFrame:
    """One device's averages over time, oldest first."""
    return (
        device_insights(insights, device_id)
        .orderBy("period_end", "period_start")
        .select("period_end", *[f"avg_{m}" for m in MEASURES])
    )
