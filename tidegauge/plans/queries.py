"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import with_event_time
from ..schemas import INSIGHT_REQUIRED, INSIGHT_SCHEMA, MEASURES, Thresholds
from ..session import scratch_dir
from ..sinks import ensure_insights_table, insight_rows, jdbc_rows, write_insights
from ..sources import latest_metrics, read_insights, read_quarantine, scan_metrics
from ..streaming import (
    compact_metrics,
    decode_messages,
    ingest_metrics,
    live_tail,
    read_live_tail,
    scan_compacted,
    start_insights,
    stream_insights,
)
from . import close_windows, run_lookback, run_range
from .given_tables import as_messages, devices, given, loose_metrics, metrics, stream_of_metrics

Query = Callable[[SparkSession, str], DataFrame]

START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
LOOKBACK_HOURS = 24
# A run that starts and ends off the hour.
ODD_START, ODD_END = 1704068434.5, 1706400000.25
DEVICE = "dev01"
ONCE = {"availableNow": True}

AVERAGES = tuple(f"avg_{m}" for m in MEASURES)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Means are sums in no fixed order, so they are compared to a few decimals.

    A mean over a power of two of short decimals often ends exactly halfway between two
    roundings, and the last bit of the sum would then decide. A small odd shift moves those
    values away from the edge; the SQL does the same.
    """
    shift = F.lit(f"0.1234567e-{digits}").cast("double")
    return df.withColumns({n: F.round(F.col(n) + shift, digits) for n in names})


def flat(insights: DataFrame) -> DataFrame:
    """Insights with rounded averages and the alerts as one text."""
    return rounded(insights.withColumn("alerts", F.concat_ws("|", "alerts")), *AVERAGES)


def windows(spark: SparkSession, sf_dir: str, style: str = "threshold") -> DataFrame:
    return op.window_metrics(metrics(spark, sf_dir), START, END, style=style)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written once and read back, for operators that go over their input more than once."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def device_summary(spark, sf_dir):
    return flat(op.process_metrics(metrics(spark, sf_dir), START, END, style="threshold"))


def window_insights(spark, sf_dir):
    return flat(windows(spark, sf_dir))


def clipped_windows(spark, sf_dir):
    rows = metrics(spark, sf_dir)
    return flat(op.window_metrics(rows, ODD_START, ODD_END, minutes=95, style="threshold"))


def range_scan(spark, sf_dir):
    """[start, end) of the stored table that holds all events."""
    return scan_metrics(spark, ingested(spark, sf_dir), ODD_START, ODD_END)


def lookback_scan(spark, sf_dir):
    return op.scan_lookback(metrics(spark, sf_dir), LOOKBACK_HOURS, END)


def recent_metrics(spark, sf_dir):
    return op.recent_metrics(metrics(spark, sf_dir))


def recent_from_table(spark, sf_dir):
    """The same rows from the stored table, reading its newest days only."""
    return latest_metrics(spark, ingested(spark, sf_dir), as_of=END)


def recent_display(spark, sf_dir):
    shown = op.recent_display(metrics(spark, sf_dir))
    return shown.toDF("device_id", "event_time", "iops", "latency", "capacity_used")


def live_series(spark, sf_dir):
    return op.live_series(metrics(spark, sf_dir))


def hourly_trends(spark, sf_dir):
    return rounded(op.hourly_trends(metrics(spark, sf_dir)), *MEASURES)


def device_statistics(spark, sf_dir):
    return rounded(op.device_statistics(metrics(spark, sf_dir)), *AVERAGES)


def device_kpis(spark, sf_dir):
    kpis = op.device_kpis(windows(spark, sf_dir), display=False)
    return rounded(kpis, *[n for n in kpis.columns if n != "device_id"])


def device_list(spark, sf_dir):
    return op.device_list(windows(spark, sf_dir))


def device_insights(spark, sf_dir):
    return flat(op.device_insights(windows(spark, sf_dir), DEVICE))


def insight_series(spark, sf_dir):
    return rounded(op.insight_series(windows(spark, sf_dir), DEVICE), *AVERAGES)


def insights_lookback(spark, sf_dir):
    """Insights of the last day, from the stored insights table."""
    target = scratch_dir(spark, "insights")
    write_insights(windows(spark, sf_dir), target)
    return flat(read_insights(spark, target, LOOKBACK_HOURS, END))


def insights_text_bounds(spark, sf_dir):
    """The same from a table that holds times as texts and alerts as JSON, as an export of a database does."""
    rows = windows(spark, sf_dir)
    bounds = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("period_start", "period_end")]
    others = [c for c in rows.columns if c not in ("period_start", "period_end", "alerts")]
    path = scratch_dir(spark, "exported")
    rows.select(*others, *bounds, F.to_json("alerts").alias("alerts")).write.parquet(path)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.read.parquet(path).createOrReplaceTempView(name)
    return flat(read_insights(spark, name, LOOKBACK_HOURS, END))


def insights_rerun(spark, sf_dir):
    """The stored table after writing all periods twice: nothing is doubled."""
    target = scratch_dir(spark, "insights")
    for _ in range(2):
        write_insights(windows(spark, sf_dir), target)
    return flat(read_insights(spark, target))


def insights_table(spark, sf_dir):
    """The same through a catalog table, created if it is not there."""
    location = scratch_dir(spark, "insights-table")
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    ensure_insights_table(spark, name, location)
    for _ in range(2):
        write_insights(windows(spark, sf_dir), name)
    return flat(read_insights(spark, name))


def stored_rows(spark, sf_dir):
    """Insights as the parquet sink stores them, without the write time."""
    rows = insight_rows(windows(spark, sf_dir)).select(
        "device_id", "period_date", "period_key", "metrics_count"
    )
    return rows.withColumn("period_date", F.col("period_date").cast("string"))


def jdbc_boundary(spark, sf_dir):
    """Rows as a JDBC sink gets them, alerts as JSON text; no database is opened."""
    sent = jdbc_rows(windows(spark, sf_dir)).drop("created_at")
    return rounded(sent, *AVERAGES)


def alerts_flat(spark, sf_dir):
    return op.explode_alerts(windows(spark, sf_dir))


def alert_counts(spark, sf_dir):
    return op.alert_counts(windows(spark, sf_dir))


def alerts_from_json(spark, sf_dir):
    return op.explode_alerts(jdbc_rows(windows(spark, sf_dir)))


def alert_text_values(spark, sf_dir):
    """Alerts that show the average, taken apart, as engines print doubles differently."""
    alerts = op.explode_alerts(windows(spark, sf_dir, style="value"))
    shape = r"^(.*: )([0-9.E+-]+)( |[a-zA-Z]+ )(\(.*\))$"
    label, shown, unit, limit = [F.regexp_extract("alert", shape, g) for g in (1, 2, 3, 4)]
    parts = alerts.select(
        "timestamp", "device_id", label.alias("label"), shown.cast("double").alias("shown"),
        F.trim(unit).alias("unit"), limit.alias("limit"),
    )
    return rounded(parts, "shown")


def metrics_total(spark, sf_dir):
    return op.metrics_count(metrics(spark, sf_dir))


def iops_as_double(df: DataFrame) -> DataFrame:
    """An integer column with NULLs has no common form in pandas; a double has."""
    return df.withColumn("iops", F.col("iops").cast("double"))


def coerced_metrics(spark, sf_dir):
    return iops_as_double(op.coerce_metrics(loose_metrics(spark, sf_dir)))


def valid_metrics(spark, sf_dir):
    good, _ = op.split_valid(loose_metrics(spark, sf_dir))
    return iops_as_double(op.coerce_metrics(good))


def quarantined_metrics(spark, sf_dir):
    _, refused = op.split_valid(loose_metrics(spark, sf_dir))
    return refused.select("_id", "device_id", "reason")


def gappy_insights(spark, sf_dir):
    """Hourly insights of records of which some lack a measure."""
    good, _ = op.split_valid(loose_metrics(spark, sf_dir))
    return op.window_metrics(op.coerce_metrics(good), START, END, style="threshold")


def valid_insights(spark, sf_dir):
    good, _ = op.split_valid(gappy_insights(spark, sf_dir), INSIGHT_REQUIRED, INSIGHT_SCHEMA)
    return flat(good)


def quarantined_insights(spark, sf_dir):
    _, refused = op.split_valid(gappy_insights(spark, sf_dir), INSIGHT_REQUIRED, INSIGHT_SCHEMA)
    return flat(refused)


def event_time_from_millis(spark, sf_dir):
    rows = metrics(spark, sf_dir).drop("event_time")
    in_millis = rows.withColumn("timestamp", F.floor(F.col("timestamp") * 1000).cast("double"))
    return with_event_time(in_millis, unit="ms").select("_id", "event_time")


def trend_vs_history(spark, sf_dir):
    trends = op.trend_vs_history(stored(windows(spark, sf_dir), "insights"))
    added = [f"{kind}_{m}" for kind in ("hist", "delta", "pct") for m in MEASURES]
    return rounded(trends.drop("alerts"), *AVERAGES, *added, digits=4)


def enriched_insights(spark, sf_dir):
    return flat(op.enrich_insights(windows(spark, sf_dir), devices(spark, sf_dir)))


def capacity_forecast(spark, sf_dir):
    forecast = op.capacity_forecast(windows(spark, sf_dir))
    return rounded(rounded(forecast, "slope_per_hour", "latest_capacity"), "hours_to_threshold", digits=2)


def ingested(spark: SparkSession, sf_dir: str) -> str:
    """Stream all events as JSON messages into a metrics table; its path."""
    path, checkpoint = scratch_dir(spark, "metrics"), scratch_dir(spark, "ingest-state")
    messages = as_messages(stream_of_metrics(spark, sf_dir))
    ingest_metrics(decode_messages(messages), path, checkpoint, ONCE).awaitTermination()
    return path


def stream_ingest(spark, sf_dir):
    return scan_metrics(spark, ingested(spark, sf_dir))


def stream_compacted(spark, sf_dir):
    """All events in four micro-batches: closed days from the table of merged ones, the others as they came."""
    path, checkpoint = scratch_dir(spark, "metrics"), scratch_dir(spark, "ingest-state")
    closed, before = scratch_dir(spark, "closed"), ODD_END
    folder = scratch_dir(spark, "messages")
    messages = as_messages(metrics(spark, sf_dir))
    messages.repartition(4).write.parquet(folder)
    stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    ingest_metrics(decode_messages(stream), path, checkpoint, ONCE).awaitTermination()
    compact_metrics(spark, path, closed, before)
    return scan_compacted(spark, path, closed, before)


def stream_quarantine(spark, sf_dir):
    """Event bodies are no metrics: all of them are refused, and none is lost."""
    path, checkpoint = scratch_dir(spark, "metrics"), scratch_dir(spark, "ingest-state")
    shape = given(spark, sf_dir, "events").schema
    events = spark.readStream.schema(shape).parquet(f"{sf_dir.rstrip('/')}/{{events}}.parquet")
    bodies = events.select(F.col("props").alias("value"))
    ingest_metrics(decode_messages(bodies), path, checkpoint, ONCE).awaitTermination()
    return read_quarantine(spark, path).groupBy("reason", "raw").agg(F.count("*").alias("messages"))


def stream_insights_query(spark, sf_dir):
    """Hourly insights of a stream of all events: the windows the watermark has closed."""
    target, checkpoint = scratch_dir(spark, "insights"), scratch_dir(spark, "insight-state")
    summed = stream_insights(stream_of_metrics(spark, sf_dir), style="threshold")
    start_insights(summed, target, checkpoint, ONCE).awaitTermination()
    return flat(read_insights(spark, target))


def stream_insights_closed(spark, sf_dir):
    """The same stream, then a batch run of the windows it left open: all insights."""
    target, checkpoint = scratch_dir(spark, "insights"), scratch_dir(spark, "insight-state")
    summed = stream_insights(stream_of_metrics(spark, sf_dir), style="threshold")
    start_insights(summed, target, checkpoint, ONCE).awaitTermination()
    close_windows(spark, metrics(spark, sf_dir), target, END, style="threshold")
    return flat(read_insights(spark, target))


def held_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = scratch_dir(spark, "tail"), scratch_dir(spark, "tail-state")
    arrivals = stream_of_metrics(spark, sf_dir).withColumn("received_at", F.col("event_time"))
    live_tail(arrivals, path, checkpoint, trigger=ONCE).awaitTermination()
    return read_live_tail(spark, path)


def live_tail_query(spark, sf_dir):
    return held_tail(spark, sf_dir)


def live_lines(spark, sf_dir):
    """The ten newest lines; the two doubles in them are compared as numbers."""
    lines = op.live_lines(held_tail(spark, sf_dir))
    shape = r"^(.*)Latency: (.*)ms, Capacity: (.*)GB$"
    head, latency, capacity = [F.regexp_extract("line", shape, g) for g in (1, 2, 3)]
    parts = lines.select(
        head.alias("head"),
        latency.cast("double").alias("latency"),
        capacity.cast("double").alias("capacity"),
    )
    return rounded(parts, "latency", "capacity")


def batch_lookback(spark, sf_dir):
    """The whole batch job: stored metrics in, insights of the last 30 days out."""
    target = scratch_dir(spark, "insights")
    table = ingested(spark, sf_dir)
    run_lookback(spark, table, target, END, hours_back=30 * 24, style="threshold")
    return flat(read_insights(spark, target))


def batch_range(spark, sf_dir):
    """The whole batch job over an explicit range: one period."""
    target = scratch_dir(spark, "insights")
    run_range(spark, ingested(spark, sf_dir), target, ODD_START, ODD_END, style="threshold")
    return flat(read_insights(spark, target))


def strict_limits(spark, sf_dir):
    """Hourly insights under other thresholds than the default ones."""
    limits = Thresholds(high_latency=5.0, low_iops=4000, high_capacity=500.0)
    return flat(op.window_metrics(metrics(spark, sf_dir), START, END, thresholds=limits, style="threshold"))


def empty_range(spark, sf_dir):
    """A day without events: nothing is written and nothing comes out."""
    rows = metrics(spark, sf_dir)
    if run_lookback(spark, rows, scratch_dir(spark, "insights"), START, hours_back=24):
        raise AssertionError("a write of nothing says so")
    return flat(op.window_metrics(rows, "2023-12-31 00:00:00", START, style="threshold"))


def all_rejected_insights(spark, sf_dir):
    """No event has a latency: every insight is refused, and all are kept with the reason."""
    rows = metrics(spark, sf_dir).withColumn("latency", F.lit(None).cast("double"))
    target = scratch_dir(spark, "insights")
    run_lookback(spark, rows, target, END, hours_back=30 * 24, style="threshold")
    refused = spark.read.parquet(f"{target}-rejects")
    return flat(refused.drop("created_at", "period_date", "period_key"))


def insights_repaired(spark, sf_dir):
    """A run over rows of which some lack a measure, then one after repair and withdrawal."""
    rows = metrics(spark, sf_dir)
    number = F.col("_id").cast("long")
    gaps = rows.withColumn("latency", F.when(number % 5 != 0, F.col("latency")))
    target = scratch_dir(spark, "insights")
    for each in (gaps, rows.where(number % 7 != 3)):
        run_lookback(spark, each, target, END, hours_back=30 * 24, style="threshold")
    return flat(read_insights(spark, target))


def device_kpis_display(spark, sf_dir):
    return op.device_kpis(windows(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "strict_limits": strict_limits,
    "empty_range": empty_range,
    "all_rejected_insights": all_rejected_insights,
    "insights_repaired": insights_repaired,
    "device_kpis_display": device_kpis_display,
    "window_insights": window_insights,
    "device_summary": device_summary,
    "clipped_windows": clipped_windows,
    "range_scan": range_scan,
    "lookback_scan": lookback_scan,
    "recent_metrics": recent_metrics,
    "recent_from_table": recent_from_table,
    "recent_display": recent_display,
    "live_series": live_series,
    "hourly_trends": hourly_trends,
    "device_statistics": device_statistics,
    "device_kpis": device_kpis,
    "device_list": device_list,
    "device_insights": device_insights,
    "insight_series": insight_series,
    "insights_lookback": insights_lookback,
    "insights_text_bounds": insights_text_bounds,
    "insights_rerun": insights_rerun,
    "insights_table": insights_table,
    "stored_rows": stored_rows,
    "jdbc_boundary": jdbc_boundary,
    "alerts_flat": alerts_flat,
    "alert_counts": alert_counts,
    "alerts_from_json": alerts_from_json,
    "alert_text_values": alert_text_values,
    "metrics_total": metrics_total,
    "coerced_metrics": coerced_metrics,
    "valid_metrics": valid_metrics,
    "quarantined_metrics": quarantined_metrics,
    "valid_insights": valid_insights,
    "quarantined_insights": quarantined_insights,
    "event_time_from_millis": event_time_from_millis,
    "trend_vs_history": trend_vs_history,
    "enriched_insights": enriched_insights,
    "capacity_forecast": capacity_forecast,
    "stream_ingest": stream_ingest,
    "stream_compacted": stream_compacted,
    "stream_quarantine": stream_quarantine,
    "stream_insights": stream_insights_query,
    "stream_insights_closed": stream_insights_closed,
    "live_tail": live_tail_query,
    "live_lines": live_lines,
    "batch_lookback": batch_lookback,
    "batch_range": batch_range,
}
