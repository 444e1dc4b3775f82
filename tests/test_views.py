from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from helpers import EPOCH_T0, T0, insight, insights, metric, plan_of, rows
from tidegauge.operators import (
    device_insights,
    device_kpis,
    device_list,
    device_statistics,
    hourly_trends,
    insight_series,
    live_lines,
    live_series,
    metrics_count,
    metrics_from_rows,
    recent_display,
    recent_metrics,
    scan_lookback,
)


def test_recent_is_ordered_and_ties_break_by_id(spark):
    df = metrics_from_rows(
        spark, [metric(at=1, id_="x"), metric(at=3, id_="a"), metric(at=3, id_="b"), metric(at=2, id_="y")]
    )
    assert [r._id for r in recent_metrics(df, 3).collect()] == ["b", "a", "y"]
    assert "TakeOrderedAndProject" in plan_of(recent_metrics(df, 3))
    assert live_series(df, 2).columns == ["device_id", "event_time", "iops", "latency", "capacity_used"]


def test_display_titles(spark):
    shown = recent_display(metrics_from_rows(spark, [metric(at=s) for s in range(20)]))
    assert shown.columns == ["Device ID", "Timestamp", "IOPS", "Latency (ms)", "Capacity Used (GB)"]
    assert shown.count() == 10


def test_lookback_keeps_the_bound_and_what_lies_ahead(spark):
    df = metrics_from_rows(spark, [metric(at=s) for s in (-3600.5, -3600, 0, 99999)])
    kept = scan_lookback(df, 1, T0)
    assert sorted(r.timestamp - EPOCH_T0 for r in kept.collect()) == [-3600.0, 0.0, 99999.0]


def test_hours_follow_the_clock_and_null_devices_drop_out(spark):
    df = metrics_from_rows(
        spark,
        [metric("a", 3599.9, 10, 1.0, 1.0), metric("a", 3600, 20, 2.0, 2.0), metric("a", 5000, 40, 4.0, None),
         metric(None, 10), metric("b", None)],
    )
    assert rows(hourly_trends(df)) == [
        ("a", T0, 10.0, 1.0, 1.0),
        ("a", T0 + timedelta(hours=1), 30.0, 3.0, 2.0),
    ]


def test_statistics(spark):
    df = metrics_from_rows(spark, [metric("a", 0, 10, 1.0, 5.0), metric("a", 1, 30, 3.0, 7.0), metric(None, 2)])
    out = device_statistics(df)
    assert out.columns == ["device_id"] + [
        f"{k}_{m}" for m in ("iops", "latency", "capacity_used") for k in ("avg", "min", "max")
    ]
    assert rows(out) == [("a", 20.0, 10.0, 30.0, 2.0, 1.0, 3.0, 6.0, 5.0, 7.0)]
    shown = device_statistics(df, display=True)
    assert shown.columns[:4] == ["Device ID", "Avg IOPS", "Min IOPS", "Max IOPS"]
    assert shown.columns[-1] == "Max Capacity" and rows(shown) == rows(out)


def test_count(spark):
    assert metrics_count(metrics_from_rows(spark, [metric(), metric(None, None)])).first().metrics_total == 2


def test_kpis_compare_latest_with_oldest(spark):
    frame = insights(
        spark,
        [
            insight("a", 0, 1000.0, 5.0, 100.0),
            insight("a", 1, 9999.0, 99.0, 999.0),
            insight("a", 2, 1502.5, 4.125, 130.555),
            insight("solo", 0, 10.5, 1.0, 2.0),
        ],
    )
    out = {r.device_id: r for r in device_kpis(frame).collect()}
    a, solo = out["a"], out["solo"]
    assert (a.latest_latency, a.delta_latency) == (4.12, -0.88)
    assert (a.latest_iops, a.delta_iops) == (1502.0, 502.0)
    assert (a.latest_capacity, a.delta_capacity) == (130.56, 30.56)
    assert (solo.latest_iops, solo.delta_iops, solo.delta_latency, solo.delta_capacity) == (10.0, None, None, None)
    raw = {r.device_id: r for r in device_kpis(frame, display=False).collect()}["a"]
    assert (raw.latest_latency, raw.delta_iops) == (4.125, 502.5)


def test_kpi_ties_on_the_end_go_to_the_later_start(spark):
    frame = insights(
        spark, [insight("a", 0, latency=1.0, hours=3), insight("a", 2, latency=7.0), insight("a", 1, latency=3.0, hours=2)]
    )
    row = device_kpis(frame).first()
    assert (row.latest_latency, row.delta_latency) == (7.0, 6.0)


def test_kpis_hash_aggregate(spark):
    plan = plan_of(device_kpis(insights(spark, [insight()])))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_devices_by_last_report(spark):
    frame = insights(spark, [insight("b", 0), insight("c", 5), insight("a", 0), insight("b", 5), insight("a", 2)])
    assert [r.device_id for r in device_list(frame).collect()] == ["b", "c", "a"]


def test_one_device(spark):
    frame = insights(spark, [insight("a", 2, 3.0), insight("b", 1), insight("a", 0, 1.0), insight("a", 1, 2.0)])
    assert device_insights(frame, "a").count() == 3
    series = insight_series(frame, "a")
    assert series.columns == ["period_end", "avg_iops", "avg_latency", "avg_capacity_used"]
    assert [r.avg_iops for r in series.collect()] == [1.0, 2.0, 3.0]


def test_lines(spark):
    df = metrics_from_rows(spark, [metric("dev02", 1, 4200, 11.25, 640.5), metric("dev01", 0)])
    tail = df.withColumn("received_at", df.event_time)
    assert [r.line for r in live_lines(tail, 1).collect()] == [
        "**00:00:01** - Device: dev02, IOPS: 4200, Latency: 11.25ms, Capacity: 640.5GB"
    ]


def test_a_line_of_missing_measures(spark):
    tail = metrics_from_rows(spark, [metric("a", 0, iops=None, latency=None)]).withColumn("received_at", F.col("event_time"))
    assert [r.line for r in live_lines(tail).collect()] == [
        "**00:00:00** - Device: a, IOPS: None, Latency: Nonems, Capacity: 500.0GB"
    ]
