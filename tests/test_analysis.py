from __future__ import annotations

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import insight, insights, plan_of, rows
from tidegauge.operators import capacity_forecast, enrich_insights, trend_vs_history
from tidegauge.schemas import INSIGHT_SCHEMA


def test_trend_labels(spark):
    frame = insights(
        spark,
        [
            insight("a", 0, 1000.0, 10.0, 100.0),
            insight("a", 1, 1100.0, 8.0, 100.0),
            insight("a", 30, 900.0, 9.4, 90.0),
            insight("a", 31, 1000.0, 12.0, 120.0),
            insight("zero", 0, 0.0, 1.0, 1.0),
            insight("zero", 1, 5.0, 1.04, 0.96),
        ],
    )
    out = trend_vs_history(frame)
    assert out.columns[: len(INSIGHT_SCHEMA)] == INSIGHT_SCHEMA.names
    a = [r for r in out.orderBy("period_start").collect() if r.device_id == "a"]
    assert [r.hist_iops for r in a] == [None, 1000.0, 1050.0, 1000.0]
    assert [r.hist_capacity_used for r in a] == [None, 100.0, 100.0, pytest.approx(290 / 3)]
    assert [r.delta_iops for r in a] == [None, 100.0, -150.0, 0.0]
    assert a[2].pct_capacity_used == pytest.approx(-0.1)
    assert [r.iops_trend for r in a] == ["new", "improving", "degrading", "stable"]
    assert [r.latency_trend for r in a] == ["new", "improving", "stable", "degrading"]
    assert [r.capacity_used_trend for r in a] == ["new", "stable", "shrinking", "growing"]
    zero = [r for r in out.orderBy("period_start").collect() if r.device_id == "zero"][1]
    assert (zero.pct_iops, zero.iops_trend) == (None, "stable")
    assert (zero.latency_trend, zero.capacity_used_trend) == ("stable", "stable")


def many(spark, hours=24 * 9):
    return insights(
        spark,
        [
            insight(d, h, iops=float((h * 37 + i * 11) % 400), latency=float(h % 7 + i), capacity=float(h))
            for i, d in enumerate("abc")
            for h in range(0, hours, i + 1)
        ],
    )


def test_trend_equals_a_window_over_the_whole_device(spark):
    frame = many(spark)
    past = Window.partitionBy("device_id").orderBy("period_start").rowsBetween(Window.unboundedPreceding, -1)
    plain = frame.select("device_id", "period_start", F.round(F.avg("avg_latency").over(past), 9).alias("h"))
    ours = trend_vs_history(frame).select("device_id", "period_start", F.round("hist_latency", 9).alias("h"))
    assert rows(ours) == rows(plain)


def test_since_returns_the_tail_of_the_full_answer(spark):
    frame = many(spark)
    begin = "2024-01-07 05:00:00"
    full = trend_vs_history(frame).where(F.col("period_start") >= begin)
    assert rows(trend_vs_history(frame, since=begin)) == rows(full)


def test_rows_are_shuffled_by_device_and_day(spark):
    plan = plan_of(trend_vs_history(many(spark)))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # only the per-day sums, one row per device and day, are brought together by device
    by_device = re.findall(r"hashpartitioning\(device_id#\d+, \d+\)", plan)
    by_day = re.findall(r"hashpartitioning\(device_id#\d+, \S+#\d+, \d+\)", plan)
    assert len(by_device) == 1 and len(by_day) >= 2


def test_enrich_keeps_unknown_devices_and_grades(spark):
    devices = spark.createDataFrame(
        [("a", "north", "m1", 1000.0)],
        "device_id string, site string, model string, capacity_total double",
    )
    frame = insights(
        spark,
        [
            insight("a", 0, 5000.0, 5.0),
            insight("a", 1, 5000.0, 10.5),
            insight("a", 2, 499.0, 1.0),
            insight("b", 3, 4999.0, 5.0),
            insight("b", 4, 500.0, 10.0),
        ],
    )
    out = enrich_insights(frame, devices)
    assert out.columns == INSIGHT_SCHEMA.names + ["site", "model", "capacity_total", "tier"]
    assert [(r.site, r.tier) for r in out.orderBy("period_start").collect()] == [
        ("north", "gold"), ("north", "bronze"), ("north", "bronze"), (None, "silver"), (None, "silver"),
    ]
    strict = enrich_insights(frame, devices, bronze_iops=6000)
    assert {r.tier for r in strict.collect()} == {"bronze"}


def test_forecast(spark):
    frame = insights(
        spark,
        [insight("up", h, capacity=700.0 + 10 * h) for h in range(4)]
        + [insight("down", h, capacity=700.0 - h) for h in range(4)]
        + [insight("full", h, capacity=800.0 + h) for h in range(2)]
        + [insight("once")],
    )
    out = {r.device_id: r for r in capacity_forecast(frame).collect()}
    assert set(out) == {"up", "down", "full"}
    assert out["up"].slope_per_hour == pytest.approx(10.0)
    assert out["up"].latest_capacity == 730.0
    assert out["up"].hours_to_threshold == pytest.approx(7.0)
    assert out["down"].hours_to_threshold is None
    assert out["full"].hours_to_threshold == 0.0
