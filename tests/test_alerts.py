from __future__ import annotations

from datetime import timedelta

import pytest

from helpers import T0, insight, insights, rows
from tidegauge.operators import alert_counts, explode_alerts, with_alerts
from tidegauge.schemas import Thresholds


def averages(spark, *values):
    return spark.createDataFrame(values, "avg_latency double, avg_iops double, avg_capacity_used double")


def test_limits_are_strict_and_null_fires_nothing(spark):
    df = averages(spark, (10.0, 500.0, 800.0), (None, None, None))
    assert [r.alerts for r in with_alerts(df).collect()] == [[], []]


def test_texts_and_order(spark):
    df = averages(spark, (10.5, 499.5, 800.25))
    assert with_alerts(df).first().alerts == [
        "High average latency detected: 10.5ms (threshold: 10.0ms)",
        "Low average IOPS detected: 499.5 (threshold: 500)",
        "High capacity usage detected: 800.25GB (threshold: 800.0GB)",
    ]
    assert with_alerts(df, style="threshold").first().alerts == [
        "High average latency detected: > 10.0ms",
        "Low average IOPS detected: < 500",
        "High capacity usage detected: > 800.0GB",
    ]


def test_only_what_fired_is_kept(spark):
    df = averages(spark, (1.0, 1.0, 900.0))
    assert with_alerts(df, style="threshold").first().alerts == [
        "Low average IOPS detected: < 500",
        "High capacity usage detected: > 800.0GB",
    ]


def test_thresholds_are_parameters(spark):
    limits = Thresholds(high_latency=3.5, low_iops=10, high_capacity=50.0)
    df = averages(spark, (4.0, 9.0, 40.0))
    assert with_alerts(df, limits, "threshold").first().alerts == [
        "High average latency detected: > 3.5ms",
        "Low average IOPS detected: < 10",
    ]
    with pytest.raises(ValueError):
        with_alerts(df, style="loud")


def test_explode_array_and_json_text_agree(spark):
    frame = insights(
        spark,
        [insight("a", 0, alerts=["x", "", None]), insight("b", 1, alerts=[]), insight("c", 2, alerts=["x", "y"])],
    )
    expected = [
        (T0 + timedelta(hours=1), "x", "a"),
        (T0 + timedelta(hours=3), "x", "c"),
        (T0 + timedelta(hours=3), "y", "c"),
    ]
    text = frame.selectExpr("* except (alerts)", "to_json(alerts) as alerts")
    for form in (frame, text):
        assert rows(explode_alerts(form), "timestamp", "alert", "device_id") == expected
    assert rows(alert_counts(frame)) == [("x", 2), ("y", 1)]


def test_odd_alert_texts(spark):
    texts = ['["a","",null]', "[]", "bad", None, "null", '"abc"', '{"a":1}', "", '["b"']
    df = spark.createDataFrame([(T0, t, "d") for t in texts], "period_end timestamp, alerts string, device_id string")
    assert rows(explode_alerts(df), "alert") == [("a",)]


def test_null_array_gives_no_rows(spark):
    assert explode_alerts(insights(spark, [insight(alerts=None)])).isEmpty()
