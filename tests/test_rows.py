from __future__ import annotations

from datetime import timedelta

from helpers import EPOCH_T0, T0, insight, insights, metric, rows
from tidegauge.operators import coerce_metrics, flag_rows, insight_columns, metrics_from_rows, split_valid
from tidegauge.schemas import INSIGHT_REQUIRED, INSIGHT_SCHEMA, METRIC_SCHEMA


def test_records_may_mix_number_kinds_and_lack_keys(spark):
    df = metrics_from_rows(
        spark,
        [
            {"device_id": "a", "timestamp": EPOCH_T0, "iops": 5, "latency": 2, "capacity_used": 1.5},
            {"_id": "", "device_id": "b", "timestamp": EPOCH_T0 + 0.25, "latency": 2.5},
            {"_id": 77, "device_id": None, "iops": 4200.0},
        ],
    )
    assert df.columns == METRIC_SCHEMA.names + ["event_time"]
    assert [df.schema[n].dataType for n in METRIC_SCHEMA.names] == [f.dataType for f in METRIC_SCHEMA]
    assert [tuple(r) for r in df.collect()] == [
        (None, "a", EPOCH_T0, 5, 2.0, 1.5, T0),
        (None, "b", EPOCH_T0 + 0.25, None, 2.5, None, T0 + timedelta(milliseconds=250)),
        ("77", None, None, 4200, None, None, None),
    ]


def test_no_records_is_an_empty_frame(spark):
    assert metrics_from_rows(spark, []).isEmpty()


def test_coerce_keeps_typed_frames_and_fills_missing_columns(spark):
    df = spark.createDataFrame([("a", 7, 3000000000)], "device_id string, timestamp int, iops long")
    row = coerce_metrics(df).first()
    assert (row.device_id, row.timestamp, row.iops, row.latency, row._id) == ("a", 7.0, None, None, None)


def test_split_names_the_first_failing_column(spark):
    loose = spark.createDataFrame(
        [
            ("ok", "a", "1.5", "1", "2", "3"),
            ("partial", "a", "1.5", None, None, None),
            ("nodev", None, "soon", "1", "2", "3"),
            ("notime", "a", None, "1", "2", "3"),
            ("badtime", "a", "NaN", "x", "2", "3"),
            ("badiops", "a", "1.5", "many", "2", "3"),
            ("badcap", "a", "1.5", "1", "2", "full"),
        ],
        "_id string, device_id string, timestamp string, iops string, latency string, capacity_used string",
    )
    good, refused = split_valid(loose)
    assert good.columns == loose.columns
    assert rows(good, "_id") == [("ok",), ("partial",)]
    assert dict(rows(refused, "_id", "reason")) == {
        "nodev": "device_id",
        "notime": "timestamp",
        "badtime": "timestamp",
        "badiops": "iops",
        "badcap": "capacity_used",
    }


def test_split_loses_nothing_on_insights(spark):
    frame = insights(spark, [insight("a"), insight("b", latency=None), insight(None)])
    good, refused = split_valid(frame, INSIGHT_REQUIRED, INSIGHT_SCHEMA)
    assert rows(good, "device_id") == [("a",)]
    assert rows(refused, "device_id", "reason") == [("b", "avg_latency"), (None, "device_id")]


def test_all_required(spark):
    df = metrics_from_rows(spark, [metric(), metric(latency=None)])
    _, refused = split_valid(df, METRIC_SCHEMA.names[1:])
    assert rows(refused, "reason") == [("latency",)]


def test_insight_columns_orders_and_types(spark):
    shuffled = insights(spark, [insight("a")]).select(*reversed(INSIGHT_SCHEMA.names))
    out = insight_columns(shuffled.withColumn("max_iops", shuffled.max_iops.cast("int")))
    assert out.schema == INSIGHT_SCHEMA


def test_milliseconds_become_seconds_and_pass_the_check(spark):
    rows_ = [("a", "1704067200500", "5", "1.5", "2"), ("a", "soon", "5", "1.5", "2")]
    loose = spark.createDataFrame(rows_, "device_id string, timestamp string, iops string, latency string, capacity_used string")
    good, bad = split_valid(loose, unit="ms")
    assert (good.count(), [r.reason for r in bad.collect()]) == (1, ["timestamp"])
    row = coerce_metrics(good, unit="ms").first()
    assert row.timestamp == 1704067200.5 and row.event_time.microsecond == 500000


def test_fractions_and_numbers_that_are_none_are_refused(spark):
    frame = spark.createDataFrame(
        [("a", 1.0, 4200.7, 1.0, 2.0), ("a", 1.0, 4200.0, float("nan"), 2.0), ("a", 1.0, 1.0, 1.0, float("inf"))],
        "device_id string, timestamp double, iops double, latency double, capacity_used double",
    )
    assert [r.reason for r in flag_rows(frame).collect()] == ["iops", "latency", "capacity_used"]
