from __future__ import annotations

from datetime import timedelta

import pytest

from helpers import EPOCH_T0, T0, metric, plan_of, rows
from test_streaming import drop_file, ingest
from tidegauge.operators import metrics_from_rows
from tidegauge.plans import run_lookback, run_range
from tidegauge.session import setting, shared_dir
from tidegauge.sinks import ensure_insights_table
from tidegauge.sources import load_metrics, read_insights


@pytest.fixture
def table(spark, tmp_path):
    data = [metric("a", s) for s in (0, 1800, 3600, 5400)] + [metric("gap", 10, latency=None)]
    drop_file(tmp_path / "in", "1", data)
    return ingest(spark, tmp_path / "in", tmp_path)


def test_lookback_cuts_periods_from_the_run_start(spark, table, tmp_path):
    target, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    as_of = T0 + timedelta(seconds=5500)
    for _ in range(2):
        assert run_lookback(spark, table, target, as_of, hours_back=1.5, minutes=60, rejects=rejects)
    out = read_insights(spark, target)
    first = T0 + timedelta(seconds=100)
    assert rows(out, "device_id", "period_start", "period_end", "metrics_count") == [
        ("a", first, first + timedelta(hours=1), 2),
        ("a", first + timedelta(hours=1), as_of, 1),
    ]


def test_range_is_one_period_and_null_averages_are_set_aside(spark, table, tmp_path):
    target, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    assert run_range(spark, table, target, T0, EPOCH_T0 + 5400, rejects=rejects)
    assert rows(read_insights(spark, target), "device_id", "metrics_count") == [("a", 3)]
    assert rows(spark.read.parquet(rejects), "device_id", "reason") == [("gap", "avg_latency")]


def test_rejects_are_replaced_with_their_period_and_never_lost(spark, table, tmp_path):
    target, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    for _ in range(2):
        run_range(spark, table, target, T0, EPOCH_T0 + 5400, rejects=rejects)
    assert spark.read.parquet(rejects).count() == 1
    run_range(spark, table, target, T0, EPOCH_T0 + 5400)
    assert spark.read.parquet(f"{target}-rejects").count() == 1


def test_a_table_without_a_folder_for_rejects_is_left_as_it_was(spark, table):
    ensure_insights_table(spark, "checked_insights")
    with pytest.raises(ValueError, match="1 insights"):
        run_range(spark, table, "checked_insights", T0, EPOCH_T0 + 5400)
    assert spark.table("checked_insights").count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_run_whose_insights_are_all_refused_keeps_them(spark, tmp_path, adaptive):
    frame = metrics_from_rows(spark, [metric(d, s, latency=None) for d in "ab" for s in (0, 4000)])
    target = str(tmp_path / "out")
    with setting(spark, "spark.sql.adaptive.enabled", adaptive):
        assert run_lookback(spark, frame, target, T0 + timedelta(hours=2), hours_back=2) is False
    assert spark.read.parquet(f"{target}-rejects").count() == 4


def test_a_rerun_leaves_what_the_data_now_say(spark, tmp_path):
    target = str(tmp_path / "out")
    as_of = T0 + timedelta(hours=3)
    first = [metric("a", 0), metric("a", 3600), metric("a", 7200, latency=None)]
    assert run_lookback(spark, metrics_from_rows(spark, first), target, as_of, hours_back=3)
    other = metrics_from_rows(spark, [metric("a", 9 * 3600)])
    assert run_lookback(spark, other, target, T0 + timedelta(hours=10), hours_back=1)
    again = [metric("a", 0), metric("a", 7200, latency=2.0)]  # one hour withdrawn, one repaired
    assert run_lookback(spark, metrics_from_rows(spark, again), target, as_of, hours_back=3)
    hours = [r.period_start.hour for r in read_insights(spark, target).collect()]
    assert sorted(hours) == [0, 2, 9]
    assert not list((tmp_path / "out-rejects").rglob("*.parquet"))


def test_metrics_may_be_a_frame(spark, tmp_path):
    frame = metrics_from_rows(spark, [metric("a", -1), metric("a", 0), metric("a", 60)])
    target = str(tmp_path / "out")
    assert run_range(spark, frame, target, T0, EPOCH_T0 + 60)
    assert rows(read_insights(spark, target), "device_id", "metrics_count") == [("a", 1)]


def test_empty_range_writes_nothing(spark, table, tmp_path):
    assert run_range(spark, table, str(tmp_path / "out"), EPOCH_T0 - 99, EPOCH_T0) is False


def test_other_batch_formats(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "1.json").write_text(
        '{"device_id":"a","timestamp":1704067200,"latency":2}\n{"device_id":"b"}\n'
    )
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "1.csv").write_text(
        "_id,device_id,timestamp,iops,latency,capacity_used\n1,a,1704067200.5,x,2,3\n"
    )
    out = load_metrics(spark, str(tmp_path / "j"), "json")
    assert rows(out, "device_id", "event_time", "latency") == [("a", T0, 2.0), ("b", None, None)]
    out = load_metrics(spark, str(tmp_path / "c"), "csv", header="true")
    assert rows(out, "_id", "timestamp", "iops") == [("1", EPOCH_T0 + 0.5, None)]


def test_a_range_is_handed_to_the_source(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = spark.createDataFrame(
        [("a", EPOCH_T0 + s, 1) for s in (-1.0, 0.0, 59.5, 60.0)],
        "device_id string, timestamp double, iops long",
    )
    raw.write.parquet(path)
    out = load_metrics(spark, path, start=T0, end=EPOCH_T0 + 60)
    assert sorted(r.timestamp - EPOCH_T0 for r in out.collect()) == [0.0, 59.5]
    assert "GreaterThanOrEqual(timestamp" in plan_of(out) and "LessThan(timestamp" in plan_of(out)
    in_millis = raw.withColumn("timestamp", raw.timestamp * 1000)
    in_millis.write.parquet(path + "-ms")
    assert load_metrics(spark, path + "-ms", unit="ms", start=T0, end=EPOCH_T0 + 60).count() == 2
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "1.json").write_text('{"timestamp":1704067200}\n{"timestamp":"soon"}\n')
    assert load_metrics(spark, str(tmp_path / "j"), "json", start=T0).count() == 1


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(root) and a != b
