from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import T0, insight, insights, plan_of, rows
from tidegauge.schemas import INSIGHT_SCHEMA, INSIGHT_TABLE_SCHEMA
from tidegauge.sinks import ensure_insights_table, insight_rows, jdbc_rows, jdbc_write_options, write_insights
from tidegauge.sources import jdbc_read_options, read_insights
from tidegauge.sources.insights import newest_versions


def test_rerun_replaces_only_its_periods(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [insight("a", 0, 1.0), insight("b", 0, 2.0), insight("a", 1, 3.0)]
    assert write_insights(insights(spark, first), path)
    assert write_insights(insights(spark, first), path)
    assert read_insights(spark, path).count() == 3
    assert write_insights(insights(spark, [insight("a", 0, 9.0)]), path)
    out = read_insights(spark, path)
    assert out.schema == INSIGHT_SCHEMA
    assert rows(out, "device_id", "period_start", "avg_iops") == [
        ("a", T0, 9.0),
        ("a", T0 + timedelta(hours=1), 3.0),
    ]


def test_same_start_with_another_end_is_another_period(spark, tmp_path):
    path = str(tmp_path / "t")
    write_insights(insights(spark, [insight("a", 0)]), path)
    write_insights(insights(spark, [insight("a", 0, hours=2)]), path)
    assert read_insights(spark, path).count() == 2


def test_append_adds_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for value in (1.0, 2.0):
        write_insights(insights(spark, [insight("a", 0, value)]), path, mode="append")
    assert rows(read_insights(spark, path), "avg_iops") == [(1.0,), (2.0,)]
    assert rows(read_insights(spark, path, latest_only=True), "avg_iops") == [(2.0,)]
    with pytest.raises(ValueError):
        write_insights(insights(spark, []), path, mode="merge")


def test_nothing_to_write(spark, tmp_path):
    path = str(tmp_path / "t")
    write_insights(insights(spark, [insight("a", 0)]), path)
    none = insights(spark, [insight("a", 0)]).where(F.col("avg_iops") < 0)
    assert write_insights(none, path) is False
    assert write_insights(insights(spark, []), path) is False
    assert read_insights(spark, path).count() == 1


def test_read_back_alerts_and_order(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = [insight("b", 1, alerts=["x"]), insight("a", 1), insight("a", 0), insight("a", 2, alerts=None)]
    write_insights(insights(spark, frame), path)
    out = read_insights(spark, path, ordered=True).collect()
    assert [(r.device_id, r.period_start.hour) for r in out] == [("a", 2), ("a", 1), ("b", 1), ("a", 0)]
    assert [r.alerts for r in out] == [None, [], ["x"], []]


def test_lookback_prunes_days(spark, tmp_path):
    path = str(tmp_path / "t")
    write_insights(insights(spark, [insight("a", h) for h in (0, 23, 24, 47, 71)]), path)
    as_of = T0 + timedelta(hours=72)
    out = read_insights(spark, path, 48, as_of, ordered=False)
    # period_end >= as_of - 48 h, bound included
    assert rows(out, "period_start") == [(T0 + timedelta(hours=h),) for h in (23, 24, 47, 71)]
    assert "PartitionFilters: [isnotnull(period_date" in plan_of(out)
    assert read_insights(spark, path, 1, as_of).count() == 1
    with pytest.raises(ValueError):
        read_insights(spark, path, hours=3)


def test_stored_row_layout(spark):
    row = insight_rows(insights(spark, [insight("a", 23)])).first()
    assert row.period_date == date(2024, 1, 2)
    assert row.period_key == "1704150000000000-1704153600000000"
    assert isinstance(row.created_at, datetime)


def test_catalog_table(spark):
    ensure_insights_table(spark, "device_insights")
    ensure_insights_table(spark, "device_insights")
    table = spark.table("device_insights")
    assert table.columns == INSIGHT_TABLE_SCHEMA.names
    for _ in range(2):
        assert write_insights(insights(spark, [insight("a", 0, alerts=["x"]), insight("a", 1)]), "device_insights")
    write_insights(insights(spark, [insight("b", 1)]), "device_insights")
    out = read_insights(spark, "device_insights", 24, T0 + timedelta(hours=5))
    assert [(r.device_id, r.alerts) for r in out.collect()] == [("b", []), ("a", ["x"])]


def test_jdbc_rows_carry_json(spark):
    out = jdbc_rows(insights(spark, [insight(alerts=["x", 'say "y"']), insight(hour=1)])).orderBy("period_start")
    assert out.columns == INSIGHT_SCHEMA.names + ["created_at"]
    assert [r.alerts for r in out.collect()] == ['["x","say \\"y\\""]', "[]"]


def test_jdbc_options():
    write = jdbc_write_options("device_insights", user="u", password="p", driver="d")
    assert write == {
        "dbtable": "device_insights", "numPartitions": "8", "batchsize": "10000",
        "user": "u", "password": "p", "driver": "d",
    }
    read = jdbc_read_options("t", T0, T0 + timedelta(hours=1), partitions=4, user="u")
    assert read["partitionColumn"] == "period_end" and read["numPartitions"] == "4"
    assert (read["lowerBound"], read["upperBound"]) == ("2024-01-01 00:00:00", "2024-01-01 01:00:00")
    assert "partitionColumn" not in jdbc_read_options("t")


def test_newest_version_wins_and_copies_are_cut_before_the_shuffle(spark):
    frame = insights(spark, [insight("a", 0, 1.0), insight("a", 0, 2.0), insight("b", 0, 5.0)])
    stamped = frame.withColumn("created_at", F.timestamp_seconds(F.col("avg_iops")))
    out = newest_versions(stamped)
    assert rows(out, "device_id", "avg_iops") == [("a", 2.0), ("b", 5.0)]
    assert "WindowGroupLimit" in plan_of(out)


def test_a_table_over_a_folder_shows_its_insights(spark, tmp_path):
    path = str(tmp_path / "stored")
    write_insights(insights(spark, [insight("a", 0), insight("b", 1)]), path)
    ensure_insights_table(spark, "placed_insights", path)
    assert spark.table("placed_insights").count() == 2
