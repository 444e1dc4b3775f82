from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import EPOCH_T0, T0, plan_of
from tidegauge.functions import epoch_micros, epoch_seconds, since, utc_date, with_event_time, within


def test_moments_name_the_same_instant():
    zoned = datetime(2024, 1, 1, 2, tzinfo=timezone(timedelta(hours=2)))
    for at in (T0, zoned, "2024-01-01 00:00:00", "2024-01-01T00:00:00+00:00", EPOCH_T0, 1704067200):
        assert epoch_micros(at) == 1704067200000000
        assert epoch_seconds(at) == EPOCH_T0
    assert since(T0, 24) == datetime(2023, 12, 31, tzinfo=timezone.utc)


MICROS_2006, MICROS_2037 = 1136073600000000, 2114380800000000


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(MICROS_2006, MICROS_2037), min_size=200, max_size=200))
def test_epoch_doubles_give_back_their_microsecond(spark, micros):
    seconds = spark.createDataFrame([(m, m / 1e6) for m in micros], "m long, timestamp double")
    wrong = with_event_time(seconds).where(F.unix_micros("event_time") != F.col("m"))
    assert wrong.isEmpty()


def test_milliseconds_and_guard(spark):
    df = spark.createDataFrame([(1704067200250.0,)], "timestamp double")
    timed = with_event_time(df, unit="ms")
    assert timed.first().event_time == T0 + timedelta(milliseconds=250)
    assert with_event_time(timed, unit="s") is timed
    with pytest.raises(ValueError):
        with_event_time(df, unit="minutes")


def test_no_instant_for_nonsense(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e300,), (None,)], "timestamp double")
    assert [r.event_time for r in with_event_time(df).collect()] == [None] * 4


def test_within_is_half_open(spark):
    df = spark.createDataFrame([(EPOCH_T0 + s,) for s in (-1.0, 0.0, 59.5, 60.0)], "timestamp double")
    for frame in (df, with_event_time(df)):
        kept = frame.where(within(frame, T0, EPOCH_T0 + 60))
        assert sorted(r.timestamp - EPOCH_T0 for r in kept.collect()) == [0.0, 59.5]
    assert df.where(within(df)).count() == 4


def test_utc_date_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.range(1).select(utc_date(F.timestamp_seconds(F.lit(EPOCH_T0 + 86399.5))).alias("d"))
        assert df.first().d == date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_range_predicate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = spark.createDataFrame([(EPOCH_T0, 1)], "timestamp double, iops int")
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_of(stored.where(within(stored, T0, EPOCH_T0 + 60)))
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan
