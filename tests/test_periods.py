from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

import pytest

from helpers import EPOCH_T0, T0, metric, plan_of, rows
from tidegauge.functions import within
from tidegauge.operators import metrics_from_rows, process_metrics, window_metrics
from tidegauge.plans.given_tables import metrics
from tidegauge.schemas import INSIGHT_SCHEMA

SF_DIR = "/root/testdata/sf0.001"


def settled(df):
    """Rows with sums in any order made comparable."""
    return sorted(
        tuple(round(v, 9) if isinstance(v, float) else str(v) for v in row) for row in df.collect()
    )


def test_summary_of_one_period(spark):
    df = metrics_from_rows(
        spark,
        [
            metric("a", 0, 100, 1.0, 10.0),
            metric("a", 10, 300, 4.0, 40.0),
            metric("a", 20, None, None, None),
            metric("b", 30, 7, 2.0, 3.0),
        ],
    )
    out = process_metrics(df, T0, "2024-01-01 05:00:00")
    assert out.schema.simpleString() == INSIGHT_SCHEMA.simpleString()
    a, b = sorted(out.collect(), key=lambda r: r.device_id)
    assert (a.period_start, a.period_end) == (T0, T0 + timedelta(hours=5))
    assert (a.avg_iops, a.avg_latency, a.avg_capacity_used) == (200.0, 2.5, 25.0)
    assert (a.max_iops, a.max_latency, a.max_capacity_used) == (300.0, 4.0, 40.0)
    assert (a.min_iops, a.min_latency, a.min_capacity_used) == (100.0, 1.0, 10.0)
    assert (a.metrics_count, b.metrics_count) == (3, 1)


def test_null_device_is_a_group_of_its_own(spark):
    df = metrics_from_rows(spark, [metric(None, 1), metric(None, 2), metric("a", 3)])
    assert rows(process_metrics(df, T0, T0), "device_id", "metrics_count") == [("a", 1), (None, 2)]


def test_empty_input_gives_no_rows(spark):
    empty = metrics_from_rows(spark, [])
    assert process_metrics(empty, T0, T0).isEmpty()
    assert window_metrics(empty, T0, EPOCH_T0 + 3600).isEmpty()


def test_period_bounds_belong_to_the_next_period(spark):
    df = metrics_from_rows(spark, [metric(at=s) for s in (-0.000001, 0, 3599.999999, 3600, 7199.5, 9000, 9900)])
    out = window_metrics(df, T0, EPOCH_T0 + 9000)
    assert rows(out, "period_start", "period_end", "metrics_count") == [
        (T0, T0 + timedelta(hours=1), 2),
        (T0 + timedelta(hours=1), T0 + timedelta(hours=2), 2),
    ]
    late = window_metrics(df, T0, EPOCH_T0 + 9000.5)
    assert rows(late, "period_start", "period_end")[-1] == (
        T0 + timedelta(hours=2),
        T0 + timedelta(hours=2, minutes=30, milliseconds=500),
    )


@pytest.mark.parametrize(
    ("start", "hours", "minutes"),
    [(datetime(2024, 1, 5), 6.0, 60), (1704068434.5, 5.4, 60), (1704500000.1, 30.0, 95), (1705000000.0, 1.0, 240)],
)
def test_one_pass_equals_a_loop_over_slices(spark, start, hours, minutes):
    df = metrics(spark, SF_DIR)
    begin = start if isinstance(start, datetime) else T0 + timedelta(seconds=start - EPOCH_T0)
    end = begin + timedelta(hours=hours)
    slices, at = [], begin
    while at < end:
        upto = min(at + timedelta(minutes=minutes), end)
        slices.append(process_metrics(df.where(within(df, at, upto)), at, upto))
        at = upto
    looped = reduce(lambda a, b: a.unionByName(b), slices)
    assert settled(window_metrics(df, begin, end, minutes)) == settled(looped)


def test_minutes_must_be_positive(spark):
    with pytest.raises(ValueError):
        window_metrics(metrics_from_rows(spark, []), T0, T0, minutes=0)


def test_aggregates_before_one_shuffle(spark):
    plan = plan_of(window_metrics(metrics(spark, SF_DIR), T0, "2024-01-31"))
    assert plan.count("Exchange") == plan.count("hashpartitioning") * 2  # listed in tree and detail
    assert "partial_avg" in plan and "SortAggregate" not in plan and "Python" not in plan
    assert "GreaterThanOrEqual(ts" in plan
