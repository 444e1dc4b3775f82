"""Random small inputs against plain Python."""

from __future__ import annotations

from collections import defaultdict
from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import EPOCH_T0, T0, insight, insights, metric
from tidegauge.operators import (
    device_kpis,
    device_list,
    explode_alerts,
    hourly_trends,
    metrics_from_rows,
    recent_metrics,
    trend_vs_history,
    window_metrics,
)

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

metric_rows = st.lists(
    st.builds(
        metric,
        device=st.sampled_from(["a", "b", "c", None]),
        at=st.one_of(st.none(), st.integers(-10_000_000, 40_000_000).map(lambda m: m / 1000)),
        iops=st.one_of(st.none(), st.integers(100, 1000)),
        latency=st.one_of(st.none(), st.integers(10, 150).map(lambda v: v / 10)),
        capacity=st.one_of(st.none(), st.integers(7000, 9000).map(lambda v: v / 10)),
    ),
    max_size=60,
)


def mean(values):
    held = [v for v in values if v is not None]
    return round(sum(held) / len(held), 6) if held else None


def near(value):
    return None if value is None else round(value, 6)


@few
@given(metric_rows, st.sampled_from([7, 60, 95]), st.integers(1, 30_000))
def test_windows(spark, data, minutes, length):
    groups = defaultdict(list)
    for row in data:
        at = row["timestamp"]
        if at is not None and 0 <= at - EPOCH_T0 < length:
            groups[row["device_id"], int((at - EPOCH_T0) // (minutes * 60))].append(row)
    expected = {}
    for (device, slot), members in groups.items():
        start = T0 + timedelta(minutes=slot * minutes)
        end = min(start + timedelta(minutes=minutes), T0 + timedelta(seconds=length))
        latency, iops, capacity = (
            [r[m] for r in members] for m in ("latency", "iops", "capacity_used")
        )
        held = [v for v in latency if v is not None]
        alerts = []
        if held and sum(held) / len(held) > 10.0 + 1e-9:
            alerts.append("latency")
        if mean(iops) is not None and mean(iops) < 500:
            alerts.append("IOPS")
        if mean(capacity) is not None and mean(capacity) > 800.0:
            alerts.append("capacity")
        expected[device, start] = (
            end, len(members), mean(iops), mean(latency), mean(capacity),
            max(held, default=None), min(held, default=None), alerts,
        )
    out = window_metrics(metrics_from_rows(spark, data), T0, EPOCH_T0 + length, minutes)
    # an average of exactly 10.0 may come out a last bit higher
    exact = {k for k, v in expected.items() if v[3] == 10.0}
    words = ("latency", "IOPS", "capacity")
    got = {
        (r.device_id, r.period_start): (
            r.period_end, r.metrics_count, near(r.avg_iops), near(r.avg_latency),
            near(r.avg_capacity_used), r.max_latency, r.min_latency,
            [w for a in r.alerts for w in words if w in a],
        )
        for r in out.collect()
    }
    assert got.keys() == expected.keys()
    for key in got.keys() - exact:
        assert got[key] == expected[key]


@few
@given(metric_rows)
def test_hours(spark, data):
    groups = defaultdict(list)
    for row in data:
        if row["timestamp"] is not None and row["device_id"] is not None:
            hour = T0 + timedelta(hours=(row["timestamp"] - EPOCH_T0) // 3600)
            groups[row["device_id"], hour].append(row)
    got = {(r.device_id, r.hour): (near(r.iops), near(r.latency)) for r in
           hourly_trends(metrics_from_rows(spark, data)).collect()}
    assert got == {k: (mean([r["iops"] for r in v]), mean([r["latency"] for r in v])) for k, v in groups.items()}


@few
@given(metric_rows, st.integers(1, 70))
def test_recent(spark, data, limit):
    for number, row in enumerate(data):
        row["_id"] = f"{number:03d}"
    timed = sorted((r for r in data if r["timestamp"] is not None), key=lambda r: (r["timestamp"], r["_id"]), reverse=True)
    blank = sorted((r for r in data if r["timestamp"] is None), key=lambda r: r["_id"], reverse=True)
    got = [r._id for r in recent_metrics(metrics_from_rows(spark, data), limit).collect()]
    assert got == [r["_id"] for r in timed + blank][:limit]


periods = st.lists(
    st.tuples(st.sampled_from("abc"), st.integers(0, 120), st.integers(1, 2000)),
    max_size=80,
    unique_by=lambda t: t[:2],
)


@few
@given(periods)
def test_insight_views(spark, data):
    frame = insights(spark, [insight(d, h, float(v), alerts=["x"] * (v % 3)) for d, h, v in data])
    by_device = defaultdict(list)
    for device, hour, value in sorted(data, key=lambda t: t[1]):
        by_device[device].append((hour, float(value)))

    kpis = {r.device_id: (r.latest_iops, r.delta_iops) for r in device_kpis(frame, display=False).collect()}
    assert kpis == {
        d: (rows[-1][1], rows[-1][1] - rows[0][1] if len(rows) > 1 else None) for d, rows in by_device.items()
    }
    listed = [r.device_id for r in device_list(frame).collect()]
    assert listed == sorted(by_device, key=lambda d: (-by_device[d][-1][0], d))
    assert explode_alerts(frame).count() == sum(v % 3 for _, _, v in data)

    expected = {}
    for device, rows in by_device.items():
        for i, (hour, _) in enumerate(rows):
            expected[device, T0 + timedelta(hours=hour)] = mean([v for _, v in rows[:i]])
    got = {(r.device_id, r.period_start): near(r.hist_iops) for r in trend_vs_history(frame).collect()}
    assert got == expected
