"""Small hand-made frames."""

from __future__ import annotations

import contextlib
import io
from datetime import datetime, timedelta

from tidegauge.schemas import INSIGHT_SCHEMA

T0 = datetime(2024, 1, 1)
EPOCH_T0 = 1704067200.0


def metric(device="a", at=0.0, iops=1000, latency=5.0, capacity=500.0, id_=None):
    """A metric `at` seconds after T0."""
    return {
        "_id": id_,
        "device_id": device,
        "timestamp": None if at is None else EPOCH_T0 + at,
        "iops": iops,
        "latency": latency,
        "capacity_used": capacity,
    }


def insight(device="a", hour=0, iops=1000.0, latency=5.0, capacity=500.0, alerts=(), hours=1, count=3):
    start = T0 + timedelta(hours=hour)
    return (
        device, start, start + timedelta(hours=hours),
        iops, latency, capacity, iops, latency, capacity, iops, latency, capacity,
        count, list(alerts) if alerts is not None else None,
    )


def insights(spark, rows):
    return spark.createDataFrame(rows, INSIGHT_SCHEMA)


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows(df, *names):
    """Rows as sorted tuples of the named columns (all by default)."""
    names = names or df.columns
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)
