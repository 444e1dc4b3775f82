"""The batch jobs: metrics in, insights table out, one plan and one write."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import epoch_micros, since, with_event_time, within
from ..functions.clock import EPOCH
from ..operators import process_metrics, window_metrics
from ..schemas import Thresholds
from ..sinks import write_checked
from ..sources import read_insights, scan_metrics


def scan(spark: SparkSession, metrics: str | DataFrame, start, end) -> DataFrame:
    """The range of the stored table at a path, or of a frame of valid metrics."""
    if isinstance(metrics, str):
        return scan_metrics(spark, metrics, start, end)
    timed = with_event_time(metrics)
    return timed.where(within(timed, start, end))


def moment_of(at) -> datetime:
    return EPOCH + timedelta(microseconds=epoch_micros(at))


def grid(start: datetime, end: datetime, minutes: float) -> Iterator[tuple[datetime, datetime]]:
    """The periods of a run; the last one is clipped."""
    while start < end:
        after = min(end, start + timedelta(minutes=minutes))
        yield start, after
        start = after


def run_range(
    spark: SparkSession,
    metrics: str | DataFrame,
    target: str,
    start,
    end,
    thresholds: Thresholds = Thresholds(),
    style: str = "value",
    rejects: str | None = None,
    **options,
) -> bool:
    """Summarise an explicit range as one period, whatever its length."""
    rows = scan(spark, metrics, start, end)
    insights = process_metrics(rows, start, end, thresholds, style)
    period = (moment_of(start), moment_of(end))
    return write_checked(insights, target, rejects, [period], **options)


def run_lookback(
    spark: SparkSession,
    metrics: str | DataFrame,
    target: str,
    as_of,
    hours_back: float = 24,
    minutes: float = 60,
    thresholds: Thresholds = Thresholds(),
    style: str = "value",
    rejects: str | None = None,
    **options,
) -> bool:
    """Summarise the last `hours_back` hours before `as_of` in periods of `minutes`."""
    start = since(as_of, hours_back)
    end = moment_of(as_of)
    rows = scan(spark, metrics, start, end)
    insights = window_metrics(rows, start, end, minutes, thresholds, style)
    return write_checked(insights, target, rejects, grid(start, end, minutes), **options)


def close_windows(
    spark: SparkSession,
    metrics: str | DataFrame,
    target: str,
    as_of,
    hours_back: float | None = None,
    minutes: float = 60,
    thresholds: Thresholds = Thresholds(),
    style: str = "value",
    rejects: str | None = None,
    **options,
) -> bool:
    """Bring the insights of a stopped stream up to `as_of` from the stored metrics.

    Without `hours_back`, from the last stored period on: the windows the stream left open.
    With it, all windows of so many hours, which also repairs those that missed late rows.
    Windows stay aligned to the clock, and whole periods are replaced.
    """
    end, width = moment_of(as_of), timedelta(minutes=minutes)
    if hours_back is None:
        last = read_insights(spark, target, ordered=False).agg(F.max(F.unix_micros("period_end"))).first()[0]
        if last is None:
            raise ValueError("no insights yet: name `hours_back`")
        start = EPOCH + timedelta(microseconds=last)
    else:
        start = since(as_of, hours_back)
    start = EPOCH + (start - EPOCH) // width * width
    end = EPOCH - (EPOCH - end) // width * width
    insights = window_metrics(scan(spark, metrics, start, end), start, end, minutes, thresholds, style)
    return write_checked(insights, target, rejects, grid(start, end, minutes), **options)
