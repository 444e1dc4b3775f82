"""Time handling.

The stored `timestamp` is epoch seconds as a double. `event_time` is the same instant as a
Spark timestamp. For the years 2005 to 2038 a double of this size is closer to its
microsecond than half a step of the product with 1e6, so `timestamp_seconds` gives back the
exact microsecond, and comparing `event_time` is the same as comparing the doubles.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
Moment = datetime | str | int | float


def epoch_micros(at: Moment) -> int:
    """Microseconds since the epoch of a datetime (naive = UTC), ISO text or epoch seconds."""
    if isinstance(at, (int, float)):
        return round(at * 1_000_000)
    if isinstance(at, str):
        at = datetime.fromisoformat(at)
    if at.tzinfo is None:
        at = at.replace(tzinfo=timezone.utc)
    return (at - EPOCH) // timedelta(microseconds=1)


def epoch_seconds(at: Moment) -> float:
    return epoch_micros(at) / 1_000_000


def instant(seconds: Column) -> Column:
    """Timestamp of epoch seconds; NULL where they name no instant of the years 1 to 9999."""
    return F.when(seconds.between(-62_135_596_800, 253_402_300_799), F.timestamp_seconds(seconds))


def moment(at: Moment) -> Column:
    """Timestamp literal that does not depend on the session time zone."""
    return F.timestamp_micros(F.lit(epoch_micros(at)))


def utc_day(at: Moment) -> date:
    return (EPOCH + timedelta(microseconds=epoch_micros(at))).date()


def utc_date(at: Column) -> Column:
    """Calendar day of a timestamp in UTC, whatever the session time zone."""
    micros_per_day = 24 * 3600 * 1_000_000
    return F.date_from_unix_date(F.floor(F.unix_micros(at) / micros_per_day).cast("int"))


def with_event_time(df: DataFrame, unit: str = "s") -> DataFrame:
    """Add `event_time` from the epoch column `timestamp`, unless the frame already has it."""
    if "event_time" in df.columns:
        return df
    return df.withColumn("event_time", instant(in_seconds(F.col("timestamp"), unit)))


def in_seconds(epoch: Column, unit: str) -> Column:
    scale = {"s": epoch, "ms": epoch / 1000}
    if unit not in scale:
        raise ValueError(f"unit must be 's' or 'ms', not {unit!r}")
    return scale[unit]


def within(df: DataFrame, start: Moment | None = None, end: Moment | None = None) -> Column:
    """Half-open predicate `[start, end)`; either bound may be missing.

    It compares a bare column with a literal, so it reaches the parquet scan. Spark does not
    derive a day from an instant, hence the extra predicate on `event_date` where the frame
    has that partition column.
    """
    if "event_time" in df.columns:
        column, literal = F.col("event_time"), moment
    else:
        column, literal = F.col("timestamp"), lambda at: F.lit(epoch_seconds(at))
    by_day = "event_date" in df.columns
    terms = []
    if start is not None:
        terms.append(column >= literal(start))
        if by_day:
            terms.append(F.col("event_date") >= F.lit(utc_day(start)))
    if end is not None:
        terms.append(column < literal(end))
        if by_day:
            terms.append(F.col("event_date") <= F.lit(utc_day(end)))
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def since(as_of: Moment, hours: float) -> datetime:
    """The instant `hours` before `as_of`."""
    return EPOCH + timedelta(microseconds=epoch_micros(as_of)) - timedelta(hours=hours)
