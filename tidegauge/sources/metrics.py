"""Raw metrics: the stored table, and any other batch source."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_micros, within
from ..functions.clock import EPOCH, utc_day
from ..operators.rows import coerce_metrics
from ..operators.views import recent_metrics
from ..schemas import METRIC_SCHEMA, METRIC_TABLE_SCHEMA
from ..session import use_table_settings
from .days import read_days

METRIC_COLUMNS = METRIC_SCHEMA.names + ["event_time"]


def load_metrics(
    spark: SparkSession,
    source: str | None,
    fmt: str = "parquet",
    unit: str = "s",
    start=None,
    end=None,
    **options,
) -> DataFrame:
    """Metrics of `[start, end)` from any batch format Spark has a reader for.

    They come typed and with `event_time`. Text formats are read as text columns first, so
    that one odd value does not fail the read; a document or JDBC connector only needs its
    jar and its options. Where the source holds `timestamp` as a number of seconds, the range
    is also put on that column, so that the source can apply it.
    """
    use_table_settings(spark)
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("json", "csv"):
        reader = reader.schema(", ".join(f"`{n}` string" for n in METRIC_SCHEMA.names))
    rows = reader.load(source) if source else reader.load()
    held = rows.schema["timestamp"].dataType if "timestamp" in rows.columns else None
    if unit == "s" and isinstance(held, T.NumericType) and "event_time" not in rows.columns:
        rows = rows.where(within(rows, start, end))
    typed = coerce_metrics(rows, unit)
    return typed.where(within(typed, start, end))


def metric_table(spark: SparkSession, source: str) -> DataFrame:
    """The stored table with its partition columns: a folder, or a catalog table by name.

    The schema of a folder is given, nothing is inferred.
    """
    use_table_settings(spark)
    if "/" in source:
        return spark.read.schema(METRIC_TABLE_SCHEMA).parquet(source)
    return spark.table(source)


def scan_metrics(spark: SparkSession, source: str, start=None, end=None) -> DataFrame:
    """Valid metrics of `[start, end)`. Lists and opens only the days the range touches."""
    if "/" in source and (start is not None or end is not None):
        use_table_settings(spark)
        days = (None if at is None else utc_day(at) for at in (start, end))
        table = read_days(spark, source, METRIC_TABLE_SCHEMA, "event_date", *days, below="quality=valid")
    else:
        table = metric_table(spark, source)
    kept = table.where((F.col("quality") == "valid") & within(table, start, end))
    return kept.select(*METRIC_COLUMNS)


def read_quarantine(spark: SparkSession, source: str) -> DataFrame:
    """Rejected messages: what could be read of them, the reason and the raw text."""
    table = metric_table(spark, source).where(F.col("quality") == "quarantined")
    return table.select(*METRIC_COLUMNS, "reason", "raw")


def latest_metrics(spark: SparkSession, source: str, as_of, limit: int = 50) -> DataFrame:
    """The `limit` newest metrics of the stored table, from its newest days only.

    The answer is exact as soon as the time read holds `limit` rows. It grows from an hour
    before `as_of`, fourfold each time, until it does or the epoch is reached; each probe
    lists and opens the days of its range only, and stops counting at `limit`.
    """
    newest = EPOCH + timedelta(microseconds=epoch_micros(as_of))
    hours = 1
    while (begin := newest - timedelta(hours=hours)) > EPOCH:
        rows = scan_metrics(spark, source, start=begin)
        if rows.limit(limit).count() >= limit:
            return recent_metrics(rows, limit)
        hours *= 4
    return recent_metrics(scan_metrics(spark, source), limit)
