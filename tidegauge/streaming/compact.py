"""Closed days of the metrics table, in few files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import utc_day
from ..schemas import METRIC_PARTITIONS, METRIC_TABLE_SCHEMA
from ..session import ADAPTIVE, setting, use_table_settings
from ..sources.metrics import scan_metrics

MERGED = "merged"


def compact_metrics(spark: SparkSession, path: str, target: str, before, first=None) -> None:
    """Write the days from `first` up to, not including, that of `before` to the table at `target`.

    The ingest table at `path` stays as it is, so readers of it never miss a row. All days are
    one job; a day too large for one task is split, rows are sorted by time. A day in `target`
    is replaced as a whole: a rerun changes nothing, and takes in rows that came late. Days
    without rows are left as they are; rejected messages without a time stay in `path` only.
    """
    use_table_settings(spark)
    day = F.col("event_date")
    closed = day < F.lit(utc_day(before))
    if first is not None:
        closed &= day >= F.lit(utc_day(first))
    *by_day, _ = METRIC_PARTITIONS
    rows = spark.read.schema(METRIC_TABLE_SCHEMA).parquet(path).where(closed).drop("batch").hint("rebalance", *by_day)
    rows = rows.sortWithinPartitions(*by_day, "event_time").withColumn("batch", F.lit(MERGED))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with setting(spark, ADAPTIVE, "true"):
        writer.partitionBy(*METRIC_PARTITIONS).parquet(target)


def scan_compacted(spark: SparkSession, path: str, target: str, before, start=None, end=None) -> DataFrame:
    """Valid metrics of `[start, end)`: those of days before that of `before` from `target`, the others from `path`."""
    edge = utc_day(before).isoformat()
    whole = [scan_metrics(spark, source, start, end) for source in (target, path)]
    old, new = (F.col("event_time") < F.lit(edge).cast("timestamp"), F.col("event_time") >= F.lit(edge).cast("timestamp"))
    return whole[0].where(old).unionByName(whole[1].where(new))
