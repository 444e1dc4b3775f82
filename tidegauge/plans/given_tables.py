"""The supplied tables in the shape of this package's inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import METRIC_SCHEMA
from ..session import use_table_settings


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return use_table_settings(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def as_metrics(events: DataFrame) -> DataFrame:
    """`events` rows as metrics of twelve devices, one metric per event."""
    instant = F.col("ts").cast("timestamp")
    key = F.get_json_object("props", "$.k").cast("int")
    spread = F.col("event_id") * 7919 % 80001
    return events.select(
        F.col("event_id").cast("string").alias("_id"),
        device_name(F.col("user_id") % 12 + 1).alias("device_id"),
        (F.unix_micros(instant) / F.lit(1e6)).alias("timestamp"),
        (F.lit(100) + F.lit(100) * key).cast("int").alias("iops"),
        (F.lit(1) + F.least("value", F.lit(140.0)) / 10).alias("latency"),
        # one division of whole cents is the same double as a sum rounded to two decimals
        ((F.lit(100 * 100) + spread) / F.lit(100.0)).alias("capacity_used"),
        instant.alias("event_time"),
    )


def device_name(number: Column) -> Column:
    return F.concat(F.lit("dev"), F.lpad(number.cast("string"), 2, "0"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_metrics(given(spark, sf_dir, "events"))


def stream_of_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a file stream of metrics."""
    shape = given(spark, sf_dir, "events").schema
    # the braces make it a pattern, which the stream reader wants for a single file
    source = f"{sf_dir.rstrip('/')}/{{events}}.parquet"
    return as_metrics(spark.readStream.schema(shape).parquet(source))


def as_messages(rows: DataFrame) -> DataFrame:
    """Metrics as JSON messages, the way they arrive from a topic."""
    return rows.select(F.to_json(F.struct(*METRIC_SCHEMA.names)).cast("binary").alias("value"))


def loose_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a record of texts, some damaged: the input of the constraint check.

    Residues of `event_id` decide the damage: no device, an unreadable time, a missing or
    a non-numeric measure. The others are whole.
    """
    rows = metrics(spark, sf_dir).drop("event_time")
    number = F.col("_id").cast("long")

    def spoil(name: str, step: int, left: int, bad: str | None) -> Column:
        text = F.col(name).cast("string")
        return F.when(number % step == left, F.lit(bad)).otherwise(text).alias(name)

    return rows.select(
        "_id",
        spoil("device_id", 17, 3, None),
        spoil("timestamp", 23, 5, "soon"),
        spoil("iops", 19, 7, None),
        spoil("latency", 29, 11, "n/a"),
        F.col("capacity_used").cast("string").alias("capacity_used"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`nation` and `region` as the device dimension; the first two devices are unknown to it."""
    nation, region = given(spark, sf_dir, "nation"), given(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        device_name(F.col("n_nationkey") + 3).alias("device_id"),
        F.col("r_name").alias("site"),
        F.col("n_name").alias("model"),
        (F.lit(1000.0) + F.col("n_nationkey") * 10).alias("capacity_total"),
    )
