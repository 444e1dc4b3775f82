"""Insight sinks: a partitioned folder or table that a rerun replaces, or a JDBC append."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import epoch_micros, utc_date
from ..functions.clock import utc_day
from ..operators.rows import flag_rows, insight_columns
from ..schemas import (
    INSIGHT_PARTITIONS,
    INSIGHT_REQUIRED,
    INSIGHT_SCHEMA,
    INSIGHT_TABLE_SCHEMA,
)
from ..session import ADAPTIVE, remove_dir, setting, subfolders, use_table_settings


# Tasks per period where AQE cannot split one.
PARTS = 4
# What a task costs here is the files it creates, not their bytes: AQE must not put many small
# periods into one task while cores are idle.
SPREAD = ("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")


def with_period_key(df: DataFrame) -> DataFrame:
    """Add the write time and the two partition columns of a period."""
    start, end = F.unix_micros("period_start"), F.unix_micros("period_end")
    return df.select(
        "*",
        F.current_timestamp().alias("created_at"),
        utc_date(F.col("period_end")).alias("period_date"),
        F.concat_ws("-", start, end).alias("period_key"),
    )


def insight_rows(insights: DataFrame) -> DataFrame:
    """Insights as they are stored."""
    return with_period_key(insight_columns(insights))


def gathered(rows: DataFrame) -> DataFrame:
    """Rows of a period together, so that it gets few files, sorted by device within them.

    The rebalance also splits a period that is too large for one task. Spark ignores it
    without AQE; rows are then hashed by period and one of PARTS parts of the devices.
    """
    if rows.sparkSession.conf.get(ADAPTIVE) == "true":
        together = rows.hint("rebalance", *INSIGHT_PARTITIONS)
    else:
        together = rows.repartition(*INSIGHT_PARTITIONS, F.pmod(F.xxhash64("device_id"), F.lit(PARTS)))
    return together.sortWithinPartitions(*INSIGHT_PARTITIONS, "device_id")


def write_periods(rows: DataFrame, path: str, mode: str = "replace", **options) -> None:
    """Write rows with a period key to a folder, replacing the periods among them or adding."""
    writer = gathered(rows).write.options(**options).option("partitionOverwriteMode", "dynamic")
    writer = writer.mode("overwrite" if mode == "replace" else "append")
    with setting(rows.sparkSession, *SPREAD):
        writer.partitionBy(*INSIGHT_PARTITIONS).parquet(path)


def jdbc_rows(insights: DataFrame) -> DataFrame:
    """Insights as they cross a JDBC boundary: alerts as JSON text, and the write time."""
    flat = insight_columns(insights).withColumn("alerts", F.to_json("alerts"))
    return flat.withColumn("created_at", F.current_timestamp())


def jdbc_write_options(
    table: str, partitions: int = 8, batch_size: int = 10_000, **properties: str
) -> dict[str, str]:
    """`partitions` bounds the connections that are open at once."""
    return {
        "dbtable": table,
        "numPartitions": str(partitions),
        "batchsize": str(batch_size),
        **properties,
    }


def ensure_insights_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the insights table unless it exists; over a folder it shows the insights there.

    The key of a row is (device_id, period_start, period_end), so there is no serial id.
    Spark does not enforce NOT NULL on parquet; `operators.split_valid` does that work.
    """
    use_table_settings(spark)
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{' NOT NULL' if f.name in INSIGHT_REQUIRED else ''}"
        for f in INSIGHT_TABLE_SCHEMA.fields
    )
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(INSIGHT_PARTITIONS)}){where}"
    )
    if location:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
        if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            spark.catalog.recoverPartitions(name)


def write_insights(
    insights: DataFrame,
    target: str,
    mode: str = "replace",
    table: str = "device_insights",
    **options,
) -> bool:
    """Write insights; True if there was anything to write.

    `target` is a folder (with a slash), a catalog table or a `jdbc:` URL. `mode="replace"` overwrites the
    partitions of the periods being written, so a rerun changes nothing; `"append"` adds rows.
    JDBC can only append: a rerun adds a later version, and `read_insights` keeps the last.
    Alerts cross as JSON text; a PostgreSQL JSONB column takes it with the connection
    property `stringtype="unspecified"`.

    A period is replaced as a whole: give all its devices. The rows are cached for the
    count, so that the plan behind them runs once.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be 'replace' or 'append', not {mode!r}")
    rows = insights.persist()
    try:
        if rows.isEmpty():
            return False
        store(rows, target, mode, table, **options)
    finally:
        rows.unpersist()
    return True


def store(insights: DataFrame, target: str, mode: str = "replace", table: str = "device_insights", **options) -> None:
    spark = use_table_settings(insights.sparkSession)
    if target.startswith("jdbc:"):
        sink = jdbc_rows(insights).write.format("jdbc").mode("append")
        sink.option("url", target).options(**jdbc_write_options(table, **options)).save()
        return
    rows = insight_rows(insights)
    if "/" in target:
        write_periods(rows, target, mode, **options)
    else:
        dynamic = setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic")
        with dynamic, setting(spark, *SPREAD):
            gathered(rows).write.insertInto(target, overwrite=mode == "replace")


def rejects_folder(target: str, rejects: str | None) -> str | None:
    """Where refused rows go: beside a folder by default; tables and databases need a name."""
    if rejects is None and "/" in target and not target.startswith("jdbc:"):
        return f"{target.rstrip('/')}-rejects"
    return rejects


def clear_periods(spark: SparkSession, path: str, periods: Iterable[tuple[datetime, datetime]], keep: set[str]) -> None:
    """Remove the stored periods of a run that it has not written this time; lists the folders of its days only."""
    gone: dict[str, set[str]] = defaultdict(set)
    for start, end in periods:
        key = f"{epoch_micros(start)}-{epoch_micros(end)}"
        if key not in keep:
            gone[f"period_date={utc_day(end)}"].add(f"period_key={key}")
    for day, keys in gone.items():
        for key in keys.intersection(subfolders(spark, f"{path}/{day}")):
            remove_dir(spark, f"{path}/{day}/{key}")


def write_checked(
    insights: DataFrame,
    target: str,
    rejects: str | None = None,
    periods: Iterable[tuple[datetime, datetime]] = (),
    **options,
) -> bool:
    """`write_insights` for the rows that meet the NOT NULL columns of the table.

    The others go to the folder `rejects` with the `reason`, by period like the insights;
    for a target folder that is `<target>-rejects` unless named. Both kinds are counted
    before anything is written: refused rows without a folder for them are an error that
    leaves the target as it was. The insights are cached for the count and both writes, so
    the metrics behind them are read once; an executor that is lost with its part of the
    cache costs only that part again.

    `periods` are all periods of the run: in a target folder and its rejects, those that
    this run has no rows for are removed, so that a rerun leaves what the data now say.
    """
    spark = use_table_settings(insights.sparkSession)
    rejects = rejects_folder(target, rejects)
    flagged = flag_rows(insights, INSIGHT_REQUIRED, INSIGHT_SCHEMA).persist()
    good, bad = flagged.where(F.col("reason").isNull()), flagged.where(F.col("reason").isNotNull())
    try:
        periods = list(periods) if "/" in target and not target.startswith("jdbc:") else []
        counts = F.count("*").alias("rows"), F.count("reason").alias("refused")
        if periods:  # a row per period of the run
            found = with_period_key(flagged).groupBy("period_key").agg(*counts).collect()
        else:
            found = flagged.agg(*counts).collect()
        rows, refused = (sum(r[c] for r in found) for c in ("rows", "refused"))
        if refused and rejects is None:
            raise ValueError(f"{refused} insights lack a required column; name a folder for `rejects`")
        if rows > refused:
            store(good, target, **options)
        if refused:
            write_periods(with_period_key(bad), rejects)
        if periods:
            clear_periods(spark, target, periods, {r["period_key"] for r in found if r["rows"] > r["refused"]})
            clear_periods(spark, rejects, periods, {r["period_key"] for r in found if r["refused"]})
    finally:
        flagged.unpersist()
    return rows > refused
