"""Reading stored insights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import moment, since
from ..functions.clock import utc_day
from ..schemas import INSIGHT_SCHEMA, INSIGHT_TABLE_SCHEMA
from ..session import use_table_settings
from .days import read_days


def jdbc_read_options(
    table: str, begin=None, as_of=None, partitions: int = 1, **properties: str
) -> dict[str, str]:
    """Options of a JDBC read that is split on `period_end` between the two instants.

    The bounds only place the cuts between connections; rows outside them are read too.
    """
    options = {"dbtable": table, "fetchsize": "10000", **properties}
    if partitions > 1 and begin is not None and as_of is not None:
        options |= {
            "partitionColumn": "period_end",
            "lowerBound": str(begin),
            "upperBound": str(as_of),
            "numPartitions": str(partitions),
        }
    return options


def newest_versions(df: DataFrame) -> DataFrame:
    """The last written row of each (device, period), for targets that can only append.

    Spark filters the row number before the shuffle as well, so many copies of one period
    leave each task as a single row.
    """
    period = ("device_id", "period_start", "period_end")
    last = Window.partitionBy(*period).orderBy(F.desc("created_at"), F.desc("metrics_count"))
    return (
        df.withColumn("version", F.row_number().over(last))
        .where(F.col("version") == 1)
        .drop("version")
    )


def read_insights(
    spark: SparkSession,
    source: str,
    hours: float | None = None,
    as_of=None,
    table: str = "device_insights",
    partitions: int = 1,
    latest_only: bool | None = None,
    ordered: bool | None = None,
    **properties: str,
) -> DataFrame:
    """Insights whose period ended in the last `hours` before `as_of`, newest first; or all, in no order.

    `source` is a folder, a catalog table or a `jdbc:` URL (`table`, `partitions` and
    `properties` go to the driver). With `hours`, only the days of a folder that they touch are
    listed; without, everything is read. Only a bounded read is sorted unless `ordered` says
    otherwise: a whole table would be sorted by its readers' own needs. `latest_only` drops
    rows that a later run of the same period replaced; by default it does so for JDBC, where
    every rerun appends. Columns held as text are converted, alerts from JSON.
    """
    use_table_settings(spark)
    if (hours is None) != (as_of is None):
        raise ValueError("hours and as_of go together")
    begin = None if hours is None else since(as_of, hours)
    if source.startswith("jdbc:"):
        options = jdbc_read_options(table, begin, as_of, partitions, **properties)
        stored = spark.read.format("jdbc").option("url", source).options(**options).load()
    elif "/" in source:
        first = None if begin is None else utc_day(begin)
        stored = read_days(spark, source, INSIGHT_TABLE_SCHEMA, "period_date", first)
    else:
        stored = spark.table(source)

    def column(field: T.StructField):
        held = stored.schema[field.name].dataType
        if field.name == "alerts" and isinstance(held, T.StringType):
            return F.from_json("alerts", "array<string>").alias("alerts")
        if isinstance(held, T.StringType) and held != field.dataType:
            return F.col(field.name).try_cast(field.dataType).alias(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    extra = [c for c in ("created_at", "period_date") if c in stored.columns]
    kept = stored.select(*[column(f) for f in INSIGHT_SCHEMA], *extra)
    if begin is not None:
        kept = kept.where(F.col("period_end") >= moment(begin))
        if "period_date" in extra:
            kept = kept.where(F.col("period_date") >= F.lit(utc_day(begin)))
    if latest_only is None:
        latest_only = source.startswith("jdbc:")
    if latest_only and "created_at" in extra:
        kept = newest_versions(kept)
    typed = kept.select(*INSIGHT_SCHEMA.names)
    if not (begin is not None if ordered is None else ordered):
        return typed
    return typed.orderBy(F.desc("period_end"), "device_id", F.desc("period_start"))
