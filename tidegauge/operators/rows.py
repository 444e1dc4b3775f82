"""Typing rows and setting the unusable ones aside."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import reject_reason, typed, with_event_time
from ..functions.clock import in_seconds
from ..schemas import INSIGHT_SCHEMA, METRIC_REQUIRED, METRIC_SCHEMA


def coerce_metrics(df: DataFrame, unit: str = "s", keep: Sequence[str] = ()) -> DataFrame:
    """Any loose metric frame as METRIC_SCHEMA plus `event_time` and the columns in `keep`.

    Missing keys and values that do not convert become NULL, an empty `_id` too. Epochs in
    `unit` become seconds.
    """
    columns = [
        in_seconds(typed(df, field), unit).alias(field.name) if field.name == "timestamp" else typed(df, field)
        for field in METRIC_SCHEMA.fields
    ]
    columns[0] = F.nullif(columns[0], F.lit("")).alias("_id")
    if "event_time" in df.columns:
        columns.append(F.col("event_time").cast("timestamp").alias("event_time"))
    return with_event_time(df.select(*columns, *keep))


def flag_rows(
    df: DataFrame,
    required: Sequence[str] = METRIC_REQUIRED,
    schema: T.StructType = METRIC_SCHEMA,
    unit: str = "s",
) -> DataFrame:
    """The input with `reason`: the first failing column, NULL for a good row.

    The reason is a generated column. Spark moves a filter on a plain one below the
    projections before it, and would work out what they hold once per cast in the reason.
    """
    kept = df.drop("reason") if "reason" in df.columns else df
    return kept.select("*", F.explode(F.array(reject_reason(df, required, schema, unit))).alias("reason"))


def split_valid(
    df: DataFrame,
    required: Sequence[str] = METRIC_REQUIRED,
    schema: T.StructType = METRIC_SCHEMA,
    unit: str = "s",
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with `reason`): two filters over one expression.

    Using both reads the source twice.
    """
    flagged = flag_rows(df, required, schema, unit)
    good = flagged.where(F.col("reason").isNull()).drop("reason")
    return good, flagged.where(F.col("reason").isNotNull())


def metrics_from_rows(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """Metric frame from in-memory records; for tests and small inputs.

    Every field passes through text, so records may mix integers and floats or lack keys.
    """
    loose = T.StructType([T.StructField(n, T.StringType()) for n in METRIC_SCHEMA.names])
    texts = [
        tuple(None if row.get(n) is None else str(row[n]) for n in loose.names) for row in rows
    ]
    return coerce_metrics(spark.createDataFrame(texts, loose))


def insight_columns(df: DataFrame) -> DataFrame:
    """Exactly the insight columns, in order and in their types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in INSIGHT_SCHEMA])
