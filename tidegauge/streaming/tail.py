"""The newest arrivals of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.views import newest_first
from ..schemas import METRIC_SCHEMA
from ..session import use_table_settings

HELD_SCHEMA = T.StructType(
    METRIC_SCHEMA.fields
    + [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("received_at", T.TimestampType()),
        T.StructField("batch", T.LongType()),
        T.StructField("run", T.StringType()),
        T.StructField("run_start", T.LongType()),
    ]
)
TAIL_COLUMNS = HELD_SCHEMA.names[:-3]


def slot(path: str, batch: int) -> str:
    return f"{path.rstrip('/')}/slot={batch % 2}"


def newest(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.desc("received_at"), *newest_first()).limit(n)


def live_tail(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 100,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start holding the `n` newest arrivals of a decoded stream below `path`.

    Each micro-batch keeps its own newest `n` rows, adds the `n` held before, and writes the
    newest `n` of both as one small file. Batches alternate between two folders: the one
    being rewritten is never the one a reader or a replayed batch needs. A run with a new
    checkpoint counts its batches from 0; here they go on from the last one held.
    """
    spark = use_table_settings(stream.sparkSession)
    rows = stream if "received_at" in stream.columns else stream.withColumn(
        "received_at", F.current_timestamp()
    )
    if "reason" in rows.columns:
        rows = rows.where(F.col("reason").isNull())
    # make both folders readable before the first batch
    empty = spark.createDataFrame([], HELD_SCHEMA)
    for number in (0, 1):
        empty.write.mode("append").parquet(slot(path, number))

    def hold(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        slots = session.read.schema(HELD_SCHEMA).parquet(slot(path, 0), slot(path, 1))
        own = F.col("run") == checkpoint
        begun, last = slots.agg(F.max(F.when(own, F.col("run_start"))), F.max("batch")).first()
        start = begun if begun is not None else 0 if last is None else last + 1
        number += start
        held = session.read.schema(HELD_SCHEMA).parquet(slot(path, number - 1))
        both = newest(batch.select(*TAIL_COLUMNS), n).unionByName(held.select(*TAIL_COLUMNS))
        stamps = {"batch": number, "run_start": start}
        kept = newest(both, n).withColumns({k: F.lit(v).cast("long") for k, v in stamps.items()})
        kept = kept.withColumn("run", F.lit(checkpoint)).select(*HELD_SCHEMA.names)
        kept.coalesce(1).write.mode("overwrite").parquet(slot(path, number))

    return (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .foreachBatch(hold)
        .start()
    )


def read_live_tail(spark: SparkSession, path: str) -> DataFrame:
    """The rows held by the latest finished batch, newest first."""
    use_table_settings(spark)
    files = spark.read.schema(HELD_SCHEMA).option("ignoreMissingFiles", "true")
    held = files.parquet(slot(path, 0), slot(path, 1))
    last = held.agg(F.max("batch").alias("batch"))
    rows = held.join(last, "batch", "left_semi").select(*TAIL_COLUMNS)
    return rows.orderBy(F.desc("received_at"), *newest_first())
