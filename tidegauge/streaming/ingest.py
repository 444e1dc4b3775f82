"""Append the event stream to the raw metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import utc_date
from ..schemas import METRIC_PARTITIONS, METRIC_TABLE_SCHEMA
from ..session import file_system, use_table_settings


def ingest_rows(decoded: DataFrame) -> DataFrame:
    """Decoded messages as table rows: good ones and rejected ones side by side."""
    placed = decoded.select(
        "*",
        F.when(F.col("reason").isNull(), "valid").otherwise("quarantined").alias("quality"),
        utc_date(F.col("event_time")).alias("event_date"),
    )
    return placed.select(*METRIC_TABLE_SCHEMA.names[:-1])


def ingest_metrics(
    decoded: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    writers: int | None = None,
    **options,
) -> StreamingQuery:
    """Start appending a decoded stream to the table at `path`.

    One write per micro-batch takes valid and quarantined rows, so the source is read once.
    Its folders carry the id of the stream and the number of the batch, and a replayed batch
    replaces them: each message lands exactly once across restarts and lost executors, and
    there is no log of files that grows with the table. A new checkpoint is a new id. Files
    per batch are tasks times days in the batch. By default at most as many tasks as there are cores
    write what they read, without a shuffle; `writers` spreads the rows evenly over that many tasks
    instead. `compact_metrics` writes closed days anew in few files; `options` go to the file
    writer, which has no `retention`.
    """
    if any(name.lower() == "retention" for name in options):
        raise ValueError("no metrics are dropped; there is no retention")
    spark = use_table_settings(decoded.sparkSession)
    files, root = file_system(spark, path)
    if files.exists(file_system(spark, f"{path}/_spark_metadata")[1]):
        raise ValueError(f"{path} is read by the log of a file sink, which would hide new rows; copy it to a new table")
    files.mkdirs(root)

    def append(batch: DataFrame, number: int) -> None:
        context = batch.sparkSession.sparkContext
        stream = context.getLocalProperty("sql.streaming.queryId")
        spread = batch.repartition(writers) if writers else batch.coalesce(context.defaultParallelism)
        named = spread.withColumn("batch", F.lit(f"{stream}-{number}"))
        writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
        writer.partitionBy(*METRIC_PARTITIONS).parquet(path)

    return (
        ingest_rows(decoded)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .foreachBatch(append)
        .start()
    )
