"""Insights straight from the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import with_event_time
from ..operators.alerts import with_alerts
from ..operators.periods import summary_columns
from ..operators.rows import insight_columns
from ..schemas import MEASURES, Thresholds
from ..session import ADAPTIVE, ROCKSDB, setting, use_table_settings
from ..sinks import write_checked
from ..sinks.insights import rejects_folder
from .source import flag_ahead


def stream_insights(
    stream: DataFrame,
    minutes: int = 60,
    watermark: str = "10 minutes",
    thresholds: Thresholds = Thresholds(),
    style: str = "value",
    max_ahead: str = "1 day",
) -> DataFrame:
    """Per-device summaries of event-time windows, with alerts.

    Windows are aligned to the clock and never clipped, unlike the batch operator, whose
    periods start where the run starts. In append mode a window comes out once, when the
    watermark has passed its end, and rows later than that are dropped. Rejected rows
    (`reason` not NULL) and rows more than `max_ahead` ahead of the clock, which would close
    all windows, are left out. `plans.close_windows` repairs from the stored metrics what a
    stream left open or dropped; the query's progress counts the dropped rows
    (`numRowsDroppedByWatermark`). State is one fixed-width row per device and open
    window, and rows are pre-aggregated before they reach it.
    """
    rows = flag_ahead(with_event_time(stream), max_ahead).where(F.col("reason").isNull())
    summed = (
        rows.select("device_id", "event_time", *MEASURES)
        .withWatermark("event_time", watermark)
        .groupBy("device_id", F.window("event_time", f"{minutes} minutes").alias("period"))
        .agg(*summary_columns())
    )
    bounded = summed.select(
        "*",
        F.col("period.start").alias("period_start"),
        F.col("period.end").alias("period_end"),
    )
    return insight_columns(with_alerts(bounded, thresholds, style))


def start_insights(
    insights: DataFrame,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    rejects: str | None = None,
    **options,
) -> StreamingQuery:
    """Start writing a stream of insights with `sinks.write_checked`.

    All devices of a window leave the watermark in the same micro-batch, so replacing whole
    periods makes a replayed batch harmless. Refused insights never stop the stream: they go
    to `rejects`, by default `<target>-rejects`; a table or database needs the folder named.
    The session's state store provider is set to RocksDB.
    """
    if rejects_folder(target, rejects) is None:
        raise ValueError("name a folder for `rejects`")
    spark = use_table_settings(insights.sparkSession)
    # open windows live on disk with a durable copy in the checkpoint, not on the heap
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    adaptive = spark.conf.get(ADAPTIVE)

    def save(batch: DataFrame, _: int) -> None:
        # a streaming session runs without AQE, but the rows of a finished micro-batch can be
        # gathered with it
        with setting(batch.sparkSession, ADAPTIVE, adaptive):
            write_checked(batch, target, rejects, **options)

    return (
        insights.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .foreachBatch(save)
        .start()
    )
