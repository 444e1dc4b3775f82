"""The JSON event stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import reject_reason
from ..operators.rows import coerce_metrics
from ..schemas import METRIC_REQUIRED, METRIC_SCHEMA
from ..session import use_table_settings

# Fixed value: the topic of the metric events.
TOPIC = "storage_metrics"

NUMBERS = tuple(f.name for f in METRIC_SCHEMA if isinstance(f.dataType, T.NumericType))

# Numbers are read as doubles, which takes `2` and `4200.0` alike. A message this does not
# fit is read again with every field as text, so that one odd value hides no other.
QUICK_SCHEMA, TEXT_SCHEMA = (
    ", ".join(f"`{n}` {kind if n in NUMBERS else 'string'}" for n in METRIC_SCHEMA.names)
    + ", `_malformed` string"
    for kind in ("double", "string")
)
JSON_OPTIONS = {"columnNameOfCorruptRecord": "_malformed", "allowSingleQuotes": "false"}


def kafka_options(
    servers: str, topic: str = TOPIC, group: str | None = None, newest_only: bool = False, **more
) -> dict[str, str]:
    """Options of a Kafka subscription; without a checkpoint it starts at the earliest offset."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest" if newest_only else "earliest",
    }
    if group:
        options["kafka.group.id"] = group
    return options | more


def decode_messages(messages: DataFrame) -> DataFrame:
    """Messages with a JSON `value` as METRIC_SCHEMA, `event_time`, `reason` and `raw`.

    Nothing is dropped: a message that is no JSON object, lacks a required field or holds a
    value that does not convert keeps its text in `raw` and says why in `reason`. A message
    without `_id` is named by its place in the topic, where there is one.
    """
    place = all(c in messages.columns for c in ("topic", "partition", "offset"))
    position = F.concat_ws("-", "topic", "partition", "offset") if place else F.lit(None)
    carried = [c for c in ("received_at",) if c in messages.columns]

    text = F.col("value").cast("string")
    quick = messages.select(
        text.alias("raw"), position.cast("string").alias("position"), *carried,
        F.from_json(text, QUICK_SCHEMA, JSON_OPTIONS).alias("quick"),
    )
    again = F.col("quick").isNull() | F.col("quick._malformed").isNotNull()
    both = quick.withColumn("text", F.when(again, F.from_json("raw", TEXT_SCHEMA, JSON_OPTIONS)))

    def field(name: str) -> Column:
        read, spare = F.col(f"quick.{name}"), F.col(f"text.{name}")
        return F.coalesce(read, spare.try_cast("double") if name in NUMBERS else spare)

    # the parser ignores what follows the object, which would hide a message cut or glued; as
    # an element of an array it must be alone, which only a brace before the end can deny
    trimmed = F.rtrim("raw", F.lit(" \t\r\n"))
    elements = F.from_json(F.concat(F.lit("["), trimmed, F.lit("]")), "array<map<string,string>>", JSON_OPTIONS)
    alone = (F.instr(trimmed, "}") == F.length(trimmed)) | (F.coalesce(F.size(elements), F.lit(0)) == 1)
    unfinished = ~trimmed.endswith("}") | ~alone
    no_object = F.col("text").isNull() | F.col("text._malformed").isNotNull()
    unread = F.coalesce(
        *[F.when(F.col(f"text.{n}").isNotNull() & field(n).isNull(), n) for n in NUMBERS]
    )
    loose = both.select(
        F.coalesce(F.nullif(field("_id"), F.lit("")), "position").alias("_id"),
        *[field(n).alias(n) for n in METRIC_SCHEMA.names[1:]],
        *carried,
        "raw",
        F.col("raw").isNull().alias("missing"),
        ((again & no_object) | unfinished).alias("broken"),
        unread.alias("unread"),
    )
    reason = F.when(F.col("missing") | F.col("broken"), "malformed").otherwise(
        F.coalesce(reject_reason(loose, METRIC_REQUIRED, METRIC_SCHEMA), "unread")
    )
    flagged = loose.withColumn("reason", reason)
    flagged = flagged.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))
    return coerce_metrics(flagged, keep=("reason", "raw", *carried))


def read_messages(spark: SparkSession, source: str | None, fmt: str, **options) -> DataFrame:
    """Undecoded stream: a `value` column, and its place in the topic for Kafka.

    `fmt="text"` reads a folder of files with one JSON message per line.
    """
    reader = use_table_settings(spark).readStream.format(fmt).options(**options)
    return reader.load(source) if source else reader.load()


def read_metric_stream(
    spark: SparkSession, source: str | None = None, fmt: str = "kafka", **options
) -> DataFrame:
    """Decoded metric stream from the earliest message on.

    For Kafka pass `**kafka_options(servers, topic, group)` and, to bound a micro-batch,
    `maxOffsetsPerTrigger`; files take `maxFilesPerTrigger`.
    """
    return decode_messages(read_messages(spark, source, fmt, **options))


def read_live_stream(
    spark: SparkSession, source: str | None = None, fmt: str = "kafka", **options
) -> DataFrame:
    """Decoded metric stream stamped with the arrival time; Kafka starts at the newest offset.

    It runs until stopped, however long the topic is silent.
    """
    if fmt == "kafka":
        options = options | {"startingOffsets": "latest"}
    messages = read_messages(spark, source, fmt, **options)
    return decode_messages(messages.withColumn("received_at", F.current_timestamp()))


def flag_ahead(decoded: DataFrame, max_ahead: str = "1 day") -> DataFrame:
    """`reason` is `ahead` for good rows whose time lies further than that ahead of the clock.

    One such row would move a watermark past all others. The ingest quarantines them.
    """
    reason = F.col("reason") if "reason" in decoded.columns else F.lit(None).cast("string")
    ahead = F.col("event_time") > F.current_timestamp() + F.expr(f"INTERVAL {max_ahead}")
    return decoded.withColumn("reason", F.coalesce(reason, F.when(ahead, "ahead")))
