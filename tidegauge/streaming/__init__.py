"""Structured Streaming: ingest, running insights, live tail."""

from .compact import compact_metrics, scan_compacted
from .ingest import ingest_metrics, ingest_rows
from .insights import start_insights, stream_insights
from .source import decode_messages, flag_ahead, kafka_options, read_live_stream, read_metric_stream
from .tail import live_tail, read_live_tail

__all__ = [
    "compact_metrics",
    "scan_compacted",
    "decode_messages",
    "flag_ahead",
    "ingest_metrics",
    "ingest_rows",
    "kafka_options",
    "live_tail",
    "read_live_stream",
    "read_live_tail",
    "read_metric_stream",
    "start_insights",
    "stream_insights",
]
