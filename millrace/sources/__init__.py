"""Bounded and unbounded readers."""

from millrace.sources.files import (
    csv_stream,
    json_stream,
    lines_stream,
    numbers,
    read_table,
    table,
    table_stream,
)
from millrace.sources.kafka import kafka_stream, kafka_stream_options

__all__ = [
    "csv_stream",
    "json_stream",
    "kafka_stream",
    "kafka_stream_options",
    "lines_stream",
    "numbers",
    "read_table",
    "table",
    "table_stream",
]
