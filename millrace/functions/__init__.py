"""Column-level building blocks; all of them stay in JVM expressions."""

from millrace.functions.lines import parse_lines, short_lines
from millrace.functions.messages import (
    decode_kafka,
    keyed_messages,
    to_json_kv,
    to_kv,
)
from millrace.functions.records import conform, expand, json_records, pick_fields

__all__ = [
    "conform",
    "decode_kafka",
    "expand",
    "json_records",
    "keyed_messages",
    "parse_lines",
    "pick_fields",
    "short_lines",
    "to_json_kv",
    "to_kv",
]
