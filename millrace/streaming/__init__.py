"""Running streams to completion, sinks and progress reports."""

from millrace.streaming.backlog import feed_slices, number_by_time, slice_manifest, sliced_stream, write_slices
from millrace.streaming.keyed import KeyedTable
from millrace.streaming.layout import StateLayout, check_layout, check_schema, kept_schema, state_layout
from millrace.streaming.progress import (
    ProgressFiles,
    ProgressLog,
    event_time_line,
    observed,
    progress_frame,
    state_rows,
    stored_progress,
    watch,
    watermark_in_force,
)
from millrace.streaming.runner import RunningStream, await_end, run_stream, start_stream, trigger_options
from millrace.streaming.sinks import (
    EpochSink,
    RowWriter,
    cassandra_sink,
    console_sink,
    jdbc_sink,
    kafka_batch_write,
    kafka_sink,
    published,
)

__all__ = [
    "EpochSink",
    "KeyedTable",
    "ProgressFiles",
    "ProgressLog",
    "RowWriter",
    "RunningStream",
    "StateLayout",
    "await_end",
    "cassandra_sink",
    "check_layout",
    "check_schema",
    "console_sink",
    "event_time_line",
    "feed_slices",
    "jdbc_sink",
    "kafka_batch_write",
    "kafka_sink",
    "kept_schema",
    "number_by_time",
    "observed",
    "progress_frame",
    "published",
    "run_stream",
    "slice_manifest",
    "sliced_stream",
    "start_stream",
    "state_layout",
    "state_rows",
    "stored_progress",
    "trigger_options",
    "watch",
    "watermark_in_force",
    "write_slices",
]
