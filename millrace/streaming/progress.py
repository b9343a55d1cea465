"""What a running query reports: event times, watermark, late and stored rows."""

from __future__ import annotations

import json
import threading
import time
from collections import deque
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.session import entries, read_text, write_text

FIELDS = (
    "batch_id BIGINT, input_rows BIGINT, min_time STRING, avg_time STRING, max_time STRING, "
    "watermark STRING, late_rows BIGINT, state_rows BIGINT"
)
REPORT = (
    "batchId BIGINT, numInputRows BIGINT, eventTime STRUCT<min: STRING, avg: STRING, max: STRING, watermark: STRING>, "
    "stateOperators ARRAY<STRUCT<numRowsDroppedByWatermark: BIGINT, numRowsTotal: BIGINT>>"
)
TIMES = ("min_time", "avg_time", "max_time", "watermark")


def progress_frame(spark: SparkSession, reports: list[Any]) -> DataFrame:
    """One row per reported batch, from ``query.recentProgress`` or a ``ProgressLog``.

    Both keep only the newest reports. For totals over a whole run file every report
    (``run_stream(..., progress=True)``) and read them with ``stored_progress``.
    """
    frame = spark.createDataFrame([_report_row(json.loads(report.json)) for report in reports], FIELDS)
    return frame.withColumns({name: F.col(name).cast("timestamp") for name in TIMES})


def _report_row(report: dict[str, Any]) -> tuple:
    times = report.get("eventTime") or {}
    operators = report.get("stateOperators") or []
    return (
        report["batchId"],
        report["numInputRows"],
        times.get("min"),
        times.get("avg"),
        times.get("max"),
        times.get("watermark"),
        sum(op.get("numRowsDroppedByWatermark", 0) for op in operators),
        sum(op.get("numRowsTotal", 0) for op in operators),
    )


def event_time_line(query: StreamingQuery) -> str:
    """Event times of the last batch as text, ``[]`` before the first report."""
    last = query.lastProgress
    if last is None:
        return "[]"
    return json.dumps(json.loads(last.json).get("eventTime") or {}, sort_keys=True)


def watch(
    query: StreamingQuery, times: int = 100, every: float = 1.0, show: Callable[[str], None] = print
) -> None:
    """Show the event times at fixed intervals while the query is active."""
    for tick in range(1, times + 1):
        time.sleep(every)
        show(f"{tick}: {event_time_line(query)}")
        if not query.isActive:
            return


REPORTS = "progress"


class ProgressFiles(StreamingQueryListener):
    """Files every report of a query below its folder, one small file per batch.

    Use as a context around start and end of the query. On leaving it waits until the
    query's end has been reported, after which no report can follow.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.run: str | None = None
        self.done = threading.Event()

    def __enter__(self) -> ProgressFiles:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        if error[0] is None:
            self.done.wait(60)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event: Any) -> None:
        self.run = self.run or str(event.runId)

    def onQueryProgress(self, event: Any) -> None:
        report = event.progress
        if str(report.runId) == self.run:
            name = f"{report.batchId}-{self.run}"
            write_text(self.spark, f"{self.folder}/{REPORTS}/{name}.json", json.dumps(json.loads(report.json)))

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        if str(event.runId) == self.run:
            self.done.set()


def stored_progress(spark: SparkSession, folder: str) -> DataFrame:
    """One row per report filed in ``folder``, over all its runs, as in ``progress_frame``."""
    text = spark.read.text(f"{folder}/{REPORTS}", wholetext=True)
    report = F.from_json("value", REPORT).alias("r")
    return text.select(report).select(
        F.col("r.batchId").alias("batch_id"),
        F.col("r.numInputRows").alias("input_rows"),
        *(F.col(f"r.eventTime.{short}").cast("timestamp").alias(name) for short, name in zip(("min", "avg", "max", "watermark"), TIMES, strict=True)),
        F.aggregate("r.stateOperators.numRowsDroppedByWatermark", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("late_rows"),
        F.aggregate("r.stateOperators.numRowsTotal", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("state_rows"),
    )


def observed(spark: SparkSession, folder: str, name: str, fields: str) -> DataFrame:
    """The metrics that ``df.observe(name, ...)`` gave, one row per report filed in ``folder``.

    ``fields`` are the metrics' names and types as DDL.
    """
    report = F.from_json("value", f"batchId BIGINT, observedMetrics STRUCT<`{name}`: STRUCT<{fields}>>").alias("r")
    text = spark.read.text(f"{folder}/{REPORTS}", wholetext=True)
    return text.select(report).select(F.col("r.batchId").alias("batch_id"), f"r.observedMetrics.{name}.*")


def watermark_in_force(spark: SparkSession, checkpoint: str) -> int | None:
    """The watermark, in milliseconds, that the next batch of a checkpoint starts with; None before the first.

    It is the one of the newest planned batch: Spark plans a batch without data when the
    watermark has moved, so an ended run leaves its last watermark there.
    """
    batches = [int(n) for n in entries(spark, f"{checkpoint}/offsets") if n.isdigit()]
    if not batches:
        return None
    lines = read_text(spark, f"{checkpoint}/offsets/{max(batches)}").splitlines()
    return json.loads(lines[1])["batchWatermarkMs"]


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The rows that a stateful operator holds in a checkpoint: structs ``key`` and ``value``.

    Reads the state store of the last finished batch as a table, without running the query.
    """
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint).select("key", "value")


class ProgressLog(StreamingQueryListener):
    """Keeps the newest reports of all queries of a session."""

    def __init__(self, size: int = 1000) -> None:
        self.reports: deque = deque(maxlen=size)
        self.ended: deque = deque(maxlen=size)

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        self.reports.append(event.progress)

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        self.ended.append(str(event.id))
