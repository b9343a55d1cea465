"""Start streaming queries, or run them until their source is drained.

Every run keeps its checkpoint and its output in one folder, so calling again with
the same folder resumes where the last run stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from millrace.streaming.layout import StateLayout, check_layout, check_schema
from millrace.streaming.progress import ProgressFiles
from millrace.streaming.keyed import BATCH, KeyedTable


def trigger_options(kind: str = "available_now", interval: str | None = None) -> dict[str, object]:
    """Arguments for ``writeStream.trigger``; ``default`` means no trigger call."""
    if kind == "default":
        return {}
    if kind == "available_now":
        return {"availableNow": True}
    if kind == "once":
        return {"once": True}
    if kind in ("processing_time", "continuous"):
        if not interval:
            raise ValueError(f"a {kind} trigger needs an interval such as '2 seconds'")
        return {"processingTime" if kind == "processing_time" else "continuous": interval}
    raise ValueError(f"unknown trigger {kind!r}")


def await_end(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for the end; with ``timeout`` (seconds) a query still running then is stopped."""
    try:
        finished = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination() or True
    except BaseException:
        query.stop()
        raise
    if not finished:
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")


@dataclass
class RunningStream:
    """A started query and the way to its stored result, usable while it runs."""

    query: StreamingQuery
    result: Callable[[], DataFrame]


def start_stream(
    df: DataFrame,
    folder: str,
    mode: str = "append",
    *,
    keys: Sequence[str] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
    trigger: Mapping[str, object] | None = None,
    order_by: Sequence[Column | str] = (),
    layout: StateLayout | None = None,
    schema: StructType | None = None,
    read: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "parquet",
) -> RunningStream:
    """Start writing ``df`` to Parquet below ``folder``; returns at once.

    ``append``   the file sink, whose own log keeps replays from doubling rows.
    ``update``   changed rows of each batch, filed under the batch number; the
                 result keeps the newest row per ``keys``.
    ``complete`` the whole result of each batch, in one of two alternating slots:
                 the previous one stays whole while the next is written.

    ``finish`` turns a complete result into the frame to store. It runs on a
    bounded frame, so it may rank or aggregate again. ``order_by`` sorts the result when
    it is read: stored files keep no order. ``trigger`` comes from ``trigger_options``;
    without one, batches follow each other without a pause. ``fmt`` is the file format of
    append mode. ``layout`` is the hot-key layout the frame was built with: it must be the
    one that the folder was first started with, and so must ``schema``, an inferred one of the
    records, if it is given (``kept_schema``). ``read`` is applied to the stored rows whenever
    the result is read (``settle_full``).
    """
    if mode not in ("append", "update", "complete"):
        raise ValueError(f"unknown output mode {mode!r}")
    if mode == "update" and not keys:
        raise ValueError("update mode needs the key columns of the result")
    if finish is not None and mode != "complete":
        raise ValueError("finish needs the whole result, so it goes with complete mode only")
    spark, data = df.sparkSession, f"{folder}/data"
    check_layout(spark, folder, layout)
    if schema is not None:
        check_schema(spark, folder, schema)

    def ordered(result: DataFrame) -> DataFrame:
        result = result if read is None else read(result)
        return result.orderBy(*order_by) if order_by else result

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint")
    if trigger:
        writer = writer.trigger(**trigger)

    if mode == "append":
        query = writer.format(fmt).option("path", data).start()
        return RunningStream(query, lambda: ordered(spark.read.schema(df.schema).format(fmt).load(data)))
    if mode == "update":
        table = KeyedTable(spark, data, keys, df.schema, unique=True)
        return RunningStream(writer.foreachBatch(table.sink()).start(), lambda: ordered(table.rows()))

    last: list[tuple[int, StructType]] = []

    def store(batch: DataFrame, batch_id: int) -> None:
        result = batch if finish is None else finish(batch)
        slot = f"{data}/slot={batch_id % 2}"
        result.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(slot)
        last[:] = [(batch_id, result.schema)]

    query = writer.foreachBatch(store).start()
    return RunningStream(query, lambda: ordered(_last_result(spark, data, last)))


def run_stream(
    df: DataFrame,
    folder: str,
    mode: str = "append",
    *,
    keys: Sequence[str] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
    timeout: int | None = None,
    on_query: Callable[[StreamingQuery], None] | None = None,
    order_by: Sequence[Column | str] = (),
    layout: StateLayout | None = None,
    schema: StructType | None = None,
    read: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "parquet",
    progress: bool = False,
) -> DataFrame:
    """Drain the source of ``df`` into ``folder`` and read the result back.

    Other arguments are those of ``start_stream``. ``on_query`` sees the ended query.
    ``progress`` files every report below ``folder``, for ``stored_progress``.
    """
    log = ProgressFiles(df.sparkSession, folder) if progress else nullcontext()
    with log:
        running = start_stream(
            df, folder, mode, keys=keys, finish=finish, trigger=trigger_options(), order_by=order_by, layout=layout,
            schema=schema, read=read, fmt=fmt,
        )
        await_end(running.query, timeout)
    if on_query is not None:
        on_query(running.query)
    return running.result()


def _last_result(spark: SparkSession, data: str, last: list[tuple[int, StructType]]) -> DataFrame:
    if last:
        batch_id, schema = last[0]
        stored = StructType(schema.fields + [StructField(BATCH, LongType())])
        return spark.read.schema(stored).parquet(f"{data}/slot={batch_id % 2}").drop(BATCH)
    # Resumed with nothing new: the stored slots tell which batch was the last.
    slots = spark.read.parquet(data)
    newest = slots.agg(F.max(BATCH)).first()[0]
    return slots.where(F.col(BATCH) == newest).drop(BATCH, "slot")
