import time

import pytest
from frames import as_stream, rows
from pyspark.sql import functions as F

import samples
from millrace import operators as op
from millrace.schemas import CARS
from millrace.session import run_folder, shared_folder
from millrace.sources import json_stream, lines_stream
from millrace.streaming import (
    KeyedTable,
    await_end,
    run_stream,
    start_stream,
    trigger_options,
    watch,
)


@pytest.fixture
def words(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "word STRING, n INT")


def test_append_refuses_an_aggregate_without_watermark(spark, words, tmp_path):
    with pytest.raises(Exception, match="(?i)not supported|unsupported"):
        run_stream(op.count_by(as_stream(spark, words, tmp_path), "word"), str(tmp_path / "run"))


def test_complete_refuses_a_query_without_aggregate(spark, words, tmp_path):
    with pytest.raises(Exception, match="(?i)not supported|unsupported"):
        run_stream(as_stream(spark, words, tmp_path), str(tmp_path / "run"), "complete")


def test_update_without_aggregate_equals_append(spark, words, tmp_path):
    stream = as_stream(spark, words, tmp_path).where("n > 1")
    by_update = run_stream(stream, str(tmp_path / "u"), "update", keys=["word", "n"])
    assert rows(by_update) == rows(run_stream(stream, str(tmp_path / "a"))) == [("a", 3), ("b", 2)]


def test_arguments_are_checked(spark, words, tmp_path):
    stream = as_stream(spark, words, tmp_path)
    with pytest.raises(ValueError, match="key columns"):
        run_stream(stream, str(tmp_path / "run"), "update")
    with pytest.raises(ValueError, match="unknown output mode"):
        run_stream(stream, str(tmp_path / "run"), "upsert")
    with pytest.raises(ValueError, match="complete mode only"):
        run_stream(stream, str(tmp_path / "run"), finish=lambda df: df)


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_many_batches_give_the_same_result_as_one(spark, tmp_path, mode):
    frame = spark.range(200).selectExpr("id % 7 as k", "id as v")
    path = str(tmp_path / "in")
    frame.repartition(4).write.parquet(path)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)
    batches = []
    totals = stream.groupBy("k").agg(F.sum("v").alias("total"))
    stored = run_stream(
        totals, str(tmp_path / "run"), mode, keys=["k"], on_query=lambda q: batches.append(q.lastProgress.batchId)
    )
    assert rows(stored) == rows(frame.groupBy("k").agg(F.sum("v").alias("total")))
    assert batches[0] >= 3


@pytest.mark.parametrize("mode", ["append", "update", "complete"])
def test_resume(spark, drop, tmp_path, mode):
    """A rerun adds nothing, an edited file is not read again, a new file is."""

    def run(place="run"):
        cars = json_stream(spark, drop.folder, CARS).select("Name")
        stream = cars if mode == "append" else op.count_by(cars, "Name")
        return run_stream(stream, str(tmp_path / place), mode, keys=["Name"]).count()

    name = "first.json"
    drop(samples.REVISED_CAR, name)
    assert run() == 1
    assert run() == 1
    drop(samples.REVISED_CAR + samples.CARS, name)  # same path, later time stamp, more rows
    edited = run()
    drop(samples.REVISED_CAR.replace("Revised", "New file"), "second.json")
    assert run() == edited + 1
    assert edited == 1
    assert run("fresh") == 5  # without the old checkpoint everything is read


def test_trigger_options():
    assert trigger_options("default") == {}
    assert trigger_options() == {"availableNow": True}
    assert trigger_options("once") == {"once": True}
    assert trigger_options("processing_time", "2 seconds") == {"processingTime": "2 seconds"}
    assert trigger_options("continuous", "2 seconds") == {"continuous": "2 seconds"}
    with pytest.raises(ValueError, match="interval"):
        trigger_options("continuous")
    with pytest.raises(ValueError, match="unknown trigger"):
        trigger_options("never")


@pytest.mark.parametrize("kind", ["default", "available_now", "once", "processing_time"])
def test_triggers_on_files(spark, words, tmp_path, kind):
    options = trigger_options(kind, "1 seconds" if kind == "processing_time" else None)
    writer = as_stream(spark, words, tmp_path).writeStream.format("memory").queryName(f"out_{kind}")
    query = (writer.trigger(**options) if options else writer).start()
    if kind in ("default", "processing_time"):
        query.processAllAvailable()
        query.stop()
    else:
        await_end(query, 60)
    assert spark.table(f"out_{kind}").count() == 3


def _rate(spark):
    return spark.readStream.format("rate").option("rowsPerSecond", 5).load()


def test_continuous_trigger(spark, tmp_path):
    query = (
        _rate(spark).where("value >= 0").writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(**trigger_options("continuous", "1 second")).start()
    )
    time.sleep(2)
    assert query.isActive and query.exception() is None
    query.stop()


def test_continuous_trigger_refuses_an_aggregate(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)continuous processing does not support|not supported|unsupported"):
        op.count_by(_rate(spark), "value").writeStream.format("noop").outputMode("complete").option(
            "checkpointLocation", str(tmp_path / "c")
        ).trigger(**trigger_options("continuous", "1 second")).start()


def test_waiting_is_bounded(spark, tmp_path):
    query = _rate(spark).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).start()
    with pytest.raises(TimeoutError):
        await_end(query, 1)
    assert not query.isActive


@pytest.mark.parametrize("mode", ["append", "update", "complete"])
def test_a_running_stream_can_be_read(spark, drop, tmp_path, mode):
    drop("a\nb\na\n")
    lines = lines_stream(spark, "text", drop.folder)
    stream = lines if mode == "append" else op.count_by(lines, "value")
    running = start_stream(
        stream, str(tmp_path / "run"), mode, keys=["value"], trigger=trigger_options("processing_time", "200 milliseconds")
    )
    try:
        running.query.processAllAvailable()
        assert rows(running.result()) == ([("a",), ("a",), ("b",)] if mode == "append" else [("a", 2), ("b", 1)])
        drop("b\n")
        running.query.processAllAvailable()
        assert rows(running.result()) == ([("a",)] * 2 + [("b",)] * 2 if mode == "append" else [("a", 2), ("b", 2)])
        seen = []
        watch(running.query, times=2, every=0.05, show=seen.append)
        assert len(seen) == 2
    finally:
        running.query.stop()


def test_file_sink_is_append_only(spark, words, tmp_path):
    stream = op.count_by(as_stream(spark, words, tmp_path), "word")
    with pytest.raises(Exception, match="(?i)does not support|UNSUPPORTED"):
        stream.writeStream.format("parquet").outputMode("complete").option(
            "checkpointLocation", str(tmp_path / "c")
        ).start(str(tmp_path / "o"))


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_file_sinks(spark, words, tmp_path, fmt):
    query = (
        as_stream(spark, words, tmp_path).writeStream.format(fmt)
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "o"))
    )
    await_end(query, 60)
    assert rows(spark.read.schema(words.schema).format(fmt).load(str(tmp_path / "o"))) == rows(words)


def test_run_folders_lie_in_the_shared_folder(spark):
    first, second = run_folder(spark, "x"), run_folder(spark, "x")
    assert first != second
    assert first.startswith(shared_folder(spark)) and shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_streaming_flag(spark, drop):
    drop("x\n")
    assert lines_stream(spark, "text", drop.folder).isStreaming
    assert not spark.range(1).isStreaming


def test_a_batch_repeated_after_a_crash_changes_nothing(spark, words, tmp_path):
    """The table is written, the driver fails before the commit, the batch comes again."""
    stream, data = as_stream(spark, words, tmp_path), str(tmp_path / "data")
    keyed, crash = KeyedTable(spark, data, ["word"], words.schema, ["n"]), [True]

    def flaky(batch, batch_id):
        keyed.write(batch, batch_id)
        if crash:
            crash.pop()
            raise RuntimeError("driver lost")

    def run():
        writer = stream.writeStream.foreachBatch(flaky).option("checkpointLocation", str(tmp_path / "c"))
        await_end(writer.trigger(availableNow=True).start(), 60)

    with pytest.raises(Exception, match="driver lost"):
        run()
    run()
    assert rows(keyed.rows()) == [("a", 3), ("b", 2)]
    assert spark.read.parquet(f"{data}/log").count() == 2


def test_a_failed_complete_batch_is_done_again(spark, words, tmp_path):
    crash = [True]

    def finish(batch):
        if crash:
            crash.pop()
            raise RuntimeError("driver lost")
        return batch

    counts = op.count_by(as_stream(spark, words, tmp_path), "word")
    with pytest.raises(Exception, match="driver lost"):
        run_stream(counts, str(tmp_path / "run"), "complete", finish=finish)
    assert rows(run_stream(counts, str(tmp_path / "run"), "complete", finish=finish)) == [("a", 2), ("b", 1)]
