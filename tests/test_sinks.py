import pytest
from frames import as_stream, rows
from pyspark.sql import Row

from millrace import functions as fn
from millrace.schemas import PURCHASES
from millrace.streaming import (
    EpochSink,
    RowWriter,
    cassandra_sink,
    console_sink,
    jdbc_sink,
    kafka_batch_write,
    kafka_sink,
    published,
)
from millrace.session import full_uri
from millrace.streaming.runner import await_end
from millrace.streaming.sinks import InsertConnection, ParquetConnection


@pytest.fixture
def cars(spark):
    return spark.createDataFrame([("a", 90), ("b", None), ("it's", 52)], "Name STRING, Horsepower BIGINT")


@pytest.mark.parametrize("mode", ["append", "complete"])
def test_console(spark, cars, tmp_path, mode):
    stream = as_stream(spark, cars, tmp_path)
    if mode == "complete":
        stream = stream.groupBy("Name").count()
    query = console_sink(stream, mode, truncate=False).trigger(availableNow=True).start()
    await_end(query, 60)
    assert "Console" in query.lastProgress.sink.description
    assert sum(report.numInputRows for report in query.recentProgress) == 3


def test_kafka_sink_checks_its_frame(spark, cars, tmp_path):
    stream = as_stream(spark, cars, tmp_path)
    with pytest.raises(ValueError, match="value column"):
        kafka_sink(stream, "h:1", "t", "/c")
    with pytest.raises(ValueError, match="checkpoint"):
        kafka_sink(fn.to_kv(stream, "Name"), "h:1", "t", "")
    with pytest.raises(ValueError, match="string or binary"):
        kafka_sink(stream.selectExpr("Horsepower as value"), "h:1", "t", "/c")
    with pytest.raises(Exception, match="(?i)failed to find data source: kafka"):
        kafka_sink(fn.to_kv(stream, "Name"), "h:1", "t", str(tmp_path / "c")).start()
    with pytest.raises(Exception, match="(?i)failed to find data source: kafka"):
        kafka_batch_write(fn.keyed_messages(cars, "Name"), "h:1", "t")


class Recorder:
    """Stands in for a batch frame and notes what is asked of its writer."""

    def __init__(self):
        self.calls = {}

    write = property(lambda self: self)

    def select(self, *names):
        self.calls["select"] = names
        return self

    def withColumn(self, name, value):
        self.calls["column"] = name
        return self

    def format(self, name):
        self.calls["format"] = name
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def options(self, **options):
        self.calls.setdefault("options", {}).update(options)
        return self

    def save(self):
        self.calls["saved"] = True


def test_jdbc_sink_appends_each_batch():
    batch = Recorder()
    jdbc_sink("jdbc:x", "public.cars", driver="d", user="u", password="p", batch_column="batch")(batch, 3)
    assert batch.calls == {
        "column": "batch",
        "format": "jdbc",
        "mode": "append",
        "options": {
            "url": "jdbc:x", "dbtable": "public.cars", "batchsize": 10_000,
            "driver": "d", "user": "u", "password": "p",
        },
        "saved": True,
    }


def test_jdbc_sink_fails_the_stream_without_a_driver(spark, cars, tmp_path):
    sink = jdbc_sink("jdbc:postgresql://localhost/none", "cars", driver="org.postgresql.Driver")
    query = as_stream(spark, cars, tmp_path).writeStream.foreachBatch(sink).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="org.postgresql.Driver"):
        await_end(query, 60)


def test_jdbc_cannot_be_streamed_to(spark, cars, tmp_path):
    with pytest.raises(Exception, match="does not support streamed writing"):
        as_stream(spark, cars, tmp_path).writeStream.format("jdbc").option(
            "checkpointLocation", str(tmp_path / "c")
        ).start()


def test_cassandra_sink_projects_and_appends(cars):
    batch = Recorder()
    cassandra_sink("public", "cars", ["Name", "Horsepower"])(batch, 0)
    assert batch.calls["select"] == ("Name", "Horsepower")
    assert batch.calls["format"] == "org.apache.spark.sql.cassandra" and batch.calls["mode"] == "append"
    assert batch.calls["options"] == {
        "spark.cassandra.connection.host": "localhost", "spark.cassandra.connection.port": "9042",
        "keyspace": "public", "table": "cars",
    }
    with pytest.raises(Exception, match="(?i)failed to find"):
        cassandra_sink("public", "cars", ["Name"])(cars, 0)


class FakeDb:
    def __init__(self):
        self.statements, self.state = [], []

    def cursor(self):
        return self

    def executemany(self, statement, values):
        self.statements.append((statement, values))

    def commit(self):
        self.state.append("commit")

    def rollback(self):
        self.state.append("rollback")

    def close(self):
        self.state.append("close")


def test_insert_connection_binds_values():
    db = FakeDb()
    writer = RowWriter(lambda part, batch: InsertConnection(db, "public.cars", ["Name", "Horsepower"]), group_size=2)
    assert writer.open(0, 0) is True
    for name in ("it's", 'a"b', "c"):
        writer.process(Row(Name=name, Horsepower=None, extra=1))
    writer.close(None)
    statement = 'INSERT INTO public.cars ("Name", "Horsepower") VALUES (?, ?)'
    assert db.statements == [(statement, [("it's", None), ('a"b', None)]), (statement, [("c", None)])]
    assert db.state[-2:] == ["commit", "close"]


def test_row_writer_rolls_back_and_skips():
    db = FakeDb()
    writer = RowWriter(lambda part, batch: InsertConnection(db, "t", ["x"]))
    writer.open(0, 0)
    writer.process(Row(x=1))
    writer.close(ValueError("task failed"))
    assert db.statements == [] and db.state == ["rollback", "close"]
    skipping = RowWriter(lambda part, batch: None)
    assert skipping.open(0, 0) is False
    skipping.close(None)


@pytest.mark.parametrize("form", ["file:{}", "file://{}"])
def test_row_writer_runs_once_per_partition_and_batch(form, spark, cars, tmp_path):
    import pyarrow as pa

    shape = pa.schema([("Name", pa.string()), ("Horsepower", pa.int64())])
    place = form.format(tmp_path / "o")
    path = str(tmp_path / "in")
    cars.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(cars.schema).option("maxFilesPerTrigger", 1).parquet(path)

    def run(checkpoint):
        writer = RowWriter(lambda part, batch: ParquetConnection(place, shape, part, batch))
        query = (
            stream.writeStream.foreach(writer).option("checkpointLocation", str(tmp_path / checkpoint))
            .trigger(availableNow=True).start()
        )
        await_end(query, 60)
        return rows(spark.read.schema(cars.schema).parquet(place))

    assert run("c") == rows(cars)
    assert run("c") == rows(cars)  # nothing new
    assert run("c2") == rows(cars)  # all batches repeated onto the same names


def car_files(spark, tmp_path):
    import pyarrow as pa

    shape, place = pa.schema([("Name", pa.string()), ("Horsepower", pa.int64())]), f"file:{tmp_path / 'o'}"
    return place, EpochSink(spark, place, lambda part, batch: ParquetConnection(place, shape, part, batch, once=True))


def test_a_batch_repeated_with_other_partitions_counts_once(spark, cars, tmp_path):
    """The writer is done with all partitions, the driver fails before the batch is published."""
    place, sink = car_files(spark, tmp_path)
    stream, tries = as_stream(spark, cars, tmp_path), []

    def flaky(batch, batch_id):
        tries.append(batch_id)
        if len(tries) == 1:
            assert len(sink.write(batch.repartition(3), batch_id)) == 3
            raise RuntimeError("driver lost")
        sink(batch.repartition(2), batch_id)
        if len(tries) == 2:
            raise RuntimeError("driver lost")  # published, but not committed by the stream

    for _ in range(2):
        query = stream.writeStream.foreachBatch(flaky).option("checkpointLocation", str(tmp_path / "c"))
        with pytest.raises(Exception, match="driver lost"):
            await_end(query.trigger(availableNow=True).start(), 60)
    await_end(query.trigger(availableNow=True).start(), 60)
    assert tries == [0, 0, 0] and rows(published(spark, place, cars.schema)) == rows(cars)
    assert spark.read.parquet(place).count() > 3  # files of the first try are there, but on no list


def test_failed_partitions_leave_nothing_published(spark, cars, tmp_path):
    place, _ = car_files(spark, tmp_path)
    empty = published(spark, place, cars.schema)
    assert rows(empty) == [] and empty.columns == cars.columns

    class Broken:
        def write(self, rows):
            raise ValueError("system is down")

        def commit(self):
            return "never"

        def abort(self):
            pass

    with pytest.raises(Exception, match="system is down"):
        EpochSink(spark, place, lambda part, batch: Broken())(cars, 0)
    EpochSink(spark, place, lambda part, batch: None)(cars, 1)  # all partitions skipped
    assert rows(published(spark, place, cars.schema)) == []


def test_row_writer_wants_a_full_uri(spark, tmp_path):
    with pytest.raises(ValueError, match="file system"):
        ParquetConnection(str(tmp_path), None, 0, 0)
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        assert full_uri(spark, path).startswith("file:/") and full_uri(spark, path).endswith(str(tmp_path))


def test_purchase_schema_is_readable(spark):
    assert spark.createDataFrame([], PURCHASES).columns == ["id", "time", "item", "quantity"]
