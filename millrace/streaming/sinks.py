"""Sinks beyond the built-in file formats."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from millrace.session import entries, move_path, path_exists, write_text

BatchWriter = Callable[[DataFrame, int], None]


def console_sink(df: DataFrame, mode: str = "append", **options: object) -> DataStreamWriter:
    """Print each micro-batch on the driver's console; for looking, not for volume."""
    return df.writeStream.format("console").outputMode(mode).options(**options)


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Write ``key``/``value`` rows to a topic. The checkpoint is mandatory."""
    _check_messages(df)
    if not checkpoint:
        raise ValueError("a Kafka sink needs a checkpoint location")
    return (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def kafka_batch_write(df: DataFrame, servers: str, topic: str) -> None:
    """Produce a bounded frame of messages, waiting for all replicas."""
    _check_messages(df)
    (
        df.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def _check_messages(df: DataFrame) -> None:
    types = dict(df.dtypes)
    if "value" not in types:
        raise ValueError("a message frame needs a value column")
    for name in ("key", "value"):
        if types.get(name, "string") not in ("string", "binary"):
            raise ValueError(f"message column {name} must be string or binary, not {types[name]}")


def jdbc_sink(
    url: str,
    table: str,
    *,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    max_connections: int | None = None,
    rows_per_insert: int = 10_000,
    batch_column: str | None = None,
) -> BatchWriter:
    """``foreachBatch`` body that appends each micro-batch to a database table.

    Executors write in parallel, one connection per partition. ``max_connections`` limits
    them by joining partitions, which slows large batches down. A batch may be repeated after a crash; with
    ``batch_column`` the batch number is stored so that the reader can tell.
    """
    options: dict[str, object] = {
        "url": url,
        "dbtable": table,
        "batchsize": rows_per_insert,
    }
    for name, value in (("driver", driver), ("user", user), ("password", password), ("numPartitions", max_connections)):
        if value is not None:
            options[name] = value

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_column is not None:
            batch = batch.withColumn(batch_column, F.lit(batch_id))
        batch.write.format("jdbc").mode("append").options(**options).save()

    return write


def cassandra_sink(
    keyspace: str, table: str, columns: Sequence[str], *, host: str = "localhost", port: int = 9042, **options: object
) -> BatchWriter:
    """``foreachBatch`` body that appends chosen columns to a Cassandra table.

    Needs the connector package. Cassandra overwrites by primary key, so a
    repeated batch changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.select(*columns)
            .write.format("org.apache.spark.sql.cassandra")
            .option("spark.cassandra.connection.host", host)
            .option("spark.cassandra.connection.port", str(port))
            .options(keyspace=keyspace, table=table, **options)
            .mode("append")
            .save()
        )

    return write


class Connection(Protocol):
    """What a row writer needs from the system it writes to.

    ``commit`` may return a message, such as the name of the file it has written.
    """

    def write(self, rows: Sequence[Row]) -> None: ...

    def commit(self) -> str | None: ...

    def abort(self) -> None: ...


class RowWriter:
    """Custom sink for ``writeStream.foreach``: one connection per partition and batch.

    ``connect(partition_id, batch_id)`` runs on the executor. It returns a
    ``Connection``, or None to skip a chunk that is already stored. Rows travel in
    groups of ``group_size``, never more than that in memory.
    """

    def __init__(self, connect: Callable[[int, int], Connection | None], group_size: int = 1000) -> None:
        self._connect = connect
        self._group_size = group_size
        self._connection: Connection | None = None
        self._pending: list[Row] = []

    def open(self, partition_id: int, batch_id: int) -> bool:
        self._connection = self._connect(partition_id, batch_id)
        self._pending = []
        return self._connection is not None

    def process(self, row: Row) -> None:
        self._pending.append(row)
        if len(self._pending) >= self._group_size:
            self._flush()

    def close(self, error: BaseException | None) -> str | None:
        if self._connection is None:
            return None
        if error is not None:
            self._connection.abort()
            return None
        try:
            self._flush()
            return self._connection.commit()
        except Exception:
            self._connection.abort()
            raise

    def _flush(self) -> None:
        if self._pending:
            self._connection.write(self._pending)
            self._pending = []


class InsertConnection:
    """Rows into a table through a DB-API connection, values bound as parameters.

    Names are fixed text from the query author; row values never enter the
    statement, so quotes in them are harmless.
    """

    def __init__(self, db: Any, table: str, columns: Sequence[str], mark: str = "?") -> None:
        self._db = db
        self._columns = list(columns)
        names = ", ".join(f'"{name}"' for name in columns)
        marks = ", ".join(mark for _ in columns)
        self._statement = f"INSERT INTO {table} ({names}) VALUES ({marks})"

    def write(self, rows: Sequence[Row]) -> None:
        cursor = self._db.cursor()
        cursor.executemany(self._statement, [tuple(row[name] for name in self._columns) for row in rows])
        cursor.close()

    def commit(self) -> None:
        self._db.commit()
        self._db.close()

    def abort(self) -> None:
        self._db.rollback()
        self._db.close()


class ParquetConnection:
    """Rows into one Parquet file per partition and batch below a shared folder.

    ``folder`` is a full URI (``full_uri``), so that every executor writes to the shared
    file system. The file gets its name only on commit. Used by ``writeStream.foreach``, the
    same chunk repeated takes the same name, but a batch repeated with other partitions leaves
    the files of both tries. With ``once`` each try has names of its own, for an
    ``EpochSink``, which lists those that count.
    """

    def __init__(self, folder: str, schema: Any, partition_id: int, batch_id: int, *, once: bool = False) -> None:
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem

        if ":/" not in folder:
            raise ValueError(f"{folder} names no file system; pass full_uri(spark, folder)")
        if folder.startswith("file:"):
            folder = "file:///" + folder.removeprefix("file:").lstrip("/")
        self._fs, base = FileSystem.from_uri(folder)
        self._fs.create_dir(base, recursive=True)
        mark = uuid.uuid4().hex
        name = f"batch-{batch_id}-part-{partition_id}{'-' + mark if once else ''}.parquet"
        self._file, self._target, self._draft = f"{folder}/{name}", f"{base}/{name}", f"{base}/_draft-{mark}"
        self._schema = schema
        self._writer = pq.ParquetWriter(self._draft, schema, filesystem=self._fs)

    def write(self, rows: Sequence[Row]) -> None:
        import pyarrow as pa

        self._writer.write_table(pa.Table.from_pylist([row.asDict() for row in rows], self._schema))

    def commit(self) -> str:
        self._writer.close()
        self._fs.move(self._draft, self._target)
        return self._file

    def abort(self) -> None:
        self._writer.close()
        self._fs.delete_file(self._draft)


class EpochSink:
    """``foreachBatch`` body that runs a row writer and publishes each batch as a whole.

    Every partition of a batch goes through ``connect`` as in ``writeStream.foreach``; rows
    come from Arrow, times with their zone. What the commits return is collected, one short
    text per partition, and stored as the batch's list below ``folder``. A batch counts from
    the moment its list is there: files of lost, repeated or speculative tasks and of batches
    that broke off are on no list, and a batch that has one is not written again. Readers go
    by the lists (``published``).
    """

    def __init__(
        self, spark: SparkSession, folder: str, connect: Callable[[int, int], Connection | None], group_size: int = 1000
    ) -> None:
        self._spark, self._folder, self._connect, self._group_size = spark, folder, connect, group_size

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if not path_exists(self._spark, self._list(batch_id)):
            self.publish(batch_id, self.write(batch, batch_id))

    def _list(self, batch_id: int) -> str:
        return f"{self._folder}/_epochs/{batch_id}.json"

    def write(self, batch: DataFrame, batch_id: int) -> list[str]:
        """Run the writer over the batch without publishing it; returns the messages."""
        connect, group_size = self._connect, self._group_size

        def run(batches: Iterator[Any]) -> Iterator[Any]:
            import pyarrow as pa
            from pyspark import TaskContext

            writer = RowWriter(connect, group_size)
            if not writer.open(TaskContext.get().partitionId(), batch_id):
                return
            try:
                for part in batches:
                    for row in part.to_pylist():
                        writer.process(Row(**row))
            except BaseException as error:
                writer.close(error)
                raise
            yield pa.RecordBatch.from_arrays([pa.array([writer.close(None)], pa.string())], ["message"])

        return sorted(r.message for r in batch.mapInArrow(run, "message string").collect() if r.message is not None)

    def publish(self, batch_id: int, messages: Sequence[str]) -> None:
        draft = f"{self._folder}/_epochs/_draft-{uuid.uuid4().hex}"
        write_text(self._spark, draft, json.dumps({"batch": batch_id, "messages": list(messages)}))
        move_path(self._spark, draft, self._list(batch_id))


def published(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The rows of all published batches of an ``EpochSink`` whose messages are file names."""
    if not any(name.endswith(".json") for name in entries(spark, f"{folder}/_epochs")):
        return spark.createDataFrame([], schema)
    lists = spark.read.schema("batch long, messages array<string>").json(f"{folder}/_epochs/*.json")
    files = [row.file for row in lists.select(F.explode("messages").alias("file")).collect()]
    return spark.read.schema(schema).format(fmt).load(files) if files else spark.createDataFrame([], schema)
