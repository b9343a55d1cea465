"""Reading input tables and cutting lineage with written ones."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import run_folder


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table written below the shared folder and read back.

    Later jobs read the files, so a lost executor costs no earlier step.
    """
    path = run_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted(rows: DataFrame, keys: list[str], *values: Column) -> DataFrame:
    """Aggregates of keys with several rows, with a copy for every salt that the key's rows have.

    Rows join on the keys and ``_salt`` and are spread over as many groups, however many of
    them share one key. A key has at most as many copies as rows, and as there are salts.
    """
    parts = rows.groupBy(*keys).agg(*values, F.collect_set("_salt").alias("_salts"), F.count(F.lit(1)).alias("_rows"))
    return parts.where("_rows > 1").drop("_rows").withColumn("_salt", F.explode("_salts")).drop("_salts")


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """The rows with a number of their own in column ``name``, the same whenever they are read.

    The number is the place in the Parquet files the rows come from: the file's rank by path
    and the row's index in it (up to 2**40). Rows that come from elsewhere are written first;
    steps in between must not copy rows. The list of files, one short row each, is sent to
    the executors; it is as long as Spark's own list of them. An empty table stays empty.
    """
    try:
        rows.select("_metadata.row_index")
    except AnalysisException:
        rows = saved(rows, "numbered")
    paths = rows.select(F.col("_metadata.file_path").alias("_path")).distinct()
    ranks = paths.select("_path", (F.row_number().over(Window.orderBy("_path")) - 1).cast("long").alias("_rank"))
    placed = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_index"))
    return placed.join(F.broadcast(ranks), "_path").withColumn(name, F.col("_rank") * (1 << 40) + F.col("_index")).drop("_path", "_rank", "_index")


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], schema: str
) -> DataFrame:
    """Run a batch function over the frame; ``make`` sets it up once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)


def zipped(df: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns with each text compressed, for tables that travel through joins."""

    def make():
        from zstandard import ZstdCompressor

        press = ZstdCompressor(level=3).compress

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            body = [press((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(body, pa.binary())], [key, text])

        return work

    rows = df.select(key, text)
    return map_batches(rows, make, f"`{key}` {rows.schema[key].dataType.simpleString()}, `{text}` binary")


def unzipped(column: pa.Array) -> pa.Array:
    """Texts compressed by ``zipped``, as bytes."""
    from zstandard import ZstdDecompressor

    open_ = ZstdDecompressor().decompress
    return pa.array([open_(b) for b in column.to_pylist()], pa.large_binary())
