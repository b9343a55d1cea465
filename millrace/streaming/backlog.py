"""A stored table as a stream that sees it one stretch of time after the other.

A query with a watermark must not meet rows of an old file after those of a new one, so its
backlog is cut by time first. One pass over the table writes all slices. They are fed by
moving their files into the watched folder: each is drained, moved out again, and the next
one follows over the same checkpoint. The watermark moves on in between, so that state holds
one slice and not the table.

Below one folder: ``slices/`` (written, not yet fed), ``in/`` (watched), ``done/`` (fed) and
``manifest`` (one row per slice with its rows and bounds).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.session import make_folder, move_path, path_exists

SLICE = "_slice"
SLICE_ROWS, LEAST_SLICES = 100_000_000, 3
CELLS_PER_SLICE, MOST_CELLS = 64, 1 << 20

Result = TypeVar("Result")


def number_by_time(df: DataFrame, time: str, rows_each: int = SLICE_ROWS, least: int = LEAST_SLICES) -> DataFrame:
    """Adds the number of the stretch of time that a row falls in, of about ``rows_each`` rows.

    Equal times share a slice, and slices follow each other in time. The span of the table is
    divided into cells of equal length, whose rows are counted from the time column alone;
    neighbouring cells make up a slice. A cell is never divided, so a moment with very many
    rows makes its slice larger. At most 2**20 cells are looked up, whatever the table's size.
    Rows without a time go into the first slice.
    """
    at = F.unix_micros(F.col(time).cast("timestamp"))
    low, high, rows = df.agg(F.min(at), F.max(at), F.count(at)).first()
    if not rows:
        return df.withColumn(SLICE, F.lit(0).cast("long"))
    slices = max(least, -(-rows // rows_each))
    width = -(-(high - low + 1) // min(slices * CELLS_PER_SLICE, MOST_CELLS))
    cell = F.expr(f"(unix_micros(cast(`{time}` as timestamp)) - {low}L) div {width}L")
    counts = df.where(F.col(time).isNotNull()).groupBy(cell.alias("cell")).count().orderBy("cell").collect()
    before, places = 0, []
    for row in counts:
        places.append((row.cell, before * slices // rows))
        before += row["count"]
    lookup = df.sparkSession.createDataFrame(places, f"_cell long, {SLICE} long")
    found = df.withColumn("_cell", cell).join(F.broadcast(lookup), "_cell", "left").drop("_cell")
    return found.withColumn(SLICE, F.coalesce(SLICE, F.lit(0)))


def write_slices(numbered: DataFrame, time: str, folder: str) -> None:
    """Write a frame with slice numbers, all slices in one pass, and then their manifest.

    Rows are dealt by slice, and adaptive execution splits a slice over as many tasks as its
    size asks for.
    """
    spark = numbered.sparkSession
    numbered.hint("rebalance", F.col(SLICE)).write.partitionBy(SLICE).parquet(f"{folder}/slices")
    fields = [f for f in numbered.schema.fields if f.name != SLICE]
    stored = spark.read.schema(StructType([*fields, StructField(SLICE, LongType())])).parquet(f"{folder}/slices")
    bounds = [F.count(F.lit(1)).alias("rows"), F.min(time).alias("low"), F.max(time).alias("high")]
    stored.groupBy(SLICE).agg(*bounds).coalesce(1).write.parquet(f"{folder}/manifest")


def slice_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Number, rows and first and last time of each slice."""
    return spark.read.parquet(f"{folder}/manifest").orderBy(SLICE)


def sliced_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The watched folder as a stream. Files keep the time they were written, however late they are fed."""
    reader = spark.readStream.schema(schema).options(recursiveFileLookup=True, maxFileAge="36500d")
    make_folder(spark, f"{folder}/in")
    return reader.parquet(f"{folder}/in")


def feed_slices(spark: SparkSession, folder: str, run: Callable[[], Result]) -> Result:
    """Call ``run``, which drains the stream, once for each slice in order; returns what the last call did.

    A slice stays in the watched folder until its run has ended, so a feed that broke off
    goes on where it was: rows that are in the checkpoint's log are not read twice.
    """
    result, ran = None, False
    for row in slice_manifest(spark, folder).select(SLICE).collect():
        name = row[SLICE]
        if path_exists(spark, f"{folder}/slices/{SLICE}={name}"):
            move_path(spark, f"{folder}/slices/{SLICE}={name}", f"{folder}/in/{name}")
        if path_exists(spark, f"{folder}/in/{name}"):
            result, ran = run(), True
            move_path(spark, f"{folder}/in/{name}", f"{folder}/done/{name}")
    return result if ran else run()
