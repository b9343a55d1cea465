"""File, socket and generated sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.schemas import STOCK_DATE_FORMAT, STOCKS


def read_table(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: StructType | str | None = None,
    *,
    stream: bool = False,
    **options: object,
) -> DataFrame:
    """One spelling for every load: any format, bounded or streaming.

    ``path`` may also be given as an option, as some connectors want it.
    """
    reader = (spark.readStream if stream else spark.read).format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def lines_stream(spark: SparkSession, fmt: str = "text", path: str | None = None, **options: object) -> DataFrame:
    """Stream of text lines in one ``value`` column.

    ``text`` follows a folder of files; ``socket`` takes ``host`` and ``port``.
    """
    return read_table(spark, fmt, path, stream=True, **options)


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str = STOCKS,
    *,
    header: bool = False,
    date_format: str = STOCK_DATE_FORMAT,
    **options: object,
) -> DataFrame:
    """Stream of CSV files with a fixed schema and a custom date format."""
    return read_table(
        spark, "csv", path, schema, stream=True, header=header, dateFormat=date_format, **options
    )


def json_stream(spark: SparkSession, path: str, schema: StructType | str, **options: object) -> DataFrame:
    """Stream of JSON-lines files with a fixed schema."""
    return read_table(spark, "json", path, schema, stream=True, **options)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Bounded read of one Parquet table stored below ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """The same table as a stream.

    It reads the location that ``table`` reads, a file or a folder of part files. The
    path is a glob because a stream cannot start from a plain file path. The schema comes
    from the table's footer, since streams do not infer one. ``max_bytes_per_trigger``
    cuts a large backlog into micro-batches of bounded size.
    """
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(f"{folder}/{{{name}.parquet}}")


def numbers(spark: SparkSession, count: int, column: str = "number") -> DataFrame:
    """1..count as a distributed range; nothing is shipped from the driver."""
    return spark.range(1, count + 1).toDF(column)
