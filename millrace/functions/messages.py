"""Key/value message frames, the shape a message broker reads and writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import UNDEFINED_KEY


def decode_kafka(df: DataFrame) -> DataFrame:
    """Topic, text of the value, timestamp and its type; key and offsets are pruned."""
    return df.select(
        "topic", F.col("value").cast("string").alias("stringValue"), "timestamp", "timestampType"
    )


def to_kv(df: DataFrame, column: str) -> DataFrame:
    """Upper-cased name as the key, the name itself as the value."""
    return df.select(F.upper(column).alias("key"), F.col(column).alias("value"))


def to_json_kv(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Upper-cased key and a JSON object of ``fields``; null fields are left out."""
    return df.select(F.upper(key).alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def keyed_messages(df: DataFrame, message: str | Column, key: str | Column | None = None) -> DataFrame:
    """Messages with an optional key; rows without one get the default key."""
    given = F.lit(None).cast("string") if key is None else (F.col(key) if isinstance(key, str) else key)
    body = F.col(message) if isinstance(message, str) else message
    return df.select(
        F.coalesce(given.cast("string"), F.lit(UNDEFINED_KEY)).alias("key"),
        body.cast("string").alias("value"),
    )
