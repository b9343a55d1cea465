"""Kafka source. The connector package must be on the session's classpath."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.files import read_table


def kafka_stream_options(
    servers: str | Sequence[str], topics: str | Sequence[str], **extra: object
) -> dict[str, object]:
    """Reader options: brokers and topics are comma-separated lists."""
    brokers = servers if isinstance(servers, str) else ",".join(servers)
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    names = [name.strip() for name in names if name.strip()]
    if not brokers or not names:
        raise ValueError("a Kafka stream needs at least one broker and one topic")
    return {"kafka.bootstrap.servers": brokers, "subscribe": ",".join(names), **extra}


def kafka_stream(
    spark: SparkSession, servers: str | Sequence[str], topics: str | Sequence[str], **extra: object
) -> DataFrame:
    """Unbounded frame of Kafka rows (see ``schemas.KAFKA_ROW``)."""
    return read_table(spark, "kafka", stream=True, **kafka_stream_options(servers, topics, **extra))
