"""SQL text over named frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, views: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Run ``sql`` with each frame visible under its name; streams give a stream."""
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(sql)
