"""Aggregates. All combine inside each task before anything is shuffled, so a hot
group costs one row per task and not a third of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_of(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.avg(column).alias(name))


def spread_stats(df: DataFrame, column: str) -> DataFrame:
    """Sum, mean, sample standard deviation, minimum and maximum in one pass."""
    return df.agg(
        F.sum(column).alias("total"),
        F.mean(column).alias("mean"),
        F.stddev(column).alias("stddev"),
        F.min(column).alias("least"),
        F.max(column).alias("greatest"),
    )


def count_by(df: DataFrame, *columns: str, name: str = "count") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, condition: Column, name: str = "count") -> DataFrame:
    """How many rows satisfy ``condition``; one row even when none does."""
    return df.where(condition).agg(F.count(F.lit(1)).alias(name))
