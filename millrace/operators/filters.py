"""Row filters. Plain predicates, so they reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def differs_from(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column is known and not ``value``; null rows drop out."""
    return df.where(F.col(column) != F.lit(value))


def above(df: DataFrame, column: str, limit: float, default: float = 0) -> DataFrame:
    """Rows above ``limit``, reading a missing number as ``default``.

    Where the default would not pass anyway, the null test is left out: the bare
    comparison can be pushed into the scan, ``coalesce`` cannot.
    """
    number = F.col(column)
    if default > limit:
        number = F.coalesce(number, F.lit(default))
    return df.where(number > limit)
