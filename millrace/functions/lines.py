"""Text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def short_lines(df: DataFrame, max_chars: int = 5, column: str = "value") -> DataFrame:
    """Keep lines of at most ``max_chars`` characters."""
    return df.where(F.length(column) <= max_chars)


def parse_lines(df: DataFrame, mode: str = "fail", column: str = "value") -> DataFrame:
    """Split ``epoch_ms,color`` lines into ``created`` and ``color``.

    A malformed line (no second field, or a first field that is not a whole
    number) stops the query in ``fail`` mode and gives nulls in ``null`` mode.
    Further fields are ignored, trailing empty ones do not count.
    """
    if mode not in ("fail", "null"):
        raise ValueError(f"mode must be 'fail' or 'null', not {mode!r}")
    fields = F.split(F.regexp_replace(column, ",+$", ""), ",")
    millis = F.when(F.get(fields, 0).rlike("^[+-]?[0-9]+$"), F.get(fields, 0).try_cast("bigint"))
    color = F.get(fields, 1)
    if mode == "fail":
        complaint = F.raise_error(F.concat(F.lit("malformed line: "), F.coalesce(F.col(column), F.lit("null"))))
        millis = F.coalesce(millis, complaint.cast("bigint"))
        color = F.coalesce(color, complaint.cast("string"))
    return df.select(F.timestamp_millis(millis), color).toDF("created", "color")
