"""Typed records: JSON parsing, struct expansion, schema conformance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_records(df: DataFrame, schema: StructType | str, name: str, column: str = "value") -> DataFrame:
    """Parse a JSON text column into one struct column called ``name``.

    Unparseable text gives a struct of nulls, null text gives null, and one bad
    field nulls only that field.
    """
    return df.select(F.from_json(column, schema).alias(name))


def expand(df: DataFrame, struct: str) -> DataFrame:
    """All fields of a struct column as top-level columns."""
    return df.select(f"{struct}.*")


def pick_fields(df: DataFrame, struct: str, fields: Mapping[str, str]) -> DataFrame:
    """Chosen struct fields, given as ``{field: new name}``."""
    return df.select(*(F.col(struct).getField(field).alias(name) for field, name in fields.items()))


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """View ``df`` as ``schema``: its columns only, in its order, cast to its types.

    Casts are strict under ANSI mode. A missing column is an error, as it is for a
    typed encoder.
    """
    target = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    missing = [field.name for field in target if field.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the typed view: {', '.join(missing)}")
    return df.select(*(F.col(field.name).cast(field.dataType).alias(field.name) for field in target))
