"""What a stream was first started with, kept beside its checkpoint: hot keys and schema.

Salts are part of the state's keys. A stream that resumes with other ones would not find
its stored rows, so the layout of the first start holds for the life of the folder. The
same goes for an inferred schema: inferred again on a restart it may differ, and records
would change their columns in the middle of the stream.
"""

from __future__ import annotations

import base64
import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from millrace.session import read_text, write_text

FILE, SCHEMA_FILE = "state_layout.json", "schema.json"

# How values that JSON does not know are written, and read again, by the name of their type.
_KINDS = {
    "bytes": (lambda v: base64.b64encode(v).decode(), base64.b64decode),
    "datetime": (lambda v: v.isoformat(), dt.datetime.fromisoformat),
    "date": (lambda v: v.isoformat(), dt.date.fromisoformat),
    "Decimal": (str, Decimal),
    "float": (repr, float),
}


def _stored(value: object) -> object:
    """A value with its type, unless JSON gives back just what it was."""
    if value is None or isinstance(value, bool | int | str):
        return value
    value = bytes(value) if isinstance(value, bytearray) else value
    kind = type(value).__name__
    if kind not in _KINDS:
        raise TypeError(f"keys of type {kind} cannot be kept beside a checkpoint")
    return {"type": kind, "value": _KINDS[kind][0](value)}


def _found(value: object) -> object:
    return _KINDS[value["type"]][1](value["value"]) if isinstance(value, dict) else value


@dataclass(frozen=True)
class StateLayout:
    hot: tuple = ()
    salts: int = 1

    def text(self) -> str:
        return json.dumps({"hot": [_stored(v) for v in self.hot], "salts": self.salts}, sort_keys=True)


def state_layout(spark: SparkSession, folder: str, measure: Callable[[], StateLayout]) -> StateLayout:
    """The layout stored in ``folder``, else a new one by ``measure``, stored on the way."""
    stored = read_text(spark, f"{folder}/{FILE}")
    if stored is not None:
        found = json.loads(stored)
        return StateLayout(tuple(_found(v) for v in found["hot"]), found["salts"])
    layout = measure()
    write_text(spark, f"{folder}/{FILE}", layout.text())
    return layout


def check_layout(spark: SparkSession, folder: str, layout: StateLayout | None) -> None:
    """Raise unless ``layout`` is the one stored in ``folder``; store it at the first start."""
    stored = read_text(spark, f"{folder}/{FILE}")
    if stored is None:
        if layout is not None:
            write_text(spark, f"{folder}/{FILE}", layout.text())
    elif layout is None or stored != layout.text():
        given = layout.text() if layout is not None else "none"
        raise ValueError(f"this folder was started with the state layout {stored}, not {given}")


def kept_schema(spark: SparkSession, folder: str, infer: Callable[[], StructType]) -> StructType:
    """The schema stored in ``folder``, else the one that ``infer`` finds, stored on the way.

    ``infer`` may scan files; after the first start it is not called again.
    """
    stored = read_text(spark, f"{folder}/{SCHEMA_FILE}")
    if stored is not None:
        return StructType.fromJson(json.loads(stored))
    schema = infer()
    write_text(spark, f"{folder}/{SCHEMA_FILE}", schema.json())
    return schema


def check_schema(spark: SparkSession, folder: str, schema: StructType) -> None:
    """Raise unless ``schema`` is the one stored in ``folder``; store it at the first start."""
    if kept_schema(spark, folder, lambda: schema) != schema:
        raise ValueError(f"the stream in {folder} was started with another schema, see {SCHEMA_FILE}")
