"""Helpers that test modules share."""

import uuid


def rows(df, *columns):
    """Sorted tuples of a small result."""
    names = list(columns) or df.columns
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def as_stream(spark, df, folder):
    """The rows of a small frame as a file stream."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)
