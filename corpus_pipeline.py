"""A training-data pipeline: quality rules, near-dedup, passage dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's ``docs``. All but the last keep the columns of documents
and every row they do not decide against; decisions are made on rows, not on keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.compact_windows import repeated_passages, without_passages
from millrace.llm.decontamination import contaminated
from millrace.llm.fertility import quality_rules
from millrace.llm.near_dedup import near_duplicates
from millrace.llm.packing import pack_documents
from millrace.llm.tables import numbered, read, saved

ORACLE_SQL = None
ROW = "__row"


def without(docs: DataFrame, rows: DataFrame, *, many: bool = False) -> DataFrame:
    """Numbered documents less the rows of these numbers, and without the number.

    ``many`` says that the rows grow with the documents: they are then never broadcast.
    """
    gone = rows.select(F.col(ROW).alias("__gone")).distinct()
    gone = gone.hint("merge") if many else gone
    return docs.join(gone, F.col(ROW) == F.col("__gone"), "left_anti").drop(ROW)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside the fertility bands of their language.

    Null, empty and short texts go. Each row is judged for itself, also where others have its
    key or its text; null keys do not count.
    """
    rows = numbered(docs, ROW)
    return without(rows, quality_rules(rows, key=ROW).where("NOT kept"), many=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, the first in the order of the stored files.

    Rows are told apart by their place, so of rows with one key and different texts each is
    judged by its own text, and rows with a null key take part. Null and empty texts stay.
    """
    rows = numbered(docs, ROW)
    return without(rows, saved(near_duplicates(rows, key=ROW).where("NOT kept").select(ROW), "near_duplicates"), many=True)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier row has; emptied ones go.

    Rows are told apart by their place, so null and repeated keys are searched like others.
    Null texts stay.
    """
    rows = numbered(docs, ROW)
    return without_passages(rows, repeated_passages(rows, key=ROW), key=ROW).drop(ROW)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; rows are judged one by one, those with a null key too."""
    rows = numbered(docs, ROW)
    return without(rows, saved(contaminated(rows, read(spark, sf_dir, "benchmark"), key=ROW).select(ROW), "contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens: one row per piece with its place."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each result stored before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
