"""Token counts by heap-and-linked-list byte-pair merging, without making token ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import map_batches
from millrace.llm.text import texts
from millrace.llm.vocabulary import PieceCounter, path, worker_memory

MODEL = "piece_bpe_32k.model"


def count_tokens(
    documents: DataFrame, key: str = "doc_id", text: str = "text", *, model: str = MODEL, folder: str | None = None
) -> DataFrame:
    """One row per input row: ``key``, ``n_bytes`` (UTF-8) and ``n_tokens``.

    Counts are those of the vocabulary's library without begin and end tokens; special
    strings inside a text are plain text. A null or empty text has 0 of both. Repeated
    rows and null keys are counted like any other; other columns are ignored. There is no
    shuffle, and a task remembers a bounded number of words.
    """

    def make():
        counter = worker_memory(("pieces", model, folder), lambda: PieceCounter(path(model, folder)))

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            column = batch.column(1)
            tokens = np.fromiter(map(counter.count, texts(column)), np.int64, len(column))
            size = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(tokens)], [key, "n_bytes", "n_tokens"])

        return work

    rows = documents.select(F.col(key), F.col(text).cast("string"))
    kind = rows.schema[key].dataType.simpleString()
    return map_batches(rows, make, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint")


def over_limit(counts: DataFrame, limit: int = 4096) -> DataFrame:
    """Mark texts with more than ``limit`` tokens."""
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
