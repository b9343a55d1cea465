"""Language-model scores of whole documents: word counts on Spark, a gated recurrent model."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.gated import GatedModel, learn, score
from millrace.llm.tables import map_batches, saved
from millrace.llm.text import text_buffer
from millrace.llm.vocabulary import worker_memory

VOCABULARY = 1024
HEAD_SHARE = 2.0**-20
ROUNDS = 4
GROUP_TOKENS = 2_000_000


def raw_texts(column: pa.Array) -> Iterator[list[bytes]]:
    """Lower-cased (A-Z) words of each row."""
    data, at = text_buffer(column)
    for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield data[start:end].tobytes().lower().split()


def word_counts(documents: DataFrame, text: str) -> DataFrame:
    """``word`` and how often it occurs; the end of a document counts as the empty word."""

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            counts: Counter[bytes] = Counter()
            for words in raw_texts(batch.column(0)):
                counts.update(words)
            counts[b""] = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["word", "times"],
            )

        return work

    partial = map_batches(documents.select(F.col(text).cast("string")), make, "word string, times bigint")
    return partial.groupBy("word").agg(F.sum("times").alias("times"))


@dataclass
class Head:
    """Frequent words: at most one in ``HEAD_SHARE`` of all tokens, so at most 2**20 words."""

    words: list[bytes]
    counts: np.ndarray
    vocabulary: int
    tokens: int
    types: int

    @property
    def base_total(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)

    @property
    def rare_total(self) -> float:
        """Mass of the words outside the model's vocabulary, one unseen word among them."""
        inside = self.counts[: self.vocabulary]
        return self.tokens - float(inside.sum()) + 0.5 * max(0, self.types - len(inside)) + 0.5

    def model_counts(self) -> np.ndarray:
        inside = self.counts[: self.vocabulary]
        return np.r_[inside, max(0.0, self.tokens - inside.sum())].astype(np.float64)


def head_of(counts: DataFrame, vocabulary: int) -> Head:
    totals = counts.agg(F.sum("times"), F.count("*")).first()
    tokens, types = int(totals[0] or 0), int(totals[1])
    rows = counts.where(F.col("times") >= max(1.0, tokens * HEAD_SHARE)).where("word != ''").collect()
    rows.sort(key=lambda r: (-r[1], r[0]))
    end = counts.where("word = ''").collect()
    words = [b"", *(r[0].encode() for r in rows)]
    table = np.array([end[0][1] if end else 0, *(r[1] for r in rows)], np.float64)
    return Head(words, table, min(vocabulary, len(words)), tokens, types)


class Encoder:
    def __init__(self, head: Head) -> None:
        self.place = {w: i for i, w in enumerate(head.words)}
        self.logs = np.log10(head.counts + 0.5)
        self.ids = np.minimum(np.arange(len(head.words)), head.vocabulary).astype(np.uint16)
        self.rare = head.vocabulary


def encoded(documents: DataFrame, keys: list[str], text: str, head: Head) -> DataFrame:
    """Per row the model's ids, sums over frequent words, and the other words with counts."""
    parts = (head.words, head.counts, head.vocabulary, head.tokens, head.types)
    shared = documents.sparkSession.sparkContext.broadcast(parts)  # plain values: workers need not have this package
    name = ("head", uuid.uuid4().hex)

    def make():
        encoder = worker_memory(name, lambda: Encoder(Head(*shared.value)))
        get = encoder.place.get

        def row(words: list[bytes]) -> tuple:
            at = np.fromiter([get(w, -1) for w in words], np.int64, len(words))
            known = at >= 0
            ids = np.full(len(at) + 1, encoder.rare, np.uint16)
            ids[:-1][known] = encoder.ids[at[known]]
            ids[-1] = 0
            logs = np.where(known, encoder.logs[at], 0.0)
            rare = ids[:-1] == encoder.rare
            others = Counter([w for w, k in zip(words, known.tolist(), strict=True) if not k])
            return (
                len(ids),
                int(known.sum()),
                float(logs.sum()) + float(encoder.logs[0]),
                float(logs[rare].sum()),
                int(rare.sum()),
                ids.tobytes(),
                [w.decode() for w in others],
                list(others.values()),
            )

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                columns = list(zip(*map(row, raw_texts(part.column(len(keys)))), strict=True))
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    part.columns[: len(keys)] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    [*keys, "n_tokens", "head_known", "head_sum", "rare_sum", "n_rare", "ids", "others", "times"],
                )

        return work

    rows = documents.select(*keys, F.col(text).cast("string").alias("_text"))
    types = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    types += ["n_tokens bigint, head_known bigint, head_sum double, rare_sum double, n_rare bigint, ids binary, others array<string>, times array<bigint>"]
    return map_batches(rows, make, ", ".join(types)).withColumn("_row", F.monotonically_increasing_id())


def groups(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Rows of ids, about two million tokens at a time, with the number of the first row."""
    first, size, held = 0, 0, []
    for row, blob in enumerate(column.to_pylist()):
        held.append(np.frombuffer(blob, np.uint16).astype(np.int32))
        size += len(held[-1])
        if size >= GROUP_TOKENS:
            yield first, held
            first, size, held = row + 1, 0, []
    if held:
        yield first, held


def fit(train: DataFrame, head: Head, rounds: int = ROUNDS) -> GatedModel:
    """Train on all rows of ``ids``, a part of them in each round.

    In a round every task runs its own rows through the model that the round began with;
    weights are then averaged by tokens, in Spark, weight by weight. Only the averaged
    weights, whose number is fixed, come to the driver.
    """
    model = GatedModel.start(head.model_counts())
    size, flat = model.size, model.flat
    for number in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], flat: np.ndarray = flat) -> Iterator[pa.RecordBatch]:
            own, past, tokens = GatedModel(size, flat=flat.copy()), np.full(len(flat), 1e-6, np.float32), 0
            for batch in batches:
                for _, rows in groups(batch.column(0)):
                    tokens += learn(own, rows, past)
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tokens], pa.int64()), pa.array([own.flat], pa.list_(pa.float32()))], ["tokens", "weights"]
                )

        part = train.where(F.pmod(F.xxhash64("_row"), F.lit(rounds)) == number).select("ids")
        each = part.mapInArrow(run, "tokens bigint, weights array<float>").select("tokens", F.posexplode("weights").alias("at", "weight"))
        mean = each.groupBy("at").agg((F.sum(F.col("weight") * F.col("tokens")) / F.sum("tokens")).alias("weight")).toArrow()
        if mean.num_rows:
            flat = np.zeros(len(flat), np.float32)
            flat[mean["at"].to_numpy()] = mean["weight"].to_numpy()
    return GatedModel(size, flat=flat)


def log_likelihood(rows: DataFrame, model: GatedModel) -> DataFrame:
    """Columns ``_row`` and ``model_log``: natural log probability of the ids of each row."""
    size, flat = model.size, model.flat

    def make():
        own = GatedModel(size, flat=flat)

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for first, documents in groups(batch.column(1)):
                values = score(own, documents)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(documents)), pa.array(values)], ["_row", "model_log"]
                )

        return work

    return map_batches(rows.select("_row", "ids"), make, "_row bigint, model_log double")


def score_documents(
    documents: DataFrame,
    held_out: str,
    key: str = "doc_id",
    text: str = "text",
    *,
    vocabulary: int = VOCABULARY,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document with its log10 probability under two models of the training rows.

    Training rows are those for which the boolean column ``held_out`` is not true. Tokens
    are lower-cased (A-Z) words and an end per document. ``base_score`` is the smoothed
    word-frequency model, ``score`` the recurrent one: it gives the ``vocabulary`` most
    frequent words and the end their probability, and other words that of the rare class
    times their smoothed share in it. ``n_known`` counts tokens seen in training and
    ``train_tokens`` all training tokens.

    Counts cover all training rows. Words with at least 2**-20 of all tokens, at most 2**20
    of them, are looked up in the tasks; the others are joined with their counts by
    shuffle. Null and empty texts are one end token. Without training rows every known
    count is 0. Repeated rows are all scored, other columns are ignored, an empty table
    gives no rows.
    """
    rows = documents.withColumn("__held", F.coalesce(F.col(held_out), F.lit(False)))
    counts = saved(word_counts(rows.where("NOT __held"), text), "word_counts")
    head = head_of(counts, vocabulary)
    table = saved(encoded(rows, [key, "__held"], text, head), "encoded")
    model = fit(table.where("NOT __held"), head, rounds)

    others = table.select("_row", F.inline(F.arrays_zip("others", "times")).alias("word", "n"))
    tail = others.join(counts, "word", "left").groupBy("_row").agg(
        F.sum(F.when(F.col("times").isNotNull(), F.col("n")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("times", F.lit(0)) + 0.5)).alias("tail_sum"),
    )
    joined = table.drop("ids", "others", "times").join(log_likelihood(table, model), "_row").join(tail, "_row", "left")
    tail_sum = F.coalesce("tail_sum", F.lit(0.0))
    ends = F.lit(1 if head.counts[0] else 0)
    base = F.col("head_sum") + tail_sum - F.col("n_tokens") * float(np.log10(head.base_total))
    rare = F.col("rare_sum") + tail_sum - F.col("n_rare") * float(np.log10(head.rare_total))
    return joined.select(
        key,
        F.col("__held").alias("held_out"),
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + ends).cast("bigint").alias("n_known"),
        F.lit(head.tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("model_log") / float(np.log(10)) + rare).alias("score"),
    )
