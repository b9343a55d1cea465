"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import map_batches, saved
from millrace.llm.text import mix, texts
from millrace.llm.vocabulary import worker_memory

ORDER = 5
SAMPLE_BYTES = 4_000_000
ALPHABET = 10_000
START, END = 2, 3
MEMO_WORDS = 400_000
SHARPNESS = 8.0
UNDETERMINED = "und"
LETTERS = regex.compile(r"\p{L}+")


def symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words with a start and an end sign each, and each one's place in its word."""
    joined = "".join([f"{chr(START)}{w}{chr(END)}" for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.flatnonzero(codes == START)
    place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
    return codes, place


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """At ``[k][i]`` the hash of the ``k`` symbols that end at ``i`` (of nonsense if fewer precede)."""
    out = [np.full(len(codes), 0x51ED270B, np.uint64)]
    for _ in range(order):
        before = np.r_[np.uint64(0x51ED270B), out[-1][:-1]] if len(out) > 1 else out[0]
        out.append(mix(before * np.uint64(0x9E3779B97F4A7C15) + codes))
    return out


def sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the first place of each, and the sum of its weights."""
    found, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return found, first, np.bincount(inverse, weights, len(found))


def train(counts: dict[str, int], order: int = ORDER) -> list[tuple[np.ndarray, ...]]:
    """Per gram length: gram hash, context hash, shorter gram's hash, discounted share; then
    context hash and the weight it leaves to shorter grams.

    The longest grams, and those at a word's start, count occurrences; others count the
    different symbols before them. The discount of a length is ``n1 / (n1 + 2 n2)``.
    """
    words = list(counts)
    codes, place = symbols(words)
    grams = gram_hashes(codes, order)
    times = np.repeat(np.array([counts[w] for w in words], np.float64), np.array([len(w) + 2 for w in words]))
    levels = []
    for k in range(1, order + 1):
        at = np.flatnonzero((place >= 1) & (place >= k - 1))
        whole = at if k == order else at[place[at] == k - 1]
        keys, weights = grams[k][whole], times[whole]
        if k < order:
            longer = np.flatnonzero(place >= k)
            first = longer[np.unique(grams[k + 1][longer], return_index=True)[1]]
            keys, weights = np.r_[keys, grams[k][first]], np.r_[weights, np.ones(len(first))]
            whole = np.r_[whole, first]
        gram, spot, count = sums(keys, weights)
        spot = whole[spot]
        context, shorter = grams[k - 1][spot - 1], grams[k - 1][spot]
        ones, twos = np.count_nonzero(count == 1), np.count_nonzero(count == 2)
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        left, where, number = np.unique(context, return_inverse=True, return_counts=True)
        total = np.bincount(where, count, len(left))
        levels.append((gram, context, shorter, (count - discount) / total[where], left, discount * number / total))
    return levels


@dataclass
class Model:
    """All languages in one table per gram length, sorted by hash, a column per language."""

    languages: list[str]
    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]

    @staticmethod
    def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spot = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
        return spot, (table[spot] == keys) if len(table) else np.zeros(len(keys), bool)

    @classmethod
    def join(cls, trained: dict[str, list[tuple[np.ndarray, ...]]], order: int = ORDER) -> Model:
        """Interpolated probabilities of every gram under every language."""
        languages = sorted(trained)
        model = cls(languages, [], [], [], [])
        for k in range(order):
            parts = [trained[x][k] for x in languages]
            gram, first = np.unique(np.concatenate([p[0] for p in parts]), return_index=True)
            context = np.concatenate([p[1] for p in parts])[first]
            shorter = np.concatenate([p[2] for p in parts])[first]
            left = np.unique(np.concatenate([p[4] for p in parts]))
            weight = np.ones((len(left), len(languages)))
            share = np.zeros((len(gram), len(languages)))
            for column, part in enumerate(parts):
                share[np.searchsorted(gram, part[0]), column] = part[3]
                weight[np.searchsorted(left, part[4]), column] = part[5]
            rest = np.full((len(gram), len(languages)), 1 / ALPHABET)
            if k:
                spot, known = cls.find(model.grams[k - 1], shorter)
                rest = np.where(known[:, None], np.exp(model.logs[k - 1][spot]), 1 / ALPHABET)
            share += weight[np.searchsorted(left, context)] * rest
            model.grams.append(gram)
            model.logs.append(np.log(np.maximum(share, 1e-12)).astype(np.float32))
            model.contexts.append(left)
            model.weights.append(np.log(np.maximum(weight, 1e-12)).astype(np.float32))
        return model

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each word under each language, and its number of symbols."""
        codes, place = symbols(words)
        order = len(self.grams)
        grams = gram_hashes(codes, order)
        out = np.zeros((len(codes), len(self.languages)), np.float32)
        size = np.minimum(place + 1, order)
        open_ = np.flatnonzero(place > 0)
        for k in range(order, 0, -1):
            now = open_[size[open_] == k]
            spot, known = self.find(self.grams[k - 1], grams[k][now])
            out[now[known]] += self.logs[k - 1][spot[known]]
            missed = now[~known]
            spot, known = self.find(self.contexts[k - 1], grams[k - 1][missed - 1])
            out[missed[known]] += self.weights[k - 1][spot[known]]
            size[missed] = k - 1
            size[now] = np.where(np.isin(now, missed), size[now], -1)
        out[open_[size[open_] == 0]] += np.float32(-np.log(ALPHABET))
        starts = np.flatnonzero(place == 0)
        if not len(starts):
            return np.zeros((0, len(self.languages)), np.float32), np.zeros(0, np.int64)
        return np.add.reduceat(out, starts, axis=0), np.diff(np.r_[starts, len(codes)]) - 1


class WordScores:
    """Scores of raw words, remembered; the memory starts anew when it is full."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.logs = np.zeros((0, len(self.model.languages)), np.float32)
        self.sizes = np.zeros(0, np.int64)

    def documents(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Summed log probabilities and symbols of each text."""
        split = [row.split() for row in rows]
        fresh = list(set().union(*split).difference(self.place))
        if fresh:
            if len(self.place) + len(fresh) > MEMO_WORDS:
                self._clear()
                fresh = list(set().union(*split))
            runs = [[r.lower() for r in LETTERS.findall(w)] for w in fresh]
            logs, sizes = self.model.scores([r for group in runs for r in group])
            owner = np.repeat(np.arange(len(fresh)), [len(group) for group in runs])
            add = np.zeros((len(fresh), logs.shape[1]), np.float32)
            np.add.at(add, owner, logs)
            first = len(self.place)
            self.place.update(zip(fresh, range(first, first + len(fresh)), strict=True))
            self.logs = np.concatenate([self.logs, add])
            self.sizes = np.concatenate([self.sizes, np.bincount(owner, sizes, len(fresh)).astype(np.int64)])
        total = np.zeros((len(rows), self.logs.shape[1]))
        size = np.zeros(len(rows), np.int64)
        for i, words in enumerate(split):
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            total[i] = self.logs[at].sum(axis=0, dtype=np.float64)
            size[i] = self.sizes[at].sum()
        return total, size


def fit(labelled: DataFrame, text: str, lang: str, sample_bytes: int, order: int) -> Model:
    """Models from about ``sample_bytes`` of text per language, chosen by hash of the text.

    A language of few texts has one at least, so that every label with a letter gets a model.
    The driver gets one row per language, with its size, by which the share is set.
    Words are counted in the tasks that hold the sample, each language is trained in a
    task of its own over the bounded sample, and the tables, whose size follows the sample
    and the number of languages, come to the driver.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = rows.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    letters = F.when(F.col("text").rlike(r"\p{L}"), draw)
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")), F.min(letters)).collect()
    if not sizes:
        return Model([], [], [], [], [])
    # Up to its share of the draws, and in any case the first text with a letter.
    least = [(lang, max(int(sample_bytes / max(size, 1) * (1 << 30)), 1 + (first or 0))) for lang, size, first in sizes]
    bound = F.create_map([F.lit(x) for pair in least for x in pair])
    sample = rows.where(draw < F.try_element_at(bound, F.col("lang"))).select("lang", "text")

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            counts = Counter(
                (x, w.lower()) for x, t in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True) for w in LETTERS.findall(t)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in counts], pa.string()),
                    pa.array([k[1] for k in counts], pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["lang", "word", "times"],
            )

        return work

    words = map_batches(sample, make, "lang string, word string, times bigint")
    words = words.groupBy("lang", "word").agg(F.sum("times").alias("times"))

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        levels = train(dict(zip(group["word"], group["times"], strict=True)), order)
        blobs = [[np.asarray(x).tobytes() for x in level] for level in levels]
        return pd.DataFrame(
            [(group["lang"].iloc[0], k, *blob) for k, blob in enumerate(blobs)],
            columns=["lang", "k", "gram", "context", "shorter", "share", "contexts", "weights"],
        )

    schema = "lang string, k int, gram binary, context binary, shorter binary, share binary, contexts binary, weights binary"
    kinds = [np.uint64, np.uint64, np.uint64, np.float64, np.uint64, np.float64]
    trained: dict[str, list] = {}
    for row in sorted(words.groupBy("lang").applyInPandas(learn, schema).collect(), key=lambda r: (r[0], r[1])):
        trained.setdefault(row[0], []).append([np.frombuffer(x, t) for x, t in zip(row[2:], kinds, strict=True)])
    return Model.join(trained, order) if trained else Model([], [], [], [], [])


def identify(documents: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` with ``lang_pred``, ``score`` (0 to 1) and ``entropy`` (bits per symbol)."""
    parts = (model.languages, model.grams, model.logs, model.contexts, model.weights)
    shared = documents.sparkSession.sparkContext.broadcast(parts)  # plain values: workers need not have this package
    name = ("languages", uuid.uuid4().hex)

    def make():
        known = worker_memory(name, lambda: WordScores(Model(*shared.value)))
        languages = np.array([*shared.value[0], UNDETERMINED], object)

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                total, size = known.documents(texts(part.column(len(keys))))
                best = np.full(len(size), len(languages) - 1)
                score, entropy = np.zeros(len(size)), np.zeros(len(size))
                some = np.flatnonzero(size > 0) if len(languages) > 1 else np.zeros(0, np.int64)
                if len(some):
                    bits = -total[some] / size[some, None] / np.log(2)
                    best[some] = bits.argmin(axis=1)
                    entropy[some] = bits.min(axis=1)
                    score[some] = 1 / np.exp(SHARPNESS * (entropy[some, None] - bits)).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keys))]
                    + [pa.array(languages[best], pa.string()), pa.array(score), pa.array(entropy)],
                    [*keys, "lang_pred", "score", "entropy"],
                )

        return work

    rows = documents.select(*keys, F.col(text).cast("string").alias("_text"))
    types = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    return map_batches(rows, make, ", ".join([*types, "lang_pred string, score double, entropy double"]))


def language_id(
    documents: DataFrame,
    labelled: DataFrame | str,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    *,
    keep: list[str] | None = None,
    sample_bytes: int = SAMPLE_BYTES,
    order: int = ORDER,
    spread: float = 6.0,
) -> DataFrame:
    """One row per document: ``key``, ``keep``, ``lang_pred``, ``score``, ``entropy``, ``rejected``.

    ``labelled`` has texts with their languages. It may be the name of a boolean column of the
    documents that says which of them are labelled; each text is then scored once.

    One Kneser-Ney model per language over the letters of each word is learned from
    ``labelled``, from about ``sample_bytes`` of text per language and one text at least. The
    language with the lowest cross-entropy per symbol over the whole text is taken. ``score``
    falls from 1 as others come close. ``rejected`` marks texts more than ``spread`` standard
    deviations above the mean entropy of all labelled texts of that language that are taken
    for it; where no text is, of the language with the highest such limit.

    Texts without a letter (null and empty ones too) and all texts if nothing is labelled
    are ``und`` with score 0 and rejected. Null labels teach nothing. Equal cross-entropies
    go to the first language by name. Repeated rows are all returned, other columns are
    ignored, an empty table gives no rows. The driver holds one row per language; the models
    grow with the number of labels, which should be languages and not free text.
    """
    keys = [key, *(keep or [])]
    inside = isinstance(labelled, str)
    known = documents.where(F.col(labelled)) if inside else labelled
    model = fit(known, text, lang, sample_bytes, order)
    if not model.languages:
        return identify(documents, model, keys, text).withColumn("rejected", F.lit(True))
    label = F.col(lang).cast("string")
    if inside:
        marked = documents.withColumn("__lang", F.when(F.col(labelled), label))
        found = saved(identify(marked, model, [*keys, "__lang"], text), "identified")
        trusted = found
    else:
        found = identify(documents, model, keys, text)
        trusted = identify(labelled.select(F.col(text), label.alias("__lang")), model, ["__lang"], text)
    usual = trusted.where(F.col("lang_pred") == F.col("__lang")).groupBy("lang_pred")
    limit = (F.avg("entropy") + spread * F.coalesce(F.stddev("entropy"), F.lit(0.0))).alias("__limit")
    limits = saved(usual.agg(limit), "language_limits")
    widest = limits.agg(F.max("__limit")).first()[0]
    joined = found.join(limits, "lang_pred", "left")
    above = F.col("entropy") > F.coalesce("__limit", F.lit(widest).cast("double"))
    rejected = F.coalesce((F.col("lang_pred") == UNDETERMINED) | above, F.lit(True))
    return joined.select(*keys, "lang_pred", "score", "entropy", rejected.alias("rejected"))
