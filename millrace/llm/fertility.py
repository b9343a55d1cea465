"""Quality rules: word-level base rules and tokeniser fertility with bands per language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import map_batches, saved
from millrace.llm.text import SPACE, text_buffer, texts
from millrace.llm.vocabulary import ByteIds, PieceIds, path, worker_memory

SYMBOLS = b"#*$%&|<>"
MEMO = 600_000
CONTINUATION = bytes(range(0x80, 0xC0))
MEASURES = {
    "piece_chars": "both",
    "byte_chars": "both",
    "piece_fallback": "upper",
    "byte_fallback": "upper",
    "piece_entropy": "both",
}
#: Least spread of a measure, as a share of its middle.
FLOOR = 0.02
#: Rows of one language are dealt over so many groups when they meet its bands.
SALTS = 32
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"]


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, n)
    pairs = ids[:-1] * n + ids[1:]
    if n >= 1 << 21:  # three numbers of this size no longer fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
        runs = pairs[:-1] * n + ids[2:]
    else:
        runs = pairs[:-1] * n + ids[2:]
    ordered = np.sort(runs)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    triples, times = np.unique(runs, return_inverse=True, return_counts=True)[1:]
    twice = np.zeros(n + 3, np.int64)
    hit = np.flatnonzero(times[triples] > 1)
    np.add.at(twice, hit, 1)
    np.add.at(twice, hit + 3, -1)
    return int(np.count_nonzero(np.cumsum(twice)[:n]))


def base_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(raw.translate(None, SPACE + CONTINUATION)),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def entropy(ids: np.ndarray) -> float:
    """Bits per token of the text's own token distribution."""
    if not len(ids):
        return 0.0
    ordered = np.sort(ids)
    share = np.diff(np.r_[0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, len(ids)]) / len(ids)
    return float(-(share * np.log2(share)).sum())


def measure(documents: DataFrame, keys: list[str], text: str = "text", *, folder: str | None = None) -> DataFrame:
    """Base counts and fertility measures of every row, beside the ``keys`` columns.

    ``*_chars`` are characters without white space per token, ``piece_fallback`` the share
    of byte-fallback tokens, ``byte_fallback`` the share of one-byte tokens and
    ``piece_entropy`` bits per token. Measures of a text without tokens are null.
    """

    def make():
        pieces = worker_memory(("piece ids", folder), lambda: PieceIds(path("piece_bpe_32k.model", folder), MEMO))
        bytewise = worker_memory(("byte ids", folder), lambda: ByteIds(folder, MEMO))

        def row(text: str, raw: bytes) -> tuple:
            base = base_counts(raw)
            a = np.frombuffer(pieces.ids(text), "<u2")
            b = np.frombuffer(bytewise.ids(text), "<u4")
            if not base[0]:
                return (*base, len(a), None, None, None, None, None)
            chars = base[1]
            fallback = np.count_nonzero(pieces.is_byte[a]) / len(a)
            return (*base, len(a), chars / len(a), chars / len(b), fallback, np.count_nonzero(b < 256) / len(b), entropy(a))

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            column = batch.column(len(keys))
            data, at = text_buffer(column)
            found = [
                row(t, data[at[i] : at[i + 1]].tobytes()) for i, t in enumerate(texts(column))
            ]
            columns = list(zip(*found, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[: len(COUNTS)]]
            arrays += [pa.array(c, pa.float64()) for c in columns[len(COUNTS) :]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keys))] + arrays, keys + COUNTS + list(MEASURES)
            )

        return work

    rows = documents.select(*keys, F.col(text).cast("string").alias("_text"))
    types = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    types += [f"{c} bigint" for c in COUNTS] + [f"{c} double" for c in MEASURES]
    return map_batches(rows, make, ", ".join(types))


def bands(measures: DataFrame, group: str, doubt: float) -> DataFrame:
    """Middle and spread of every measure per group, over all rows that pass the base rules.

    The spread is the distance of the quartiles over that of a normal distribution with
    spread 1, and at least ``FLOOR`` of the middle. ``1 + doubt / rows`` times the spread
    allows for what few rows can tell. Quantiles come from mergeable sketches.
    """
    quarter = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    table = measures.where(~F.col("base_failed")).groupBy(group)
    table = table.agg(F.count("*").alias("_n"), *[F.percentile_approx(m, quarter, 10_000).alias(m) for m in MEASURES])
    spread = {m: F.greatest((F.col(m)[2] - F.col(m)[0]) / 1.349, FLOOR * F.abs(F.col(m)[1])) for m in MEASURES}
    return table.select(
        F.col(group).alias("_group"),
        *[F.col(m)[1].alias(f"_mid_{m}") for m in MEASURES],
        *[(s * (1 + F.lit(doubt) / F.col("_n"))).alias(f"_spread_{m}") for m, s in spread.items()],
    )


def quality_rules(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    *,
    keep: list[str] | None = None,
    width: float = 5.0,
    short: float = 200.0,
    doubt: float = 100.0,
    folder: str | None = None,
) -> DataFrame:
    """One row per document: base counts, fertility measures, ``base_failed`` and ``kept``.

    The base rules fail texts of fewer than 50 words and texts of which more than half the
    words lie in repeated three-word windows. A text that passes them is rejected if a
    measure lies more than ``width`` spreads from the middle of its language (a null
    language counts as an empty one), or above it only for the fallback shares. The
    limit is wider by ``sqrt(1 + short / tokens)`` for short texts and by
    ``1 + doubt / texts`` for languages with few texts. A fallback share has a spread of one
    token of the text at least, so a single rare sign (at most four tokens) rejects no text
    where others have none. Null, empty and blank texts have 0 words and fail. Repeated rows are judged alike and all returned; other columns
    than those in ``keep`` are ignored. The measures are written to the shared folder once, the texts are not shuffled.
    """
    found = measure(documents.withColumn("_lang", F.coalesce(F.col(lang).cast("string"), F.lit(""))), [key, "_lang", *(keep or [])], text, folder=folder)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = saved(found.withColumn("base_failed", failed), "fertility")
    limits = bands(found, "_lang", doubt)
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    limits = limits.select("*", F.explode(salts).alias("_limit_salt"))
    found = found.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    joined = found.join(limits, (F.col("_lang") == F.col("_group")) & (F.col("_salt") == F.col("_limit_salt")), "left")
    scale = F.sqrt(1 + F.lit(short) / F.greatest(F.col("n_tokens"), F.lit(1)))
    odd = F.lit(False)
    for name, side in MEASURES.items():
        off = F.col(name) - F.col(f"_mid_{name}")
        spread = F.col(f"_spread_{name}")
        if side == "both":
            off = F.abs(off)
        else:
            spread = F.greatest(spread, 1 / F.greatest(F.col("n_tokens"), F.lit(1)))
        odd = odd | F.coalesce(off > width * spread * scale + 1e-9, F.lit(False))
    kept = ~F.col("base_failed") & ~odd
    return joined.select(key, *(keep or []), *COUNTS, *MEASURES, "base_failed", kept.alias("kept"))
