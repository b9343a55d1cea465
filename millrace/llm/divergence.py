"""How far sources of one language differ in their words.

Counting shuffles 64-bit term digests and never the terms. Of the digests that are frequent
enough to matter, the smallest and the largest term are gathered: where they differ, terms
collide, and those digests are counted again split by term. Text is joined back only for the
terms that a result row names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.tables import map_batches, saved

LEAST_DOCUMENTS, TOP = 30, 50
ONE, PRIOR = 1_000_000_000, 5
#: Bits of the filter of frequent digests: 8 MB, whatever the number of terms.
FILTER_BITS = 1 << 26
#: Terms of one block, in which all sources of a language meet; fewer where terms times sources go beyond the cells.
BLOCK_TERMS, BLOCK_CELLS = 2048, 1 << 22

# Letters A-Z in lower case, a-z and all bytes of characters beyond ASCII make up terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BUCKET = 8 * 4096  # bits of one of Spark's bitmaps


def terms(text: str) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return text.encode().translate(_TABLE).split()


def _digests(found: Collection[bytes], bits: int) -> np.ndarray:
    """64-bit digests of terms, or the first ``bits`` of them."""
    from xxhash import xxh64_intdigest

    values = np.fromiter(map(xxh64_intdigest, found), np.uint64, len(found))
    return (values >> np.uint64(64 - bits)).view(np.int64)


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, str], list[str]]]:
    """The texts of a batch by language and source."""
    groups: dict[tuple[str, str], list[str]] = {}
    lang, source, text = (column.to_pylist() for column in batch.columns)
    for key, body in zip(zip(lang, source, strict=True), text, strict=True):
        groups.setdefault(key, []).append(body)
    yield from groups.items()


def _counts(texts: DataFrame, bits: int, collided: DataFrame | None = None) -> DataFrame:
    """Per language, source and digest: occurrences and documents.

    With ``collided``, only of its digests, and split by term: ``split`` is the term then,
    else empty.
    """
    shared = None if collided is None else texts.sparkSession.sparkContext.broadcast(_filter(collided))

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for (lang, source), bodies in _grouped(batch):
                n, documents = Counter(), Counter()
                for body in bodies:
                    words = terms(body)
                    n.update(words)
                    documents.update(set(words))
                digest = _digests(n, bits)
                columns = [digest, np.fromiter(n.values(), np.int64, len(n))]
                columns.append(np.fromiter(map(documents.__getitem__, n), np.int64, len(n)))
                split = pa.repeat("", len(n))
                if shared is not None:
                    held = np.flatnonzero(_passes(shared.value, digest))
                    columns = [c[held] for c in columns]
                    found = list(n)
                    split = pa.array([found[k].decode() for k in held], pa.string())
                keys = [pa.repeat(lang, len(split)), pa.repeat(source, len(split)), split]
                yield pa.RecordBatch.from_arrays(
                    [*keys, *map(pa.array, columns)], ["lang", "source", "split", "digest", "n", "documents"]
                )

        return work

    parts = map_batches(texts, make, "lang string, source string, split string, digest long, n long, documents long")
    keys = ["lang", "source", "digest", "split"]
    if collided is None:
        parts = parts.drop("split")
        keys.pop()
    sums = parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    return sums if collided is None else sums.join(collided, "digest", "left_semi").select(*keys, "n", "documents")


def _kept(counts: DataFrame, least: int, *keys: str) -> DataFrame:
    totals = counts.groupBy("lang", *keys).agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    return totals.where(F.col("documents") >= least).select("lang", *keys, "n")


def _filter(kept: DataFrame) -> bytes:
    """A bitmap of the digests, of one size however many there are: others pass only by chance."""
    bit = F.pmod(F.col("digest"), F.lit(FILTER_BITS))
    maps = (
        kept.groupBy((bit / F.lit(_BUCKET)).cast("long").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.pmod(bit, F.lit(_BUCKET))).alias("bits"))
        .collect()
    )
    whole = np.zeros((FILTER_BITS // _BUCKET, _BUCKET // 8), np.uint8)
    for bucket, bits in maps:
        whole[bucket] = np.frombuffer(bytes(bits), np.uint8)
    return whole.tobytes()


def _passes(bitmap: bytes, digests: np.ndarray) -> np.ndarray:
    bit = digests.view(np.uint64) % np.uint64(FILTER_BITS)
    octet = np.frombuffer(bitmap, np.uint8)[bit >> np.uint64(3)]
    return (octet >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _vocabulary(texts: DataFrame, bitmap: bytes, bits: int) -> DataFrame:
    """Smallest and largest term of each digest that passes the filter, combined before the shuffle."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            seen: set[bytes] = set()
            for body in batch.column(2).to_pylist():
                seen.update(terms(body))
            found, ends = list(seen), {}
            digests = _digests(found, bits)
            for k in np.flatnonzero(_passes(shared.value, digests)).tolist():
                low, high = ends.get(digests[k], (found[k], found[k]))
                ends[digests[k]] = (min(low, found[k]), max(high, found[k]))
            low, high = ([end[side].decode() for end in ends.values()] for side in (0, 1))
            columns = [pa.array(list(ends), pa.int64()), pa.array(low, pa.string()), pa.array(high, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "low", "high"])

        return work

    parts = map_batches(texts.select("lang", "source", "text"), make, "digest long, low string, high string")
    return parts.groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _share(count: str, total: str) -> Column:
    """1 + floor(10**9 * (count + 5) / (total + 5 * size)) in exact integers."""
    above = f"cast({ONE} as decimal(10,0)) * cast({count} + {PRIOR} as decimal(20,0))"
    return F.expr(f"1 + ({above}) div cast({total} + {PRIOR} * size as decimal(20,0))")


def _block_distances(key: tuple, table: pa.Table) -> pa.Table:
    """Sums of |p - q| in one block, for each two sources with the first name first.

    Rows without a digest give each source's share in the terms that it does not have.
    """
    source, split, digest, p = (table.column(c).to_numpy() for c in ("source", "split", "digest", "p"))
    names, at = np.unique(source, return_inverse=True)
    absent = table.column("split").is_null().to_numpy()
    place = np.unique(digest[~absent], return_inverse=True)[1]
    if any(split[~absent]):  # terms that share a digest have a place each
        places: dict[tuple[int, str], int] = {}
        found = zip(place.tolist(), split[~absent], strict=True)
        place = np.array([places.setdefault(term, len(places)) for term in found])
    shares = np.empty((len(names), int(place.max()) + 1 if len(place) else 0), np.int64)
    shares[at[absent]] = p[absent][:, None]
    shares[at[~absent], place] = p[~absent]
    out = {"source": [], "item": [], "value": []}
    for k in range(len(names) - 1):
        apart = np.abs(shares[k + 1 :] - shares[k]).sum(axis=1)
        out["source"] += [names[k]] * len(apart)
        out["item"] += names[k + 1 :].tolist()
        out["value"] += apart.tolist()
    kinds = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
    return pa.table({"lang": [key[0].as_py()] * len(out["value"]), **out}, kinds)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Sum of |p - q| over the kept terms of a language, for each two of its sources.

    Terms are dealt over blocks by digest. A block holds the shares of every source in some
    terms of one language and gives one row per two sources: no row per term and pair is
    ever made, and a block has a bounded number of terms times sources. The number of result
    rows, every source with every other of its language, is what is asked for.
    """
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK_TERMS), F.floor(F.lit(BLOCK_CELLS) / F.col("sources"))))
    blocks = F.ceil(F.col("size") / most).cast("long")
    dealt = shares.select(
        "lang", F.pmod("digest", F.greatest(blocks, F.lit(1))).alias("block"), "source", "digest", "split", "p"
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block")
    absent = groups.where("size > 0").select(
        "lang", every, "source", F.lit(None).cast("long").alias("digest"), F.lit(None).cast("string").alias("split"),
        _share("0", "total").alias("p"),
    )
    sums = (
        dealt.unionByName(absent)
        .groupBy("lang", "block")
        .applyInArrow(_block_distances, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    others = groups.select("lang", F.col("source").alias("item"))
    listed = groups.select("lang", "source").join(others, "lang").where("source != item")
    return listed.join(both, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))


def source_divergence(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    *,
    least: int = LEAST_DOCUMENTS,
    top: int = TOP,
    bits: int = 64,
) -> DataFrame:
    """How far the word shares of sources differ, and by which words.

    Every language keeps the terms in at least ``least`` of its documents. A group (language
    and source) and a language give each kept term the share
    ``1 + floor(10**9 * (count + 5) / (N + 5 * V))``. Part ``pair`` has a row for every other
    source of the language with the sum of absolute differences, ranked from the farthest;
    part ``term`` the ``top`` terms that the group has and gives more than its language.
    Returns ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Null text, language or source counts as empty. Groups without terms take part in pairs.
    Repeated rows count as often as they stand there; whole texts are counted, however long.
    Equal values are ranked by item in UTF-8 order. An empty table gives no rows; further
    columns are not read. ``bits`` shortens the digests, for tests of the splitting.
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))]
    texts = documents.select(*filled)
    counts = saved(_counts(texts, bits), "divergence_counts")
    frequent = _kept(counts, least, "digest").select("digest").distinct()
    vocabulary = saved(
        _vocabulary(texts, _filter(frequent), bits).join(frequent, "digest", "left_semi"), "divergence_terms"
    )
    collided = vocabulary.where("low != high").select("digest")
    counts = counts.withColumn("split", F.lit(""))
    if not collided.isEmpty():
        alone = counts.join(collided, "digest", "left_anti")
        counts = saved(alone.unionByName(_counts(texts, bits, collided)), "divergence_split")

    term = ["lang", "digest", "split"]
    kept = saved(_kept(counts, least, "digest", "split").withColumnRenamed("n", "lang_n"), "divergence_kept")
    present = saved(counts.join(kept, term).select("lang", "source", "digest", "split", "n", "lang_n"), "divergence_present")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("lang_n").alias("lang_total"))
    totals = present.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = texts.select("lang", "source").distinct()
    groups = (
        named.join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .join(named.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")), "lang")
        .select("lang", "source", "sources", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "size", "lang_total")))
    )
    groups = saved(groups, "divergence_groups")
    shares = present.join(groups, ["lang", "source"]).withColumns(
        {"p": _share("n", "total"), "q": _share("lang_n", "lang_total")}
    )

    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = shares.where("p > q").select("lang", "source", "digest", "split", (F.col("p") - F.col("q")).alias("value"))
    best = best.withColumn("rank", F.rank().over(by_value)).where(F.col("rank") <= top).drop("rank")
    texts_back = vocabulary.select("digest", "low")
    item = F.when(F.col("split") != "", F.col("split")).otherwise(F.col("low")).alias("item")
    best = best.join(texts_back, "digest").select("lang", "source", F.lit("term").alias("part"), item, "value")
    ranked = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    pairs = _pairs(shares, groups).withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(ranked))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(best.select(*columns))
