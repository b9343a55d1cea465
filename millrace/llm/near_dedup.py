"""Near-duplicate documents by an LSH forest over min-hash signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.tables import map_batches, salted, saved, unzipped, zipped
from millrace.llm.text import chunks, mix, shingle_set, text_buffer
from millrace.llm.vocabulary import forget_memory

VALUES = 256
REGIONS, REGION_DEPTH = 16, 3
ORDERS, SORT_DEPTH, LEAST_DEPTH = 16, 16, 2
NEIGHBOURS, BEST = 96, 4
QUIET_ROUNDS = 2
MARGIN = 0.1
#: Pairs whose full sets a confirming task holds at a time.
SETS = 64
#: Two bits of each value, 32 values to a word.
SKETCH_WORDS = VALUES // 32
_LOW_BITS = np.uint64(0x5555555555555555)
_SEED = mix(np.arange(1, 2 * VALUES + 1, dtype=np.uint64))
_XOR = (_SEED[:VALUES] >> np.uint64(32)).astype(np.uint32)[:, None]
_TIMES = (_SEED[VALUES:] >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)


def min_values(hashes: np.ndarray) -> np.ndarray:
    """Smallest value of the set under each of 256 hash functions."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(out, ((short[at : at + 2048] ^ _XOR) * _TIMES).min(axis=1), out=out)
    return out


def region_keys(values: np.ndarray) -> np.ndarray:
    """One key per region tree: a hash of its first three values."""
    parts = values[:, : REGIONS * REGION_DEPTH].reshape(-1, REGIONS, REGION_DEPTH).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, REGIONS + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(REGION_DEPTH):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def signatures(documents: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """Per document: ``id``, set size ``n``, set ``fingerprint``, ``regions`` keys, ``signature`` bytes and two bits of each."""

    def make():
        forget_memory()

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for first, last, words in chunks(batch.column(1), lower=True):
                sets = [shingle_set(words.of(r), length) for r in range(last - first)]
                values = np.stack([min_values(s) for s in sets])
                regions = region_keys(values)
                signature = mix(values.astype(np.uint64)).astype(np.uint8)
                sketch = np.packbits(np.stack([signature & 1, signature >> 1 & 1], axis=2).reshape(len(sets), -1), axis=1)
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(prints, pa.binary()),
                        pa.ListArray.from_arrays(
                            np.arange(0, regions.size + 1, REGIONS, dtype=np.int32), regions.reshape(-1)
                        ),
                        pa.array([row.tobytes() for row in signature], pa.binary()),
                        pa.array([row.tobytes() for row in sketch], pa.binary()),
                    ],
                    ["id", "n", "fingerprint", "regions", "signature", "sketch"],
                )

        return work

    rows = documents.select(F.col(key).cast("bigint"), F.col(text).cast("string"))
    return map_batches(rows, make, "id bigint, n bigint, fingerprint binary, regions array<bigint>, signature binary, sketch binary")


def _salt(rows: DataFrame) -> DataFrame:
    """A group for each row, by which the rows of one hot key are dealt over all partitions."""
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))


def crowded(distinct: DataFrame) -> DataFrame:
    """Ids that share the first three values of a region tree with another id."""
    keyed = _salt(distinct.select("id", F.explode("regions").alias("region")))
    shared = salted(keyed, ["region"]).select("region", "_salt")
    return keyed.join(shared, ["region", "_salt"], "left_semi").select("id").distinct()


def orders(round_: int) -> np.ndarray:
    """The values by which each sorted order of a round compares signatures."""
    return np.stack(
        [np.argsort(mix(np.arange(VALUES, dtype=np.uint64) + np.uint64((round_ * ORDERS + t + 1) << 20))) for t in range(ORDERS)]
    )[:, :SORT_DEPTH]


def neighbour_pairs(members: DataFrame, round_: int, threshold: float) -> DataFrame:
    """Pairs of near neighbours of different components in one round's sorted orders.

    ``members`` has ``id``, ``component``, ``signature`` and ``sketch``. The rows are sorted by
    each order's values; a row looks at the 96 after it that share at least the first two
    values. Where many rows are alike these share long prefixes, where few are alike short
    ones: the depth adapts to the region. Only the order's own values and the sketch, two bits
    of each value, are sorted. Of pairs whose sketches speak for an overlap of at least
    ``threshold`` less 0.1 (over three times what chance takes off), each row keeps the four
    best on either side. Looking far costs no disk, and a round that finds more saves others.
    """
    picks = orders(round_)
    keys = [
        F.struct(
            F.lit(t).alias("tree"),
            F.concat(*[F.substring("signature", int(p) + 1, 1) for p in picks[t]]).alias("prefix"),
        )
        for t in range(ORDERS)
    ]
    rows = members.select("id", "component", "sketch", F.explode(F.array(*keys)).alias("k"))
    rows = rows.select("k.tree", "k.prefix", "id", "component", "sketch")
    rows = rows.repartitionByRange("tree", "prefix", "id").sortWithinPartitions("tree", "prefix", "id")
    least = threshold - MARGIN

    def near(tree, prefix, ids, component, sketch):
        firsts, seconds, agree = [], [], []
        for step in range(1, min(NEIGHBOURS, len(ids) - 1) + 1):
            same = (tree[step:] == tree[:-step]) & (component[step:] != component[:-step])
            same &= (prefix[step:, :LEAST_DEPTH] == prefix[:-step, :LEAST_DEPTH]).all(axis=1)
            at = np.flatnonzero(same)
            if len(at):
                apart = sketch[at] ^ sketch[at + step]
                apart = np.bitwise_count((apart | apart >> np.uint64(1)) & _LOW_BITS).sum(axis=1, dtype=np.int64)
                share = 1 - apart / (0.75 * VALUES)  # a quarter of different values agree in two bits
                good = share >= least
                firsts.append(at[good])
                seconds.append(at[good] + step)
                agree.append(share[good])
        if not firsts:
            return np.zeros((0, 2), np.int64)
        a, b, share = np.concatenate(firsts), np.concatenate(seconds), np.concatenate(agree)
        chosen = np.zeros(len(a), bool)
        for side in (a, b):
            order = np.lexsort((-share, side))
            start = np.flatnonzero(np.r_[True, side[order][1:] != side[order][:-1]]) if len(order) else order
            rank = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
            chosen[order[rank < BEST]] = True
        pairs = np.stack([ids[a[chosen]], ids[b[chosen]]], axis=1)
        return np.unique(np.sort(pairs, axis=1), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            block = [
                batch.column(0).to_numpy(),
                np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, SORT_DEPTH),
                batch.column(2).to_numpy(),
                batch.column(3).to_numpy(),
                np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint64).reshape(-1, SKETCH_WORDS),
            ]
            block = block if kept is None else [np.concatenate(x) for x in zip(kept, block, strict=True)]
            pairs = near(*block)
            kept = [x[-NEIGHBOURS:] for x in block]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def confirmed(pairs: DataFrame, bodies: DataFrame, length: int, percent: int) -> DataFrame:
    """The pairs with ``linked``: whether their full shingle sets overlap by ``percent``. ``bodies`` are zipped."""

    def make():
        def sets(column: pa.Array) -> list[np.ndarray]:
            return [shingle_set(w.of(r), length) for f, l, w in chunks(unzipped(column), lower=True) for r in range(l - f)]

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            linked = []
            for start in range(0, batch.num_rows, SETS):
                part = batch.slice(start, SETS)
                for x, y in zip(sets(part.column(2)), sets(part.column(3)), strict=True):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(linked, pa.bool_())], ["a", "b", "linked"])

        return work

    left = bodies.select(F.col("id").alias("a"), F.col("body").alias("body_a"))
    right = bodies.select(F.col("id").alias("b"), F.col("body").alias("body_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "body_a", "body_b")
    return map_batches(both, make, "a bigint, b bigint, linked boolean")


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", *, length: int = 5, percent: int = 80
) -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Texts are lower-cased (A-Z) and cut into sets of ``length``-word shingles; shorter texts
    are one shingle. Two documents are linked if their sets overlap by ``percent`` of their
    union, and a component is what links reach; ``component_id`` is its smallest key and
    ``kept`` marks that one.

    Equal sets are one node. Documents that share three min-hash values with another one
    (in one of 16 trees; a pair at 0.8 is missed with a chance of 1 in 100,000) go on. In
    rounds of 16 fresh sorted orders each looks for close neighbours outside its component
    so far; candidates are confirmed on their full sets. Rounds go on until two in a row link
    nothing new, so that dense regions get more and deeper orders and quiet ones few. Pairs
    already inside a component are not looked at again.

    Null, empty and blank texts have no shingles and are linked with nothing. Rows with a
    null key are kept with a null component. Rows with equal keys share a component, as keys
    are the nodes; other columns are ignored. An empty table gives no rows.
    """
    spark = documents.sparkSession
    signed = saved(signatures(documents, key, text, length), "signatures")
    nodes = signed.where("n > 0 AND id IS NOT NULL")
    alike = _salt(nodes.select("id", "fingerprint"))
    first = salted(alike, ["fingerprint"], F.min("id").alias("first"))
    copies = alike.join(first, ["fingerprint", "_salt"]).where("id != first").select("id", "first").distinct()
    links = saved(copies.select(F.col("id").alias("a"), F.col("first").alias("b")), "links")
    distinct = nodes.join(links.select(F.col("a").alias("id")).hint("merge"), "id", "left_anti")
    busy = crowded(distinct).hint("merge")
    members = distinct.join(busy, "id", "left_semi").select("id", "signature", "sketch").dropDuplicates(["id"])
    members = saved(members, "members")
    bodies = documents.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("body"))
    wanted = members.select("id").hint("merge")
    bodies = saved(zipped(bodies.join(wanted, "id", "left_semi").dropDuplicates(["id"]), "id", "body"), "bodies")

    found = spark.createDataFrame([], "node bigint, component bigint")
    seen = spark.createDataFrame([], "a bigint, b bigint, linked boolean")
    round_ = quiet = 0
    while quiet < QUIET_ROUNDS:
        placed = members.join(found, F.col("id") == F.col("node"), "left")
        placed = placed.select("id", F.coalesce("component", "id").alias("component"), "signature", "sketch")
        pairs = neighbour_pairs(placed, round_, percent / 100)
        fresh = pairs.join(seen, ["a", "b"], "left_anti")
        tested = saved(confirmed(fresh, bodies, length, percent), "tested")
        seen = seen.union(tested)
        round_ += 1
        if tested.where("linked").take(1):
            quiet = 0
            found = saved(components(seen.where("linked").select("a", "b")), "found")
        else:
            quiet += 1
    found = components(links.union(seen.where("linked").select("a", "b")))
    joined = signed.select("id", "n").join(found, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
