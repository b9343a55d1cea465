"""Packing of tokenised documents into sequences of bounded length by minimum bin slack."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import map_batches, saved
from millrace.llm.text import texts
from millrace.llm.vocabulary import ByteIds, worker_memory

CAPACITY = 1024
END_ID = 2
GROUP_ROWS = 20_000
PIECE_FIELDS = "piece int, start bigint, length bigint, ids_crc32 bigint"


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` tokens: full ones, but for the first."""
    first = total % capacity
    spans = [(0, first)] if first else []
    return spans + [(s, capacity) for s in range(first, total, capacity)]


def tokenised_pieces(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """The pieces of every document, one row each, with an end id after the last token.

    ``with_ids`` adds the ids themselves (little-endian 32-bit numbers). A null or empty
    text is one piece that holds the end id only.
    """

    def make():
        vocabulary = worker_memory(("byte ids", folder), lambda: ByteIds(folder))
        end = end_id.to_bytes(4, "little")

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows, made = [], []
            for row, text in enumerate(texts(batch.column(1))):
                ids = vocabulary.ids(text) + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append(row)
                    made.append((piece, start, length, zlib.crc32(part), part if with_ids else b""))
            columns = list(zip(*made, strict=True))
            arrays = [batch.column(0).take(pa.array(rows)), pa.array(columns[0], pa.int32())]
            arrays += [pa.array(c, pa.int64()) for c in columns[1:4]]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(columns[4], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

        return work

    rows = documents.select(F.col(key), F.col(text).cast("string"))
    kind = rows.schema[key].dataType.simpleString()
    return map_batches(rows, make, f"`{key}` {kind}, {PIECE_FIELDS}" + (", ids binary" if with_ids else ""))


def fullest(room: int, counts: list[int]) -> dict[int, int]:
    """Lengths, with how often each is used, whose sum is the largest that fits ``room``.

    Bit ``s`` of a set says that sum ``s`` can be reached. Lengths are tried from the
    longest on, so that short pieces are left for later bins, and the search ends as soon
    as the room can be filled.
    """
    mask, full = (1 << room + 1) - 1, 1 << room
    reached, steps = 1, []
    for length in range(min(room, len(counts) - 1), 0, -1):
        left = min(counts[length], room // length)
        take = 1
        while left:
            take = min(take, left)
            steps.append((length, take, reached))
            reached |= reached << length * take & mask
            left -= take
            take *= 2
        if reached & full:
            break
    rest, used = reached.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> rest & 1:
            rest -= length * take
            used[length] = used.get(length, 0) + take
    return used


@dataclass
class Runs:
    """Which stretch of the pieces of one length goes to which stretch of sequences.

    Its size depends on the capacity, not on the number of pieces.
    """

    length: np.ndarray
    first: np.ndarray
    bins: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide = 1 << 48
        at = np.searchsorted(self.length * wide + self.first, length * wide + rank, side="right") - 1
        inner = rank - self.first[at]
        copy, number = np.divmod(inner, self.bins[at])
        return self.sequence[at] + number, self.offset[at] + copy * length


def minimum_slack(histogram: dict[int, int], capacity: int) -> Runs:
    """Fill bins one after another; equal bins are filled in one go.

    A bin takes the longest piece left and the fullest combination of the others. The same
    combination is the fullest for as many further bins as its pieces last.
    """
    counts = [0] * (capacity + 1)
    for length, count in histogram.items():
        counts[length] = count
    used = [0] * (capacity + 1)
    rows, sequences = [], 0
    for longest in range(capacity, 0, -1):
        while counts[longest]:
            counts[longest] -= 1
            combination = fullest(capacity - longest, counts)
            counts[longest] += 1
            combination[longest] = combination.get(longest, 0) + 1
            bins = min(counts[length] // times for length, times in combination.items())
            offset = 0
            for length, times in sorted(combination.items(), reverse=True):
                rows.append((length, used[length], bins, sequences, offset))
                used[length] += times * bins
                counts[length] -= times * bins
                offset += length * times
            sequences += bins
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Runs(*table.T.copy(), sequences)


def pack(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    Pieces are numbered within their length: hashed groups of about 20,000 rows are
    ranked on their own and shifted by the sizes of the groups before, so that a length
    that most pieces have is no single group. Only the histogram of lengths, at most
    ``capacity`` rows, comes to the driver. Rows equal in all ``keys`` may swap places;
    no row is lost. The pieces must be a stored table, as they are read several times.
    """
    histogram = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}
    runs = minimum_slack(histogram, capacity)
    groups = 1 + sum(histogram.values()) // GROUP_ROWS
    marked = pieces.withColumn("_group", F.pmod(F.xxhash64(*keys), F.lit(groups)))
    sizes = marked.groupBy(length, "_group").count()
    before = Window.partitionBy(length).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(length, "_group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    own = Window.partitionBy(length, "_group").orderBy(*keys)
    ranked = marked.withColumn("_rank", F.row_number().over(own) - 1).join(shifts, [length, "_group"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_shift")).select(*pieces.columns, "_rank")

    names = [*pieces.columns, "sequence_id", "offset"]

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            lengths = batch.column(batch.schema.get_field_index(length)).to_numpy().astype(np.int64)
            sequence, offset = runs.place(lengths, batch.column(batch.num_columns - 1).to_numpy())
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays += [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names)

        return work

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields]
    return map_batches(ranked, make, ", ".join([*fields, "sequence_id bigint", "offset bigint"]))


def pack_documents(
    documents: DataFrame, key: str = "doc_id", text: str = "text", *, capacity: int = CAPACITY, folder: str | None = None
) -> DataFrame:
    """All documents in as few sequences as minimum bin slack finds, one row per piece.

    Null and empty texts take one token (the end id), an empty table gives no rows, rows
    with the same key are packed each on its own, other columns are ignored.
    """
    pieces = saved(tokenised_pieces(documents, key, text, capacity=capacity, folder=folder), "pieces")
    return pack(pieces, [key, "piece", "start", "ids_crc32"], capacity)
