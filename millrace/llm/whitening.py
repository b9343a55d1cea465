"""Whitening of embeddings by a bit-sliced scatter matrix.

Entries become integers. Each dimension is shifted by its smallest value and cut into bit
planes, which are packed across rows into 64-bit words. The cross-product of two dimensions
is the sum over their planes of ``2 ** (a + b)`` times the bits that both planes have set, so
it is exact however the rows are dealt over tasks. Centring is done on the driver with
integers of any size, and only then turned into doubles for the eigenvectors.

What the driver sees is one number per pair of dimensions, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import map_batches, saved

SCALE, SHIFT = 64, 1_000_000
#: Scaled entries stay below this, so that sums over 2**40 rows fit 38 digits.
LARGEST = 1 << 40
#: Components with a smaller share of the largest eigenvalue are not told apart from rounding.
LEAST_SHARE = 1e-10


@dataclass(frozen=True)
class Fit:
    """What a whitening needs: ``low`` and ``sums`` are integers, ``components`` unit rows."""

    rows: int
    low: np.ndarray
    high: np.ndarray
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def axes(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)[:, None]


def entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of a list column, first entry of each row, and its length; -1 for a null list or a null or non-finite entry."""
    starts = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    lengths = np.diff(starts)
    gone = (bad[starts[1:]] > bad[starts[:-1]]) | column.is_null().to_numpy(zero_copy_only=False)
    return flat, starts[:-1], np.where(gone, -1, lengths)


def integers(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows with vectors of ``length``, and their entries as integers."""
    flat, starts, lengths = entries(column)
    rows = np.flatnonzero(lengths == length)
    scaled = np.floor(SCALE * flat[starts[rows][:, None] + np.arange(length)])
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"an embedding entry is {LARGEST // SCALE} or more in size")
    return rows, scaled.astype(np.int64) + SHIFT


def _ranges(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Smallest and largest integer per dimension, over the commonest length of vector."""

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            lengths = entries(batch.column(1))[2]
            for length in np.unique(lengths[lengths > 0]).tolist():
                _, x = integers(batch.column(1), length)
                low, high = x.min(axis=0), x.max(axis=0)
                place = np.arange(length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (np.full(length, length), place, np.full(length, len(x)), low, high)],
                    ["length", "place", "n", "low", "high"],
                )

        return work

    parts = map_batches(vectors, make, "length long, place long, n long, low long, high long")
    ranges = saved(
        parts.groupBy("length", "place").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")),
        "whitening_ranges",
    )
    first = ranges.where("place = 0").orderBy(F.desc("n"), F.desc("length")).first()
    if first is None:
        return None
    rows = ranges.where(F.col("length") == first.length).orderBy("place").select("low", "high").collect()
    return tuple(np.array(side, np.int64) for side in zip(*rows, strict=True))


def packed(shifted: np.ndarray, width: int) -> pa.Array:
    """Rows of small integers as binary values of one size."""
    data = np.ascontiguousarray(shifted.astype(f"<u{width}"))
    size = data.shape[1] * width
    ends = np.arange(len(data) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def unpacked(column: pa.Array, dimensions: int, width: int) -> np.ndarray:
    data = np.frombuffer(b"".join(column.to_pylist()), f"<u{width}")
    return data.reshape(-1, dimensions).astype(np.int64)


def bit_planes(shifted: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes as rows of 64-bit words, the weight of each plane, and each dimension's first plane.

    A last dimension of ones is added: its products with the others are their sums, and with
    itself the number of rows.
    """
    columns, weights, firsts = [], [], []
    for dimension, count in enumerate(bits.tolist()):
        firsts.append(len(columns))
        for bit in range(count):
            columns.append(((shifted[:, dimension] >> bit) & 1).astype(np.uint8))
            weights.append(1 << bit)
    firsts.append(len(columns))
    columns.append(np.ones(len(shifted), np.uint8))
    weights.append(1)
    octets = np.packbits(np.stack(columns), axis=1)
    octets = np.pad(octets, ((0, 0), (0, -octets.shape[1] % 8)))
    return np.ascontiguousarray(octets).view(np.uint64), np.array(weights, object), np.array(firsts)


def cross_products(shifted: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of dimensions, the added one last, as Python integers."""
    planes, weights, firsts = bit_planes(shifted, bits)
    both = np.zeros((len(planes), len(planes)), np.int64)
    for k in range(len(planes)):
        both[k, k:] = np.bitwise_count(planes[k:] & planes[k]).sum(axis=1, dtype=np.int64)
    both = np.maximum(both, both.T)
    kind = np.int64 if 2 * int(bits.max()) + int(len(shifted)).bit_length() < 62 else object
    weights = weights.astype(kind)
    weighted = both.astype(kind) * weights[:, None] * weights[None, :]
    sums = np.add.reduceat(np.add.reduceat(weighted, firsts, axis=0), firsts, axis=1)
    return sums.astype(object)


def _scatter(fit_list: DataFrame, bits: np.ndarray, width: int) -> list[list[int]]:
    dimensions = len(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimensions + 1, dimensions + 1), object)
        for batch in batches:
            if batch.num_rows:
                total = total + cross_products(unpacked(batch.column(0), dimensions, width), bits)
        if total[-1, -1]:
            i, j = np.triu_indices(dimensions + 1)
            values = pa.array([Decimal(v) for v in total[i, j]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), values], ["i", "j", "value"])

    parts = fit_list.mapInArrow(run, "i long, j long, value decimal(38,0)")
    table = [[0] * (dimensions + 1) for _ in range(dimensions + 1)]
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("value")).collect():
        table[i][j] = table[j][i] = int(value)
    return table


def _components(products: list[list[int]], most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvectors and eigenvalues of the centred covariance, largest first, and its trace."""
    *rows, sums = products
    n = sums[-1]
    centred = [[n * row[j] - row[-1] * sums[j] for j in range(len(rows))] for row in rows]
    covariance = np.array([[value / (n * n) for value in row] for row in centred])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors.T[::-1]
    kept = min(most, int((values > LEAST_SHARE * values[0]).sum()) if values[0] > 0 else 0)
    return vectors[:kept], values[:kept], sum(centred[k][k] for k in range(len(rows))) / (n * n)


def _vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(F.col(key).alias("_key"), F.col(vector).cast("array<double>").alias("_vector"))


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = 16) -> tuple[Fit, DataFrame] | None:
    """Fit on every distinct integer vector; also returns these vectors, packed. None without a vector."""
    vectors = _vectors(df.withColumn("_one", F.lit(1)), "_one", vector)
    ranges = _ranges(vectors)
    if ranges is None:
        return None
    low, high = ranges
    bits = np.array([max(1, int(h - l).bit_length()) for l, h in zip(low, high, strict=True)])
    width = next(w for w in (1, 2, 4, 8) if 8 * w >= bits.max())

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            _, x = integers(batch.column(1), len(low))
            yield pa.RecordBatch.from_arrays([packed(x - low, width)], ["x"])

        return work

    fit_list = saved(map_batches(vectors, make, "x binary").distinct(), "whitening_fit")
    products = _scatter(fit_list, bits, width)
    found, values, trace = _components(products, components)
    return Fit(products[-1][-1], low, high, products[-1][:-1], found, values, trace), fit_list


def centred(fit: Fit, x: np.ndarray) -> np.ndarray:
    """``n * x - S`` as integers; of any size where 64 bits do not hold their squares."""
    widest = fit.rows * (int((fit.high - fit.low).max()) + 1)
    kind = np.int64 if len(fit.low) * widest * widest < 1 << 63 else object
    return (x - fit.low).astype(kind) * fit.rows - np.array(fit.sums, kind)


def project(fit: Fit, deviations: np.ndarray) -> np.ndarray:
    return (deviations / fit.rows).astype(np.float64) @ fit.axes.T


def identity_error(fit: Fit, fit_list: DataFrame) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, in size."""
    dimensions, width = len(fit.low), next(w for w in (1, 2, 4, 8) if 256**w > int((fit.high - fit.low).max()))
    count = len(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count))
        for batch in batches:
            if batch.num_rows:
                z = project(fit, centred(fit, unpacked(batch.column(0), dimensions, width) + fit.low))
                total += np.vstack([z.T @ z, z.sum(axis=0)])
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], ["i", "j", "value"])

    sums = np.zeros((count + 1, count))
    for i, j, value in fit_list.mapInArrow(run, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value")).collect():
        sums[i, j] = value / fit.rows
    covariance = sums[:-1] - np.outer(sums[-1], sums[-1])
    return float(np.abs(covariance - np.eye(count)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """Whitened coordinates of every vector: one row per vector and component.

    Returns ``key``, ``component`` (from 1, by falling eigenvalue), ``n`` (distinct integer
    vectors, which the fit counts once), ``deviation`` (exact sum of ``(n * x - S) ** 2``),
    ``whitened``, ``explained`` (the component's share of the variance) and
    ``identity_error`` (measured on the whitened fit list, one value).

    Rows whose vector is null, empty, or holds a null or non-finite entry are left out, and
    so are vectors of another length than the commonest (of equally common ones the longer).
    Repeated rows and null keys are kept as they are; repeated vectors count once in the fit.
    Other columns are not read. Components whose eigenvalue is under 1e-10 of the largest
    are left out, so a table with a single distinct vector, like an empty one, gives no rows.
    Eigenvalues that tie may come in either order, with any basis of their plane. An entry
    of 2**34 or more in size raises an error, and so does a deviation that no long holds.
    """
    kind = df.schema[key].dataType.simpleString()
    columns = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted = fit_whitening(df, vector, components)
    if fitted is None or not len(fitted[0].values):
        return df.sparkSession.createDataFrame([], schema)
    fit, fit_list = fitted
    error, count = identity_error(fit, fit_list), len(fit.values)
    explained = fit.values / fit.trace

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows, x = integers(batch.column(1), len(fit.low))
            deviations = centred(fit, x)
            squares = pa.array((deviations * deviations).sum(axis=1).tolist(), pa.int64())
            number = np.repeat(np.arange(len(rows)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows[number])),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(number), fit.rows)),
                    squares.take(pa.array(number)),
                    pa.array(project(fit, deviations).reshape(-1)),
                    pa.array(np.tile(explained, len(rows))),
                    pa.array(np.full(len(number), error)),
                ],
                columns,
            )

        return work

    return map_batches(_vectors(df, key, vector), make, schema)
