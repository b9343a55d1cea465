"""Connected components of a table of links, by contraction and alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import saved


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of one task as stars: each node with the smallest node it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    left, right = at[: len(a)], at[len(a) :]
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def contracted(links: DataFrame) -> DataFrame:
    """Links (a, b) replaced, task by task, by stars with the same components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b = np.zeros(0, np.int64)
        for batch in batches:
            a, b = forest(
                np.concatenate([a, batch.column(0).to_numpy()]), np.concatenate([b, batch.column(1).to_numpy()])
            )
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def star(links: DataFrame) -> DataFrame:
    """Every node and its neighbours linked to the smallest of them; what stays unchanged is kept."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    joined = both.join(least, "a")
    pairs = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(joined.select("a", F.col("low").alias("b")))
    return pairs.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component``, the smallest node reachable, for every linked node.

    ``links`` has long columns ``a`` and ``b``. Tasks contract their own links first, so
    that few rounds remain; a round joins links with the smallest neighbour of each node.
    It ends when every node's only link leads to its component.
    """
    stars = saved(contracted(links.where("a != b")), "stars")
    while True:
        nodes = stars.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("low"))
        inner = stars.select(F.col("b").alias("a")).distinct().join(stars.select("a").distinct(), "a", "left_semi")
        if not (nodes.where("n > 1").take(1) or inner.take(1)):
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        stars = saved(contracted(star(stars)), "stars")
