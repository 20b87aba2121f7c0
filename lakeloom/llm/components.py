"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import stored_at
from lakeloom.plans.workspace import delete_path


#: Edges that one task unites before the first round, about: 16 MB.
EDGES_IN_TASK = 1_000_000


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Few pairs that connect what the pairs ``a, b`` connect: each number with the smallest of its component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    pairs = np.unique(np.minimum(x, y) * len(nodes) + np.maximum(x, y))
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip((pairs // max(1, len(nodes))).tolist(), (pairs % max(1, len(nodes))).tolist()):
        i, j = root(i), root(j)
        if i != j:
            parent[max(i, j)] = min(i, j)
    roots = np.array([root(i) for i in range(len(nodes))], np.int64)
    linked = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[linked], nodes[roots[linked]]


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as a spanning forest."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if held:
        a, b = spanning_forest(*(np.concatenate(x) for x in zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _fingerprint(edges: DataFrame) -> tuple:
    # Sums of halves of a hash cannot overflow before 2**31 edges a partition sum of longs holds.
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftrightunsigned(h, 32)), F.sum(h.bitwiseAND(0xFFFFFFFF))).head())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b`` long): ``root`` is the
    smallest node of its component.

    First every task unites about ``EDGES_IN_TASK`` edges; of a graph that one
    task can hold nothing is left to do. Otherwise large-star and small-star
    steps alternate until the edges are stars. Each
    step is a map-side combined minimum and a join, so a node with very many
    neighbours is spread like any skewed join key; every round is written to
    the shared folder, the one before it is deleted.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    spark = edges.sparkSession
    edges, path = stored_at(edges, "components")
    tasks = -(-edges.count() // EDGES_IN_TASK)
    if tasks:
        last = path
        edges, path = stored_at(edges.coalesce(tasks).mapInArrow(_united, "a long, b long"), "components")
        delete_path(spark, last)
    before = _fingerprint(edges) if tasks > 1 else (0,)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last = path
        edges, path = stored_at(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "components")
        delete_path(spark, last)
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
