"""Connected components of a link table, by alternating large-star and small-star rounds.

Both stars replace a node's links by links to the smallest neighbour. Each is a grouped minimum (combined
before the shuffle, so a node with very many links is no hot group) and a join that may be split when
skewed. The number of links never grows, no node's links are gathered in one row, and each round's result
is written to the shared folder. Before the first round each task replaces the links that it reads by a forest, so a group in which
every node has many links begins with few a node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import longs
from .common import cut

#: Links that a task holds at once.
HELD = 1 << 20


def components(links: DataFrame) -> DataFrame:
    """links: a, b long (any order, repeats and self-links allowed; rows with a null are left out).
    Returns id, root: each linked node with the smallest id it can reach. Nodes without a link are absent."""
    e = cut(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links", narrow=True
    )
    e = cut(e.mapInArrow(_forests, "u long, v long").distinct(), "forest", narrow=True)
    seen = None
    while True:
        e = cut(_small_star(_large_star(e)), "star", narrow=True)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
            )
        seen = now


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same nodes as u, v: of each node but a tree's smallest with that one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = np.arange(len(nodes))
    unite(parent, at[: len(u)], at[len(u) :])
    root = flatten(parent)
    linked = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[linked], nodes[root[linked]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def all_held() -> pa.RecordBatch:
        u, v = forest(*(np.concatenate(x) for x in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        held.append((longs(batch.column("u")), longs(batch.column("v"))))
        if sum(len(u) for u, _ in held) >= HELD:
            yield all_held()
            held = []
    if held:
        yield all_held()


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.withColumnRenamed("m", "v")).distinct()


def unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union-find over arrays of pairs: parent[k] <= k, and each pair's trees are joined in place."""
    while len(i):
        i, j = _roots(parent, i), _roots(parent, j)
        keep = i != j
        i, j = np.maximum(i, j)[keep], np.minimum(i, j)[keep]
        np.minimum.at(parent, i, j)


def _roots(parent: np.ndarray, i: np.ndarray) -> np.ndarray:
    while True:
        up = parent[i]
        if np.array_equal(up, i):
            return i
        parent[i] = parent[up]
        i = up


def flatten(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return up
        parent = up
