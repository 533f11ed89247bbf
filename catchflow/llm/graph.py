"""Connected components of a table of edges, by alternating large-star and small-star steps.

Edges are first contracted where they lie: every task turns its edges, a bounded number at a time, into a forest. Each
step after that is a grouped minimum and a join, so no node's neighbours are ever gathered in one place; every round is
written to the shared folder and the one before it deleted. A node with more than its share of the edges gets its minimum by a broadcast, so its
edges aren't shuffled to one task: more than ``1 / MOST`` of all ends lie at fewer than ``MOST`` nodes, whatever the
graph. Nothing else of the graph reaches the driver but its size and a checksum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, keep_table, prepare

MOST = 1000  # no more nodes than this are broadcast
HUB = 1000  # nodes with fewer edges are never hubs
CONTRACT = 1_000_000  # edges contracted at a time, 16 bytes each


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect what the edges (a, b) connect; one for each node that isn't a root."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            hop = new[new]
            if (hop == new).all():
                break
            new = hop
        if (new == root).all():
            break
        root = new
    far = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[far], nodes[root[far]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) -> edges (node, smaller root) that connect the same."""
    held, count = [], 0

    def close():
        u, v = forest(*(np.concatenate(x) for x in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for b in batches:
        if b.num_rows:
            held.append((b.column("u").to_numpy(), b.column("v").to_numpy()))
            count += b.num_rows
        if count >= CONTRACT:
            yield close()
            held, count = [], 0
    if count:
        yield close()


def _low(e: DataFrame) -> DataFrame:
    """(c, m, n): each u, the smallest v beside it and how many there are."""
    return e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(F.col("u").alias("c"), "m", "n")


def _beside(e: DataFrame, low: DataFrame, hub: int) -> DataFrame:
    """Each edge (u, v) of ``e`` with the ``m`` of u; edges of nodes with more than ``hub`` stay where they are."""
    hubs = F.broadcast(low.where(F.col("n") > hub).select(F.col("c").alias("h"), F.col("m").alias("hm")))
    near = e.join(hubs, F.col("u") == F.col("h")).select("u", "v", F.col("hm").alias("m"))
    rest = e.join(hubs, F.col("u") == F.col("h"), "left_anti").join(low.where(F.col("n") <= hub), F.col("u") == F.col("c"))
    return near.union(rest.select("u", "v", "m"))


def _large_star(e: DataFrame, hub: int) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _low(both).withColumn("m", F.least("c", "m"))
    return _beside(both.where("v > u"), low, hub).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame, hub: int) -> DataFrame:
    low = _low(e)
    moved = _beside(e, low, hub).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, least_hub: int = HUB) -> DataFrame:
    """``edges`` (a, b) longs -> (node, root): root is the smallest node that links reach; nodes without edges are left out.

    Loops and repeated edges do no harm; null ends are dropped; no edges give no rows.
    """
    prepare(edges.sparkSession)
    e = edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
    e, before = keep_table(e.mapInArrow(_contract, "u long, v long").distinct(), "edges"), None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before is not None and tuple(now) == before:
            break
        before = tuple(now)
        if not before[0]:
            break
        hub = max(least_hub, 2 * before[0] // MOST)  # of large-star's 2 n ends, and small-star's n
        star = keep_table(_large_star(e, hub), "edges-large")
        drop_table(e)
        e = keep_table(_small_star(star, hub), "edges")
        drop_table(star)
    # every edge now goes from a node straight to its root
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())
