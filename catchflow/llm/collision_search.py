"""Approximate nearest neighbours by collision counting over single-projection sorted arrays.

Unit vectors are projected on ``PROJECTIONS`` random directions, and each projection is one sorted array. Around a
query's own projections, windows of half-width h open in all arrays at once and widen step by step; only what the
step adds is counted (virtual rehashing: no array is built twice). A vector that has fallen into ``THRESHOLD`` of the
windows is verified by its exact cosine.

When the search stops: a vector at distance D falls into one window with probability ``2 * Phi(h / D) - 1``. With D
the distance of the k-th best verified vector, windows of ``h = Z * D`` make a nearer vector reach the threshold with
probability ``SURE`` or more; Z follows from the binomial distribution. A step therefore never goes beyond ``Z * D``,
and until k vectors are verified the windows go on to whole arrays, where every vector is. There is no cap on
candidates or on verified vectors.

In Spark: rows are dealt by hash into blocks of about ``BLOCK`` vectors, and each block has its arrays to itself. Every
block meets all queries in a stream (index rows sort first), so a task's memory is one block's arrays, whatever the
number of queries; a block returns k rows a query, and Spark ranks these. Every row is indexed, nothing is fitted.
The queries are sent once to each block: rows dealt are ``n + queries * n / BLOCK``, so BLOCK is to be as large as a
task's memory allows (about 1.5 KB a row).

Results in edge cases: vectors that are null, empty, zero or hold null or non-finite components take no part; a query
that is left alone has no rows. Vectors of different lengths never meet. Repeated rows and ids are vectors of their own:
a row is a candidate for its twin. A null vec_id is a candidate, last among ties, and no query. Ties go to the smaller
vec_id. No rows give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep_table, partitions, prepare

PROJECTIONS = 64
THRESHOLD = 48
SURE = 0.95
FIRST = 0.1  # half-width of the first windows
STEP = 1.5
BLOCK = 16384
SEED = 20_011


def window_factor(m: int, threshold: int, sure: float) -> float:
    """Z: with half-width Z * D, a vector at distance D collides ``threshold`` times of ``m`` with probability ``sure``."""
    def reached(p: float) -> float:
        return sum(math.comb(m, i) * p ** i * (1 - p) ** (m - i) for i in range(threshold, m + 1))

    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if reached(mid) >= sure else (mid, hi)
    return NormalDist().inv_cdf((1 + min(hi, 1 - 1e-12)) / 2)


def directions(dim: int, m: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, m))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component near 1: cosines stay exactly what they are."""
    _, e = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x, -e[:, None])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with ``query``, by the same sums for a pair wherever it's computed."""
    return (rows * query).sum(1) / (np.sqrt((rows * rows).sum(1)) * np.sqrt((query * query).sum()))


class SortedArrays:
    """One block's vectors, their projections in sorted order, and the search over them."""

    def __init__(self, nodes: np.ndarray, ids: np.ndarray, vectors: np.ndarray, m: int = PROJECTIONS, threshold: int = THRESHOLD, sure: float = SURE):
        self.nodes, self.ids, self.x = nodes, ids, scaled(vectors)
        self.unit = unit(self.x)
        self.m, self.threshold, self.z = m, threshold, window_factor(m, threshold, sure)
        self.a = directions(vectors.shape[1], m)
        proj = self.unit @ self.a
        self.order = [np.argsort(proj[:, i], kind="stable") for i in range(m)]
        self.find = [np.ascontiguousarray(proj[o, i]).searchsorted for i, o in enumerate(self.order)]
        self.verified = 0  # vectors compared exactly, over all queries

    def nearest(self, node: int, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, cosines) of the k best found, the query's own row (``node``) left out; ties to the smaller id."""
        query = scaled(vector[None])[0]
        toward = unit(query[None])[0]
        q = toward @ self.a
        n, h = len(self.nodes), FIRST
        counts = np.zeros(n, np.int64)
        lo = hi = [int(f(c)) for f, c in zip(self.find, q.tolist())]
        open_ = np.ones(n, bool)
        open_[self.nodes == node] = False
        rows, score = np.zeros(0, np.int64), np.zeros(0)
        while True:
            new_lo = [int(f(c - h)) for f, c in zip(self.find, q.tolist())]
            new_hi = [int(f(c + h, "right")) for f, c in zip(self.find, q.tolist())]
            parts = [o[x:y] for o, x, y in zip(self.order, new_lo, lo)] + [o[x:y] for o, x, y in zip(self.order, hi, new_hi)]
            counts += np.bincount(np.concatenate(parts), minlength=n)
            lo, hi = new_lo, new_hi
            hit = np.flatnonzero(open_ & (counts >= self.threshold))
            if len(hit):
                open_[hit] = False
                self.verified += len(hit)
                rows, score = np.append(rows, hit), np.append(score, self.unit[hit] @ toward)
                if len(rows) > k:  # what rounding may still put among the k best stays
                    best = score >= np.partition(score, -k)[-k] - 1e-12
                    rows, score = rows[best], score[best]
            if not open_.any() or (min(hi) == n and max(lo) == 0):
                break
            reach = math.inf
            if len(rows) >= k:
                reach = self.z * math.sqrt(max(0.0, 2 - 2 * score.min()))
                if h >= reach:
                    break
            h = min(h * STEP, reach)
        score = cosines(self.x[rows], query)
        best = np.lexsort((self.ids[rows], -score))[:k]
        return rows[best], score[best]


# ---------------------------------------------------------------- in Spark

LAST = np.iinfo(np.int64).max  # stands for a null id: last among ties


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = b.column("embedding")
        flat = col.flatten().to_numpy(zero_copy_only=False).astype("<f8")
        at = np.append(0, np.cumsum(np.asarray(pc.list_value_length(col)))) if b.num_rows else np.zeros(1, int)
        vecs = pa.array([flat[x:y].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("vec_id"), b.column("dim"), vecs], names=["node", "vec_id", "dim", "vec"])


def _search(k: int):
    """Rows (dim, block, query, node, vec_id, vec), a block's index rows first -> the k best of each block and query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, arrays = None, [], None
        for b in batches:
            found = ([], [], [], [])
            cols = [b.column(c).to_pylist() for c in ("dim", "block", "query", "node", "vec_id", "vec")]
            for dim, block, query, node, vec_id, vec in zip(*cols):
                if (dim, block) != now:
                    now, held, arrays = (dim, block), [], None
                if not query:
                    held.append((node, LAST if vec_id is None else vec_id, vec))
                    continue
                if held:
                    nodes, ids, vecs = zip(*held)
                    arrays = SortedArrays(np.array(nodes), np.array(ids), np.frombuffer(b"".join(vecs), "<f8").reshape(len(vecs), dim))
                    held = []
                if arrays is None:
                    continue
                rows, score = arrays.nearest(node, np.frombuffer(vec, "<f8"), k)
                for x, y in zip(found, (np.full(len(rows), node), np.full(len(rows), vec_id), arrays.ids[rows], score)):
                    x.append(y)
            if found[0]:
                node, query_id, ids, score = (np.concatenate(x) for x in found)
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(query_id, pa.int64()), pa.array(ids, pa.int64()), pa.array(score, pa.float64())],
                                                 names=["node", "query_id", "vec_id", "score"])
    return run


def usable(embedding: str | Column) -> Column:
    """Whether a vector has a direction: no null, no non-finite component, not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return F.coalesce(~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def search(vectors: DataFrame, queries: Column, k: int = 5, block: int = BLOCK) -> DataFrame:
    """``vectors`` (vec_id, embedding): each row for which ``queries`` holds -> query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    prepare(spark)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    v = v.where(usable("embedding")).select(F.monotonically_increasing_id().alias("node"), "vec_id", F.size("embedding").alias("dim"), "embedding")
    packed = keep_table(v.mapInArrow(_pack, "node long, vec_id long, dim int, vec binary"), "search-vectors")
    blocks = max(1, -(-packed.count() // block))
    index = packed.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")).withColumn("query", F.lit(0))
    asked = (packed.where(F.coalesce(queries, F.lit(False)) & F.col("vec_id").isNotNull())
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("query", F.lit(1)))
    dealt = (index.union(asked).repartition(partitions(spark), "dim", "block").sortWithinPartitions("dim", "block", "query", "node"))
    found = dealt.mapInArrow(_search(k), "node long, query_id long, vec_id long, score double")
    by = Window.partitionBy("node").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("vec_id") != int(LAST), F.col("vec_id")).alias("vec_id"), "score"))


def op11_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50, among all vectors."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
