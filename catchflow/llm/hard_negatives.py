"""Hard negatives by an inverted multi-index that stops on certified windows.

A vector's two halves are each coded by the nearest word of their own codebook; a pair of words is a cell. For a query
and a half, a word's bound is its inner product with the query's half plus the half's norm times the word's radius (the
largest distance of a member to the word), so no member scores more in that half. The multi-sequence heap visits cells
by the sum of their two bounds, largest first. Whatever isn't visited yet scores no more than the next cell's sum:

* a query's positives are certain when the last of them scores more than that sum;
* a window of negatives is certain when it has its rows and the last of them scores more than that sum, or the sum is
  below the window.

So the search stops early and the answer is exact; a query for which nothing is certain visits every cell.

In Spark: rows are dealt by hash into blocks of about ``BLOCK`` rows; a block indexes its rows once, by one pair of
codebooks for all (fitted on at most ``SAMPLE`` rows; they decide the order of visits alone). Queries stream past every
block. The first pass gives the positives of each block, ranked over all blocks; the second takes each query with its
windows past the blocks again. Memory is one block's rows and cells; nothing but the sample reaches the driver. Rows
dealt are ``2 * (n + queries * n / BLOCK)``, so BLOCK is to be as large as a task's memory allows.

Results in edge cases: rows with a null label, a null vector or a null or non-finite component take no part; zero and
empty vectors do. Vectors of different lengths never meet. Repeated rows and ids are rows of their own ("other rows"
includes a twin). A null vec_id is a candidate, last among ties, and no anchor. A negative positive score has an empty
window. Components and scores are exact while ``256 * x`` and the inner product fit a long; larger components are held
at the largest long, and larger scores are reported as that. No rows give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep_table, partitions, prepare

WORDS = 16  # words of a half's codebook
SAMPLE = 4096
ROUNDS = 8
BLOCK = 16384
BATCH = 512  # the least rows that are scored at once
LAST = np.iinfo(np.int64).max  # stands for a null id: last among ties


# ---------------------------------------------------------------- the index

def codebook(points: np.ndarray, words: int = WORDS, rounds: int = ROUNDS) -> np.ndarray:
    """``words`` centres by Lloyd's rounds from a farthest-first start; fewer if there are fewer distinct points."""
    if not points.size:
        return np.zeros((1, points.shape[1]))
    points = np.unique(points, axis=0)
    pick, far = [0], ((points - points[0]) ** 2).sum(1)
    while len(pick) < min(words, len(points)) and far.max() > 0:
        pick.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[pick[-1]]) ** 2).sum(1))
    centres = points[pick]
    for _ in range(rounds):
        word = nearest_word(points, centres)
        n = np.bincount(word, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, word, points)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest_word(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2 * points @ centres.T).argmin(1)


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows: in doubles where all sums fit 53 bits, else in Python's integers."""
    biggest = float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, rows.shape[1])
    if biggest < 2 ** 53:
        return np.rint(rows.astype(float) @ query.astype(float)).astype(np.int64)
    return rows.astype(object) @ query.astype(object)


class MultiIndex:
    """Rows of one length in cells of two codebooks."""

    def __init__(self, nodes: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        self.books, self.half = books, rows.shape[1] // 2
        halves = rows[:, :self.half].astype(float), rows[:, self.half:].astype(float)
        words = [nearest_word(x, c) for x, c in zip(halves, books)]
        # a radius a word, a little wide for rounding; a word without members is never visited
        self.radius = [np.full(len(c), -np.inf) for c in books]
        for r, x, w, c in zip(self.radius, halves, words, books):
            np.maximum.at(r, w, np.sqrt(((x - c[w]) ** 2).sum(1)) * (1 + 1e-9) + 1e-9)
        cell = words[0] * len(books[1]) + words[1]
        order = np.argsort(cell, kind="stable")
        self.nodes, self.ids, self.labels, self.rows = nodes[order], ids[order], labels[order], rows[order]
        self.at = np.searchsorted(cell[order], np.arange(len(books[0]) * len(books[1]) + 1))
        # rows as doubles where every product is exact in them
        self.exact = float(np.abs(rows).max(initial=0)) ** 2 * max(1, rows.shape[1]) < 2 ** 53
        self.doubles = self.rows.astype(float) if self.exact else None
        self.scored = 0  # rows compared, over all queries

    def visits(self, query: np.ndarray) -> Iterator[tuple[float, int]]:
        """(bound, cell) from the largest bound down: the multi-sequence heap over the two sorted lists of half bounds."""
        lists = []
        for x, c, r in zip((query[:self.half].astype(float), query[self.half:].astype(float)), self.books, self.radius):
            norm = math.sqrt(float((x * x).sum()))
            used = np.flatnonzero(r > -np.inf)
            bound = c[used] @ x + norm * r[used]
            bound += 1e-9 * (1 + norm * (np.sqrt((c[used] ** 2).sum(1)) + r[used]))  # rounding never makes it too small
            order = np.argsort(-bound, kind="stable")
            lists.append((bound[order].tolist(), used[order].tolist()))
        (u, i_word), (v, j_word) = lists
        if not u:
            return
        width, heap, seen = len(self.books[1]), [(-(u[0] + v[0]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield -bound, i_word[i] * width + j_word[j]
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(u) and y < len(v) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (-(u[x] + v[y]), x, y))

    def scores(self, query: np.ndarray, enough) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the cells visited until ``enough(rows, scores, bound)`` says that no cell below ``bound`` matters."""
        rows, score, waiting, size, want = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0, BATCH
        q = query.astype(float)
        fits = self.exact and float(np.abs(query).max(initial=0)) * float(np.abs(self.doubles).max(initial=0)) * max(1, len(query)) < 2 ** 53

        def take() -> None:
            nonlocal rows, score, size, want
            pick = np.concatenate(waiting)
            new = np.rint(self.doubles[pick] @ q).astype(np.int64) if fits else products(self.rows[pick], query)
            rows, score = np.append(rows, pick), np.append(score, new)
            self.scored += len(pick)
            waiting.clear()
            size, want = 0, 2 * want

        for bound, cell in self.visits(query):
            if size >= want:
                take()
                if enough(rows, score, bound):
                    return rows, score
            lo, hi = self.at[cell], self.at[cell + 1]
            if hi > lo:
                waiting.append(np.arange(lo, hi))
                size += hi - lo
        if waiting:
            take()
        return rows, score

    def positives(self, node: int, label: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best other rows of the label."""
        def mine(rows, score):
            ok = (self.labels[rows] == label) & (self.nodes[rows] != node)
            return rows[ok], score[ok]

        def enough(rows, score, bound):
            _, s = mine(rows, score)
            return len(s) >= k and np.sort(s)[-k] > bound

        rows, score = mine(*self.scores(query, enough))
        best = sorted(range(len(rows)), key=lambda i: (-int(score[i]), int(self.ids[rows[i]])))[:k] if score.dtype == object else np.lexsort((self.ids[rows], -score))[:k]
        return rows[best], score[best]

    def negatives(self, label: int, query: np.ndarray, positive: list[int], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each positive score p: (rows, scores) of the k best of other labels with 50 p <= 100 score <= 95 p."""
        windows = [(-(-50 * p // 100), 95 * p // 100) for p in positive]  # whole scores from, to
        least = min((lo for lo, hi in windows if lo <= hi), default=None)
        empty = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if least is None:
            return [empty for _ in windows]

        def enough(rows, score, bound):
            if bound < least:
                return True
            other = score[self.labels[rows] != label]
            for lo, hi in windows:
                if lo <= hi and bound >= lo:
                    s = other[(other >= lo) & (other <= hi)]
                    if len(s) < k or np.sort(s)[-k] <= bound:
                        return False
            return True

        rows, score = self.scores(query, enough)
        ok = (self.labels[rows] != label) & (score >= least)
        rows, score = rows[ok], score[ok]
        out = []
        for lo, hi in windows:
            at = np.flatnonzero((score >= lo) & (score <= hi))
            if score.dtype == object:
                best = at[sorted(range(len(at)), key=lambda i: (-int(score[at[i]]), int(self.ids[rows[at[i]]])))[:k]]
            else:
                if len(at) > 4 * k:
                    at = at[score[at] >= np.partition(score[at], -k)[-k]]
                best = at[np.lexsort((self.ids[rows[at]], -score[at]))[:k]]
            out.append((rows[best], score[best]))
        return out


# ---------------------------------------------------------------- in Spark

def _long(score: np.ndarray) -> np.ndarray:
    return score if score.dtype == np.int64 else np.array([max(-LAST - 1, min(LAST, int(s))) for s in score], np.int64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components to floor(256 x) as longs."""
    for b in batches:
        col = b.column("embedding")
        flat = np.floor(256 * col.flatten().to_numpy(zero_copy_only=False).astype(float))
        whole = np.where(flat >= 2.0 ** 63, LAST, np.clip(flat, -(2.0 ** 63), 2.0 ** 63 - 1024).astype(np.int64)).astype("<i8")
        at = np.append(0, np.cumsum(np.asarray(pc.list_value_length(col)))) if b.num_rows else np.zeros(1, int)
        vecs = pa.array([whole[x:y].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("node", "vec_id", "label", "dim")], vecs], names=["node", "vec_id", "label", "dim", "vec"])


_FOUND = ["node", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score", "place"]


def _miner(books: dict[int, tuple[np.ndarray, np.ndarray]], k: int, second: bool):
    """Rows (dim, block, query, node, vec_id, label, vec, positives), a block's index rows first -> what each block finds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, index = None, [], None
        for b in batches:
            out = []
            for dim, block, query, node, vec_id, label, vec, wanted in zip(*[b.column(c).to_pylist() for c in ("dim", "block", "query", "node", "vec_id", "label", "vec", "positives")]):
                if (dim, block) != now:
                    now, held, index = (dim, block), [], None
                if not query:
                    held.append((node, LAST if vec_id is None else vec_id, label, vec))
                    continue
                if held:
                    nodes, ids, labels, vecs = zip(*held)
                    rows = np.frombuffer(b"".join(vecs), "<i8").reshape(len(vecs), dim)
                    index, held = MultiIndex(np.array(nodes), np.array(ids), np.array(labels), rows, books.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))), []
                if index is None:
                    continue
                v = np.frombuffer(vec, "<i8")
                if not second:
                    rows, score = index.positives(node, label, v, k)
                    out += [(node, vec_id, i, s, None, None, None) for i, s in zip(index.ids[rows].tolist(), _long(score).tolist())]
                    continue
                found = index.negatives(label, v, [w["score"] for w in wanted], k)
                for place, (w, (rows, score)) in enumerate(zip(wanted, found)):
                    out += [(node, vec_id, w["id"], w["score"], i, s, place) for i, s in zip(index.ids[rows].tolist(), _long(score).tolist())]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=_FOUND)
    return run


def _fit(packed: DataFrame, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Codebooks of the vectors' lengths in the sample: the rows with the smallest hashes."""
    drawn = packed.orderBy(F.xxhash64("node"), "node").limit(sample).select("dim", "vec").collect()
    books = {}
    for dim in {r["dim"] for r in drawn}:
        vecs = [r["vec"] for r in drawn if r["dim"] == dim]
        x = np.frombuffer(b"".join(vecs), "<i8").reshape(len(vecs), dim).astype(float)
        books[dim] = codebook(x[:, :dim // 2]), codebook(x[:, dim // 2:])
    return books


def mine(vectors: DataFrame, positives: int = 5, negatives: int = 3, every: int = 50, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    prepare(spark)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = (v.where(F.col("label").isNotNull() & F.coalesce(~bad, F.lit(False)))
         .select(F.monotonically_increasing_id().alias("node"), "vec_id", moved.alias("label"), F.size("embedding").alias("dim"), "embedding"))
    packed = keep_table(v.mapInArrow(_pack, "node long, vec_id long, label long, dim int, vec binary"), "mine-vectors")
    books = _fit(packed, sample)
    blocks = max(1, -(-packed.count() // block))
    wanted = "array<struct<id:long,score:long>>"
    index = packed.select("dim", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("query"), "node", "vec_id", "label", "vec",
                          F.lit(None).cast(wanted).alias("positives"))

    def past(asked: DataFrame, second: bool) -> DataFrame:
        dealt = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("query", F.lit(1)).select(*index.columns)
        rows = index.union(dealt).repartition(partitions(spark), "dim", "block").sortWithinPartitions("dim", "block", "query", "node")
        return rows.mapInArrow(_miner(books, negatives if second else positives, second), ", ".join(f"{c} long" for c in _FOUND))

    anchors = packed.where(F.col("vec_id") % every == 0)
    first = past(anchors.withColumn("positives", F.lit(None).cast(wanted)), False)
    best = Window.partitionBy("node").orderBy(F.col("positive_score").desc(), "positive_id")
    top = (first.withColumn("r", F.row_number().over(best)).where(F.col("r") <= positives)
           .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("r", F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("p"))
           .select("node", F.transform("p", lambda x: F.struct(x["id"].alias("id"), x["score"].alias("score"))).alias("positives")))
    asked = keep_table(anchors.join(top, "node"), "mine-anchors")
    found = past(asked, True)
    near = Window.partitionBy("node", "place").orderBy(F.col("negative_score").desc(), "negative_id")

    def named(c: str):
        return F.when(F.col(c) != int(LAST), F.col(c)).alias(c)
    return (found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= negatives)
            .select("anchor_id", named("positive_id"), "rank", named("negative_id"), "positive_score", "negative_score"))


def op12_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All anchors (ids divisible by 50), their 5 positives and 3 hard negatives for each."""
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP12_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)),
p AS (SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place
      FROM s WHERE same QUALIFY place <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.r = p.r AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
