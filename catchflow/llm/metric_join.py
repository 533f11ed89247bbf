"""Exact range join of embeddings by cosine: pivots, boundary replication, independent cells.

On unit vectors, cosine >= c is distance <= e with ``e = sqrt(2 - 2 c)``. Each label with more than ``CELL``
distinct vectors gets pivots. A vector's home is its nearest pivot's cell. If x lives in cell i and y in cell j
and they are within e, the triangle inequality gives ``d(y, p_i) <= d(y, p_j) + 2 e``, and on the sphere the sharper
``d(y, p_i)^2 - d(y, p_j)^2 <= 2 e d(p_i, p_j)``; y is sent as a guest to every cell for which both hold. A cell then
has all partners of its own vectors and is joined alone: each vector's links are counted in its home only.

Equal vectors are one node with a count. A cell with more than ``CELL`` home vectors is split into blocks; a block
meets all vectors of its cell in a stream, so memory is bounded by a block and nothing is capped. Links leave a
block as a spanning forest, never as all pairs; components are found in Spark.

Pivots are at most ``2 * PIVOTS`` vectors, the only thing that goes to every task.

Results in edge cases: a vector that is null, empty, zero or has null or non-finite components, or whose label is
null, links with nothing and is its own component. Repeated rows are vectors of their own (they link with each
other); vectors of different length never link; a null vec_id counts as a link and has a null component of its own
only if nothing else is in it. No rows give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep_table, partitions, prepare
from .graph import components

CELL = 2048
PIVOTS = 1024
_ROWS = "label long, dim int, cell int, block int, guest int, node long, mult long, vec binary"


def _matrix(vecs: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(vecs), "<f8").reshape(len(vecs), dim)
    return x / np.sqrt((x * x).sum(1))[:, None]


class Cells:
    """Pivots by (label, dim), as unit vectors, and the number of blocks of each cell."""

    def __init__(self, pivots: dict[tuple[int, int], np.ndarray], reach: float):
        self.pivots, self.reach = pivots, reach
        self.apart = {k: np.sqrt(np.maximum(0, 2 - 2 * p @ p.T)) for k, p in pivots.items()}
        self.blocks: dict[tuple[int, int, int], int] = {}

    def assign(self, key: tuple[int, int], unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(home cell of each vector, matrix of the cells it goes to)."""
        p = self.pivots.get(key)
        if p is None:
            return np.zeros(len(unit), np.int64), np.ones((len(unit), 1), bool)
        sq = np.maximum(0, 2 - 2 * unit @ p.T)
        home = sq.argmin(1)
        d, tiny = np.sqrt(sq), 1e-9
        near = d[np.arange(len(unit)), home][:, None]
        goes = (d <= near + 2 * self.reach + tiny) & (sq - near * near <= 2 * self.reach * self.apart[key][home] + tiny)
        goes[np.arange(len(unit)), home] = True
        return home, goes


def _groups(batch: pa.RecordBatch, names: list[str]):
    """Runs of rows with equal ``names``: (key, first row, end row)."""
    if not batch.num_rows:
        return
    cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    at = np.append(np.flatnonzero(new), batch.num_rows)
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        yield tuple(int(c[lo]) for c in cols), lo, hi


def _dealer(cells: Cells, count_only: bool):
    """Vectors to their cells and blocks, or the cells' home counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, dims = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "dim"))
            nodes, mult = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "mult"))
            vecs = batch.column("vec").to_numpy(zero_copy_only=False)
            for key in sorted(set(zip(labels.tolist(), dims.tolist()))):
                rows = np.flatnonzero((labels == key[0]) & (dims == key[1]))
                for at in range(0, len(rows), 4096):
                    mine = rows[at:at + 4096]
                    home, goes = cells.assign(key, _matrix(vecs[mine].tolist(), key[1]))
                    if count_only:
                        n = np.bincount(home)
                        k = np.flatnonzero(n)
                        yield pa.RecordBatch.from_pydict({"label": np.full(len(k), key[0]), "dim": pa.array(np.full(len(k), key[1]), pa.int32()),
                                                          "cell": pa.array(k, pa.int32()), "n": n[k]})
                        continue
                    r, c = np.nonzero(goes)
                    nb = np.array([cells.blocks.get((*key, x), 1) for x in range(goes.shape[1])])[c]
                    own = np.where(c == home[r], nodes[mine][r] % nb, -1)
                    block = np.arange(nb.sum()) - np.repeat(np.cumsum(nb) - nb, nb)
                    r, c, own = np.repeat(r, nb), np.repeat(c, nb), np.repeat(own, nb)
                    n = len(r)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1]), pa.int32()), pa.array(c, pa.int32()),
                         pa.array(block, pa.int32()), pa.array((own != block).astype(np.int32)), pa.array(nodes[mine][r]),
                         pa.array(mult[mine][r]), batch.column("vec").take(pa.array(mine[r]))],
                        names=["label", "dim", "cell", "block", "guest", "node", "mult", "vec"])
    return run


class _Block:
    """The home vectors of one block; takes others in a stream."""

    def __init__(self, limit: float, dim: int):
        self.limit, self.dim, self.parts = limit, dim, []
        self.unit = None

    def add_home(self, nodes, mult, vecs) -> None:
        self.parts.append((nodes, mult, _matrix(vecs, self.dim)))

    def close_home(self) -> None:
        if self.unit is not None:
            return
        self.nodes, self.mult, self.unit = (np.concatenate(x) for x in zip(*self.parts)) if self.parts else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, self.dim)))
        self.links = np.full(len(self.nodes), -1.0)  # a vector is no link of its own
        self.root = np.arange(len(self.nodes))
        for lo in range(0, len(self.nodes), CELL):
            self._meet(self.mult[lo:lo + CELL], self.unit[lo:lo + CELL])

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def _meet(self, mult: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count links with others; (others that link, a home vector that each links with)."""
        near = self.unit @ unit.T >= self.limit
        self.links += near.astype(float) @ mult.astype(float)
        hit = np.flatnonzero(near.any(0))
        first = near[:, hit].argmax(0)
        i, j = np.nonzero(near[:, hit])
        n = max(1, len(self.unit))
        for pair in np.unique(i * n + first[j]).tolist():
            a, b = self._find(pair // n), self._find(pair % n)
            self.root[max(a, b)] = min(a, b)
        return hit, first

    def meet(self, nodes, mult, vecs) -> tuple[np.ndarray, np.ndarray]:
        self.close_home()
        if not len(self.nodes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hit, first = self._meet(mult, _matrix(vecs, self.dim))
        return nodes[hit], self.nodes[first]

    def finish(self) -> pa.RecordBatch:
        self.close_home()
        roots = self.nodes[[self._find(i) for i in range(len(self.nodes))]] if len(self.nodes) else self.nodes
        return _found(self.nodes, roots, self.links.astype(np.int64))


def _found(a, b, links=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                       pa.array(links, pa.int64()) if links is not None else pa.nulls(len(a), pa.int64())],
                                      names=["a", "b", "links"])


def _joiner(limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, None
        for batch in batches:
            nodes, mult = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "mult"))
            vecs = batch.column("vec").to_numpy(zero_copy_only=False)
            for (label, dim, cell, b, guest), lo, hi in _groups(batch, ["label", "dim", "cell", "block", "guest"]):
                if now != (label, dim, cell, b):
                    if block:
                        yield block.finish()
                    now, block = (label, dim, cell, b), _Block(limit, dim)
                for at in range(lo, hi, CELL):
                    s = slice(at, min(hi, at + CELL))
                    if guest:
                        a, to = block.meet(nodes[s], mult[s], vecs[s].tolist())
                        if len(a):
                            yield _found(a, to)
                    else:
                        block.add_home(nodes[s], mult[s], vecs[s].tolist())
        if block:
            yield block.finish()
    return run


def _pack_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays of doubles to bytes, once, before they are dealt out."""
    for b in batches:
        col = b.column("embedding")
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        flat = col.flatten().to_numpy(zero_copy_only=False).astype("<f8")
        size = np.asarray(pc.list_value_length(col)) if b.num_rows else np.zeros(0, int)
        at = np.append(0, np.cumsum(size))
        vecs = pa.array([flat[x:y].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("label"), b.column("dim"), b.column("node"), b.column("mult"), b.column("low"), vecs],
                                         names=["label", "dim", "node", "mult", "low", "vec"])


def _choose(nodes: DataFrame, sizes: list, cell: int, reach: float) -> Cells:
    """Pivots: of each large label, vectors with the smallest hashes among a bounded draw, spread by farthest-first."""
    big = {(r["label"], r["dim"]): r["n"] for r in sizes}
    if not big:
        return Cells({}, reach)
    spark = nodes.sparkSession
    want = spark.createDataFrame([(*k, max(1, n // (4 * -(-n // cell)))) for k, n in big.items()],
                                 "label long, dim int, one_in long")  # about four candidates a pivot
    draw = (nodes.join(F.broadcast(want), ["label", "dim"]).where(F.pmod(F.xxhash64("node"), F.col("one_in")) == 0)
            .select("label", "dim", "node", "vec").collect())
    pivots = {}
    for key, n in big.items():
        rows = sorted(((r["node"], bytes(r["vec"])) for r in draw if (r["label"], r["dim"]) == key))
        if not rows:
            continue
        x = _matrix([v for _, v in rows], key[1])
        pick, far = [0], 2 - 2 * x @ x[0]
        while len(pick) < min(len(rows), -(-n // cell)):
            pick.append(int(far.argmax()))
            far = np.minimum(far, 2 - 2 * x @ x[pick[-1]])
        pivots[key] = x[pick]
    return Cells(pivots, reach)


def link_embeddings(vectors: DataFrame, cosine: float = 0.98, cell: int = CELL, pivots: int = PIVOTS) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) -> vec_id, n_links, component_id, kept; one row a vector."""
    spark = vectors.sparkSession
    prepare(spark)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    good = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0))
    v = v.withColumn("key", F.when(F.coalesce(good, F.lit(False)), F.col("embedding")))
    equal = (v.where("key IS NOT NULL").groupBy("label", "key").agg(F.count("*").alias("mult"), F.min("vec_id").alias("low"))
             .withColumn("node", F.monotonically_increasing_id()))
    equal = keep_table(equal, "vector-classes")
    nodes = keep_table(equal.select("label", F.size("key").cast("int").alias("dim"), "node", "mult", "low", F.col("key").alias("embedding"))
                       .mapInArrow(_pack_vectors, "label long, dim int, node long, mult long, low long, vec binary"), "vector-nodes")
    total = nodes.count()
    spaced = max(cell, -(-total // pivots))  # vectors a pivot; blocks are cut at ``cell`` whatever the table
    many = nodes.groupBy("label", "dim").agg(F.count("*").alias("n")).where(F.col("n") > cell)
    large = many.where(F.col("n") > spaced).collect()  # at most ``pivots`` rows
    reach = math.sqrt(2 - 2 * cosine) + 1e-9
    cells = _choose(nodes, large, spaced, reach)
    slim = nodes.select("label", "dim", "node", "mult", "vec")
    if total > cell:
        homes = (slim.join(many, ["label", "dim"], "left_semi")
                 .mapInArrow(_dealer(cells, True), "label long, dim int, cell int, n long")
                 .groupBy("label", "dim", "cell").agg(F.sum("n").alias("n")).where(F.col("n") > cell).collect())  # a row per cell of several blocks
        cells.blocks = {(r["label"], r["dim"], r["cell"]): -(-r["n"] // cell) for r in homes}
    dealt = (slim.mapInArrow(_dealer(cells, False), _ROWS)
             .repartition(partitions(spark), "label", "dim", "cell", "block")
             .sortWithinPartitions("label", "dim", "cell", "block", "guest", "node"))
    found = keep_table(dealt.mapInArrow(_joiner(cosine), "a long, b long, links long"), "vector-links")
    roots = components(found.select("a", "b"))
    placed = (nodes.select("node", "low", "mult").join(found.where("links IS NOT NULL").select(F.col("a").alias("node"), "links"), "node")
              .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    answer = (placed.join(least, "root").join(equal.select("node", "label", "key"), "node")
              .select(F.col("label").alias("_label"), F.col("key").alias("_key"), "links", F.col("component_id").alias("_comp")))
    out = v.join(answer, (F.col("label") == F.col("_label")) & (F.col("key") == F.col("_key")), "left")
    comp = F.coalesce("_comp", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"),
                      (F.col("vec_id") == comp).alias("kept"))


def op2_pivot_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors compared within their labels at cosine 0.98."""
    return link_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      AND list_cosine_similarity(a.e, b.e) >= 0.98),
r(id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT p.a, r.root FROM r JOIN p ON p.b = r.id WHERE r.root < p.a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a), c AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.root AS component_id, vec_id = c.root AS kept
FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id
"""
