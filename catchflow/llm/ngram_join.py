"""N-gram Jaccard join with signature trees.

A document's set is its distinct ``k``-word shingles (as 64-bit hashes). Equal sets are one node, named by a hash
of the set. Two steps find all links ``100 * both >= percent * union``:

1. *Which sets can meet.* Sizes fall into classes a factor ``100 / percent`` apart, so linked sets are in one class
   or in neighbouring ones. Within a class no more than D shingles differ, so if the shingles are dealt by hash into
   ``D + 1 + spare`` parts, at least ``1 + spare`` parts are equal. A set names itself by the hashes of its parts
   with two or more shingles, one of them rare. If more than ``spare`` parts are not like that, its prefix in that
   class joins them: its ``size - need + 1`` rarest shingles, where ``need`` is the least overlap of any link; the
   prefixes of two linked sets share one. Rarity is the number of documents in a shingle's bin of a table of ``BINS``
   counts over the whole corpus. It depends on the shingle alone, so equal parts are named alike and any two prefixes
   follow one order, which keeps the join exact; and it keeps passages that many documents share out of the names.
   An empty part is never a name. A set too small to link with any other has one
   name, of all its shingles. Linked sets share a name, so they are in one connected group of names. Names travel
   packed, 6 bytes each, and leave a task as spanning forests.
2. *Signature trees.* A group's sets are the leaves of a tree; nodes hold the OR of their leaves' bitmaps and the
   range of their sizes. Two nodes meet only if the sizes allow a link and the common bits, with the slack that
   tokens sharing bits add, reach the overlap that a link needs. What survives down to two leaves is compared
   exactly; leaves already connected are not compared again.

Groups of more than ``GROUP`` sets are dealt into blocks: each block joins alone, then one set of each result meets
the others. What is still outside the group's largest component is dealt into blocks again; every two of these blocks
meet once, and each meets each block of the largest component once, so a task holds two blocks at most.
No partners are capped and no pairs are emitted; links leave as forests.

Results in edge cases: a null, empty or all-white text has no set, links with nothing and is its own component. A
shorter text's whole word sequence is its one shingle. Null ids take part, but a component is named by its smallest
id that isn't null. Repeated rows have equal sets. No rows give no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, batch_blocks, binary_column, blocks, drop_table, keep_table, marks, mix, parted, partitions, prepare, run_hashes, span_hashes, text_bytes, trimmed, words
from .graph import components, forest

GROUP = 2000
FLUSH_NAMES = 250_000
SET_BYTES = 1 << 18  # bytes of texts whose sets are made at a time (more only if one text has more)
BITS = 2048
FANOUT = 8
BIN_BITS = 22
BINS = 1 << BIN_BITS  # counts of shingles, 4 bytes each on the driver, 1 in a task
SLICES = 16
COMMON = 128


# ---------------------------------------------------------------- sets of texts

def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, joined, and the texts' offsets."""
    n = len(offs) - 1
    low = LOWER[buf]
    starts, ends, doc = words(low, offs)
    h = span_hashes(low, starts, ends)
    per = np.bincount(doc, minlength=n)
    runs = run_hashes(h, k)
    same = doc[k - 1:] == doc[:len(doc) - k + 1] if len(doc) >= k else np.zeros(0, bool)
    key, owner = runs[same], doc[:len(same)][same]
    short = np.flatnonzero((per > 0) & (per < k))
    if len(short):  # the whole sequence, its length in the hash
        at = np.cumsum(per) - per
        one = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            live = per[short] > j
            one[live] = mix(one[live] * np.uint64(0x9E3779B97F4A7C15) + h[at[short[live]] + j] + np.uint64(j + 1))
        key, owner = np.concatenate([key, one]), np.concatenate([owner, short])
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    keep = np.ones(len(key), bool)
    keep[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[keep], owner[keep]
    return key, np.searchsorted(owner, np.arange(n + 1))


def set_names(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 63-bit name of each set, the same for equal sets; 0 for empty sets."""
    total = np.zeros(len(key) + 1, np.uint64)
    np.cumsum(mix(key), out=total[1:])
    size = np.diff(at)
    name = mix((total[at[1:]] - total[at[:-1]]) + size.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(1)
    return np.where(size > 0, np.maximum(name, np.uint64(1)), np.uint64(0)).astype(np.int64)


class Parts:
    """How sets of a size are dealt into parts; a function of ``percent`` alone."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lows = [1]  # the smallest size of each class

    def _next(self) -> None:
        self.lows.append(self.lows[-1] * 100 // self.percent + 1)

    def classes(self, size: np.ndarray) -> np.ndarray:
        while self.lows[-1] <= size.max(initial=1):
            self._next()
        return np.searchsorted(np.array(self.lows), size, "right") - 1

    def dealt(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts, spare) of the classes ``c``: pairs whose smaller set is in the class."""
        while len(self.lows) < c.max(initial=0) + 2:
            self._next()
        most = np.array(self.lows[1:])[c] - 1  # the largest smaller set
        other = most * 100 // self.percent  # the largest partner
        both = (self.percent * (most + other) + 99 + self.percent) // (100 + self.percent)  # least overlap
        differ = np.maximum(most + other - 2 * both, 0) + 1
        spare = np.maximum(4, differ // 5)
        return differ + 1 + spare, spare


def part_names(key: np.ndarray, at: np.ndarray, rows: np.ndarray, parts: Parts, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(names, rows): the names of the sets ``rows`` in their own class and as the larger of two in the one below.

    ``common`` ranks the bins of shingles by how often they occur; without it all are alike.
    """
    size = np.diff(at)
    cls = parts.classes(size)
    n = size[rows]
    alone = (100 * n < parts.percent * (n + 1)) & (100 * (n - 1) < parts.percent * n)  # one shingle more or less is too much
    out_name, out_row = [set_names(key, at)[rows[alone]].astype(np.uint64)], [rows[alone]]
    rows = rows[~alone]
    for below in (0, 1):
        mine = rows[cls[rows] >= below]
        if not len(mine):
            continue
        c = cls[mine] - below
        m, spare = parts.dealt(c)
        first = np.cumsum(m) - m
        n = size[mine]
        local = np.repeat(np.arange(len(mine)), n)
        k = key[np.repeat(at[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        slot = first[local] + ((k >> np.uint64(20)) % m[local].astype(np.uint64)).astype(np.int64)
        count = np.bincount(slot, minlength=int(m.sum()))
        order = np.argsort(slot, kind="stable")
        total = np.zeros(len(k) + 1, np.uint64)
        np.cumsum(mix(k[order] ^ np.uint64(0x51ED270B0A1FBA4D)), out=total[1:])
        edge = np.append(0, np.cumsum(count))
        value = total[edge[1:]] - total[edge[:-1]]
        owner = np.repeat(np.arange(len(mine)), m)
        sent = count >= 2
        if common is not None:  # a part of nothing but common shingles would tie together all texts with a passage
            rank = common[(k >> np.uint64(64 - BIN_BITS)).astype(np.int64)]
            sent &= np.bincount(slot[rank < COMMON], minlength=len(count)) > 0
        weak = np.bincount(owner, weights=~sent, minlength=len(mine))
        part = np.arange(len(owner)) - first[owner]
        name = mix(value + mix(part.astype(np.uint64) * np.uint64(1 << 20) + c[owner].astype(np.uint64) + np.uint64(7)))
        out_name.append(name[sent])
        out_row.append(mine[owner[sent]])
        # two linked sets that are both thin in this class share a shingle of their prefixes
        thin = weak > spare
        held = thin[local]
        rare, whose = k[held], local[held]
        if common is not None:
            rare = rare[np.lexsort((rare, rank[held], whose))]
        least = np.maximum(np.array(parts.lows)[c], (parts.percent * n + 99) // 100)  # the smallest partner
        most = n - (parts.percent * (n + least) + 99 + parts.percent) // (100 + parts.percent) + 1
        most = np.where(thin, np.maximum(most, 1), 0)
        from_ = np.cumsum(np.where(thin, n, 0)) - np.where(thin, n, 0)
        pick = np.repeat(from_ - (np.cumsum(most) - most), most) + np.arange(most.sum())
        owner = np.repeat(np.arange(len(mine)), most)
        out_name.append(mix(rare[pick] ^ mix(c[owner].astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D))))
        out_row.append(mine[owner])
    return np.concatenate(out_name), np.concatenate(out_row)


# ---------------------------------------------------------------- forests

def _stars(name: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node with the same name."""
    order = np.lexsort((node, name))
    name, node = name[order], node[order]
    first = np.ones(len(name), bool)
    first[1:] = name[1:] != name[:-1]
    low = node[np.flatnonzero(first)][np.cumsum(first) - 1]
    real = low != node
    return node[real], low[real]


def _namer(k: int, percent: int, routes: int, common: Broadcast):
    """Packed part names, dealt by their hash; equal sets of a block name themselves once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, count = Parts(percent), [], 0

        def flush():
            name, node = (np.concatenate(x) for x in zip(*held))
            route = (name >> np.uint64(33)) % np.uint64(routes)
            order = np.argsort(route, kind="stable")
            name, node, route = name[order], node[order], route[order]
            at = np.searchsorted(route, np.arange(routes + 1).astype(np.uint64))
            out = []
            for r in np.flatnonzero(np.diff(at)).tolist():
                who, idx = np.unique(node[at[r]:at[r + 1]], return_inverse=True)
                out.append((r, who.astype("<i8").tobytes(), name[at[r]:at[r + 1]].astype("<u4").tobytes(), idx.astype("<u4").tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), *[pa.array([x[i] for x in out], pa.binary()) for i in (1, 2, 3)]],
                                              names=["route", "nodes", "names", "at"])

        for _, _, _, buf, offs in batch_blocks(batches, size=SET_BYTES):
            key, at = shingle_sets(buf, offs, k)
            node = set_names(key, at)
            _, rows = np.unique(node, return_index=True)
            name, row = part_names(key, at, rows[node[rows] != 0], parts, common.value)
            held.append((name, node[row]))
            count += len(name)
            if count >= FLUSH_NAMES:
                yield flush()
                held, count = [], 0
        if count:
            yield flush()
    return run


def _gather(routes: int):
    """All names of some routes -> a forest over the sets that share one, packed by the sets' own routes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, nodes = [], []
        for b in batches:
            for i in range(b.num_rows):
                who = np.frombuffer(b.column("nodes")[i].as_buffer(), "<i8")
                route = np.uint64(b.column("route")[i].as_py()) << np.uint64(32)
                names.append(np.frombuffer(b.column("names")[i].as_buffer(), "<u4").astype(np.uint64) | route)
                nodes.append(who[np.frombuffer(b.column("at")[i].as_buffer(), "<u4")])
        if not names:
            return
        a, b = forest(*_stars(np.concatenate(names), np.concatenate(nodes)))
        route = (mix(a.astype(np.uint64)) % np.uint64(routes)).astype(np.int64)
        order = np.argsort(route, kind="stable")
        a, b, route = a[order], b[order], route[order]
        at = np.searchsorted(route, np.arange(routes + 1))
        some = np.flatnonzero(np.diff(at)).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[pa.array([x[at[r]:at[r + 1]].astype("<i8").tobytes() for r in some], pa.binary()) for x in (a, b)]],
                                         names=["route", "a", "b"])
    return run


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = [], []
    for batch in batches:
        for i in range(batch.num_rows):
            a.append(np.frombuffer(batch.column("a")[i].as_buffer(), "<i8"))
            b.append(np.frombuffer(batch.column("b")[i].as_buffer(), "<i8"))
    if a:
        x, y = forest(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])


# ---------------------------------------------------------------- the signature tree

class SignatureTree:
    """Sets in leaf order; level 0 has a row for each leaf, each higher level one for ``FANOUT`` rows below."""

    def __init__(self, sets: list[np.ndarray]):
        low = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
        size = np.array([len(s) for s in sets], np.int64)
        self.order = np.lexsort((size, low))  # alike sets mostly have the same smallest hash and stand side by side
        self.sets = [sets[i] for i in self.order]
        size = size[self.order]
        bits = np.zeros((len(sets), BITS // 64), np.uint64)
        for i, s in enumerate(self.sets):
            at = ((s >> np.uint64(13)) % np.uint64(BITS)).astype(np.int64)
            np.bitwise_or.at(bits[i], at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        slack = size - np.bitwise_count(bits).sum(1)
        self.levels = [(bits, size, size, slack)]
        while len(self.levels[-1][0]) > 1:
            bits, lo, hi, slack = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                                np.maximum.reduceat(slack, at)))

    def may_link(self, level: int, p: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
        """Whether any leaf under p can link with any under q: sizes, then common bits against the overlap needed."""
        bits, lo, hi, slack = self.levels[level]
        ok = (100 * hi[p] >= percent * lo[q]) & (100 * hi[q] >= percent * lo[p])
        need = (percent * (lo[p] + lo[q]) + 99 + percent) // (100 + percent)
        most = np.minimum(hi[p], hi[q])
        ok &= most >= need
        k = np.flatnonzero(ok)
        for at in range(0, len(k), 1 << 14):
            i = k[at:at + (1 << 14)]
            common = np.bitwise_count(bits[p[i]] & bits[q[i]]).sum(1, dtype=np.int64)
            ok[i] = common + np.minimum(slack[p[i]], slack[q[i]]) >= need[i]
        return ok


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact rule on two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def join_group(sets: list[np.ndarray], percent: int, known: np.ndarray | None = None, side: np.ndarray | None = None) -> np.ndarray:
    """Component numbers of a group's sets; ``known`` are components found before (equal numbers are connected).

    Sets of the same ``side`` have met elsewhere and aren't compared; those of side 0 meet all.
    """
    n = len(sets)
    tree = SignatureTree(sets)
    beside = np.zeros(n, np.int64) if side is None else side[tree.order]
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def flat() -> np.ndarray:
        while True:
            hop = root[root]
            if (hop == root).all():
                return root
            root[:] = hop

    def compare(p: np.ndarray, q: np.ndarray) -> None:
        for at in range(0, len(p), 512):
            r = flat()
            i, j = p[at:at + 512], q[at:at + 512]
            open_ = (r[i] != r[j]) & ((beside[i] != beside[j]) | (beside[i] == 0))
            for x, y in zip(i[open_].tolist(), j[open_].tolist()):
                fx, fy = find(x), find(y)
                if fx != fy and linked(tree.sets[x], tree.sets[y], percent):
                    root[max(fx, fy)] = min(fx, fy)

    if known is not None:
        k = known[tree.order]
        _, first, inverse = np.unique(k, return_index=True, return_inverse=True)
        root[:] = first[inverse]
    left = np.arange(n - 1)
    compare(left, left + 1)
    level = len(tree.levels) - 1
    pairs = [(level, np.zeros(1, np.int64), np.zeros(1, np.int64))] if n > 1 else []
    while pairs:  # depth first, so that few node pairs wait at a time
        level, p, q = pairs.pop()
        r, width = flat(), FANOUT ** level
        at = np.arange(0, n, width)
        lo, hi = np.minimum.reduceat(r, at), np.maximum.reduceat(r, at)
        done = (lo[p] == hi[p]) & (lo[q] == hi[q]) & (lo[p] == lo[q])  # all connected already
        low, high = np.minimum.reduceat(beside, at), np.maximum.reduceat(beside, at)
        done |= (low[p] == high[q]) & (low[q] == high[p]) & (low[p] == low[q]) & (low[p] > 0)  # all of one side
        p, q = p[~done], q[~done]
        keep = tree.may_link(level, p, q, percent)
        p, q = p[keep], q[keep]
        if not level:
            compare(p[p < q], q[p < q])
            continue
        step, below = 256, len(tree.levels[level - 1][0])
        i, j = np.divmod(np.arange(FANOUT * FANOUT), FANOUT)
        for at in reversed(range(0, len(p), step)):
            x = (p[at:at + step, None] * FANOUT + i).ravel()
            y = (q[at:at + step, None] * FANOUT + j).ravel()
            real = (x < below) & (y < below) & (x <= y)
            pairs.append((level - 1, x[real], y[real]))
    out = np.empty(n, np.int64)
    out[tree.order] = tree.order[flat()]
    return out


def _group_joiner(k: int, percent: int):
    """Rows (grp, node, known, side, text) sorted by grp -> a forest of each group's links."""
    def close(nodes, known, side, texts):
        buf, offs = text_bytes(pa.array(texts, pa.string()))
        sets = []
        for _, _, b, o in blocks(buf, offs):
            key, at = shingle_sets(b, o, k)
            sets += [key[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
        nodes, known, side = np.array(nodes), np.array(known), np.array(side)
        nodes, first = np.unique(nodes, return_index=True)
        root = join_group([sets[i] for i in first], percent, known[first], side[first])
        new = root != np.arange(len(root))
        return pa.RecordBatch.from_arrays([pa.array(nodes[new]), pa.array(nodes[root[new]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [], [])
        for b in batches:
            for grp, *row in zip(*[b.column(c).to_pylist() for c in ("grp", "node", "known", "side", "text")]):
                if grp != now:
                    if len(held[0]) > 1:
                        yield close(*held)
                    now, held = grp, ([], [], [], [])
                for x, y in zip(held, row):
                    x.append(y)
        if len(held[0]) > 1:
            yield close(*held)
    return run


def _set_rows(k: int):
    """A row for each document, and at a task's end ``SLICES`` rows with its counts of shingles by bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BINS, np.uint32)
        for batch, lo, hi, buf, offs in batch_blocks(batches, size=SET_BYTES):
            key, at = shingle_sets(buf, offs, k)
            np.add.at(counts, (key >> np.uint64(64 - BIN_BITS)).astype(np.int64), np.uint32(1))
            part, n = batch.slice(lo, hi - lo), hi - lo
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(at)), pa.array(set_names(key, at)),
                                              pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=_SET_NAMES)
        if counts.any():
            packed = [zlib.compress(c.view(np.uint8).reshape(-1, 4).T.tobytes(), 1) for c in counts.reshape(SLICES, -1)]  # byte planes: most are zeros
            yield pa.RecordBatch.from_arrays([*[pa.nulls(SLICES, pa.int64())] * 4, pa.array(range(SLICES), pa.int32()), binary_column(packed)], names=_SET_NAMES)
    return run


_SET_NAMES = ["doc_id", "text_hash", "n_shingles", "node", "slice", "counts"]


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for s, packed in zip(b.column("slice").to_pylist(), b.column("counts")):
            c = np.frombuffer(zlib.decompress(packed.as_buffer()), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
            total[s] = total.get(s, np.zeros(len(c), np.uint64)) + c
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), binary_column([common_ranks(c).tobytes() for c in total.values()])],
                                         names=["slice", "ranks"])


def common_ranks(counts: np.ndarray) -> np.ndarray:
    """One byte for each bin, never falling with its count; ``COMMON`` and more where it's far above the bins' mean."""
    steps = np.floor(4 * np.log2(1.0 + counts)).clip(0, COMMON - 1)
    return (steps + np.where(counts > 50 + 2 * counts.mean(), COMMON, 0)).astype(np.uint8)


def shingle_ranks(rows: DataFrame) -> Broadcast:
    """The bins' ranks over all of ``rows`` (see ``_set_rows``); ``BINS`` bytes, whatever the table."""
    spark = rows.sparkSession
    found = (rows.where("slice IS NOT NULL").select("slice", "counts").repartition(SLICES, "slice")
             .mapInArrow(trimmed(_sum_counts), "slice int, ranks binary").collect())
    ranks = np.zeros((SLICES, BINS // SLICES), np.uint8)
    for r in found:
        ranks[r["slice"]] = np.frombuffer(r["ranks"], np.uint8)
    return spark.sparkContext.broadcast(ranks.ravel())


def _joined(rows: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """``rows`` (grp, node, known, side, text): the links of every group, as a written forest."""
    dealt = rows.repartition(partitions(rows.sparkSession), "grp").sortWithinPartitions("grp")
    return keep_table(dealt.mapInArrow(trimmed(_group_joiner(k, percent)), "a long, b long"), name)


def outside_pairs(state: DataFrame, group: int) -> DataFrame:
    """``state`` (root, node, comp, text) -> rows of ``_joined``: pairs of blocks of about ``group`` sets.

    What is outside a root's largest component meets everything once; the largest component's own sets don't meet.
    """
    per = state.groupBy("root", "comp").agg(F.count("*").alias("n"))
    sizes = (per.groupBy("root").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.max("n").alias("in_main"), F.sum("n").alias("n"))
             .select("root", "main", F.ceil(F.col("in_main") / group).alias("homes"), F.ceil((F.col("n") - F.col("in_main")) / group).alias("outs")))
    s = state.join(sizes, "root").where("outs > 0")

    def block(seed: int, n: str):
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("long")

    def spread(rows: DataFrame, n: str) -> DataFrame:
        return rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), (F.col(n) - 1).cast("long"))))

    def dealt(rows: DataFrame, home: bool, i, j, side) -> DataFrame:
        grp = F.struct("root", F.lit(home).alias("home"), i.alias("i"), j.alias("j"))
        return rows.select(grp.alias("grp"), "node", F.col("comp").alias("known"), side.cast("long").alias("side"), "text")

    mine, other = F.col("mine"), F.col("other")
    out = s.where("comp <> main").withColumn("mine", block(2, "outs"))
    each_other = dealt(spread(out, "outs"), False, F.least(mine, other), F.greatest(mine, other),
                       F.when(mine == other, 0).when(mine < other, 1).otherwise(2))
    outs = dealt(spread(out, "homes"), True, mine, other, F.lit(1))
    homes = dealt(spread(s.where("comp = main").withColumn("mine", block(3, "homes")), "outs"), True, other, mine, F.lit(2))
    return each_other.union(outs).union(homes)


def candidate_groups(docs: DataFrame, k: int, percent: int, common: Broadcast) -> DataFrame:
    """(node, root): sets that can be linked are in one group."""
    n = partitions(docs.sparkSession)
    names = docs.select("text").mapInArrow(trimmed(_namer(k, percent, n, common)), "route int, nodes binary, names binary, at binary")
    packed = names.repartition(n, "route").mapInArrow(trimmed(_gather(n)), "route int, a binary, b binary")
    return components(packed.repartition(n, "route").mapInArrow(trimmed(_thin), "a long, b long"))


def link_sets(docs: DataFrame, k: int = 4, percent: int = 85, group: int = GROUP) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, node (its set's name, 0 for none), component_id; a row a document."""
    prepare(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash"))
    made = keep_table(d.mapInArrow(trimmed(_set_rows(k)), "doc_id long, text_hash long, n_shingles long, node long, slice int, counts binary"), "shingle-sets")
    rows = made.where("slice IS NULL").drop("slice", "counts")
    near = candidate_groups(d, k, percent, shingle_ranks(made))
    # one text for each set that is in a group; the other texts stay where they are
    texts = keep_table(rows.where("node <> 0").groupBy("node").agg(F.min("text_hash").alias("text_hash")).join(near, "node"), "group-sets")
    _, wanted = parted(d.select("text_hash", "text"), "text_hash", marks(texts, "text_hash"))
    one = wanted.groupBy("text_hash").agg(F.any_value("text").alias("text"))
    size = near.groupBy("root").agg(F.count("*").alias("size"))
    member = keep_table(one.join(texts, "text_hash").join(size, "root").select("root", "node", "size", "text"), "group-texts")

    blocks_ = F.ceil(F.col("size") / group)
    block = F.when(F.col("size") > group, F.pmod(F.xxhash64("node"), blocks_)).otherwise(F.lit(0))
    own, met = F.struct("root", block.cast("long").alias("block")), F.lit(0).cast("long")
    links = _joined(member.select(own.alias("grp"), "node", F.col("node").alias("known"), met.alias("side"), "text"), k, percent, "links-blocks")
    big = member.where(F.col("size") > group)
    if size.where(F.col("size") > group).limit(1).count():
        roots = components(links)
        state = big.join(roots.withColumnRenamed("root", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        # one set of each block's components meets those of the other blocks
        heads = state.where("node = comp")
        count = heads.groupBy("root").agg(F.count("*").alias("heads"))
        shard = F.pmod(F.xxhash64(F.col("node"), F.lit(1)), F.ceil(F.col("heads") / group)).cast("long")
        links = keep_table(links.union(_joined(heads.join(count, "root").select(F.struct("root", shard.alias("block")).alias("grp"), "node", F.col("node").alias("known"), met.alias("side"), "text"), k, percent, "links-heads")), "links")
        roots = components(links)
        state = keep_table(big.join(roots.withColumnRenamed("root", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node")), "group-state")
        links = links.union(_joined(outside_pairs(state, group), k, percent, "links-outside"))
        drop_table(state)
    drop_table(member)
    roots = components(links)
    placed = rows.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node"))
    least = placed.where("node <> 0").groupBy("comp").agg(F.min("doc_id").alias("low"))
    out = placed.join(least, "comp", "left")
    return out.select("doc_id", "n_shingles", "node", F.when(F.col("node") == 0, F.col("doc_id")).otherwise(F.coalesce("low", "doc_id")).alias("component_id"))


def op7_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents joined on 4-word shingles at 85 per cent."""
    return link_sets(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("node")


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, hash(unnest(g)) AS h FROM s),
m AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM m JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n_shingles + y.n_shingles - common)),
p AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT p.a, r.root FROM r JOIN p ON p.b = r.id WHERE r.root < p.a)
SELECT n.doc_id, n_shingles, c.root AS component_id FROM n JOIN (SELECT id, min(root) AS root FROM r GROUP BY id) c ON c.id = n.doc_id
"""
