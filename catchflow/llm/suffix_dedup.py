"""Removal of repeated byte strings by suffix order and longest-previous-factor arrays.

A byte goes if a string of ``length`` bytes covers it that also starts earlier in the corpus (smaller doc_id, or the
same document and an earlier start). What repeats is judged on the input.

One suffix array of the whole corpus would be one task's work, so suffixes are first dealt out:

1. *Equal texts* are one text with many owners; the smallest doc_id owns it. Later copies are that text again.
2. *Anchors.* Of the ``GRAM``-byte grams in a ``length``-byte string the one with the smallest hash (leftmost at a
   tie) is its anchor; equal strings have equal anchors at equal offsets. Consecutive starts with one anchor are a
   run, about ``length / 3`` starts. Only runs whose anchor occurs twice or more in the corpus can repeat; anchors
   are counted by hash, four bytes each.
3. *Suffix order.* Runs with the same anchor meet in one task with their bytes. Their suffixes are sorted by prefix
   doubling (8, 16, 32, 64, then ``length`` bytes). In suffix order, the previous and the next smaller position with
   a common prefix of ``length`` or more are the nearest earlier matches; a start that has one is a later copy.
   Each task works through its anchors in batches, so memory follows the largest anchor, and runs of one chunk with
   equal bytes travel once.

Results in edge cases: a null or empty text has no bytes and no spans; texts shorter than ``length`` lose nothing;
documents with the same id are ordered by a hash of their text; of repeated rows (same id and text) one is first;
null ids come first. No rows give no rows; other columns go along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import batch_blocks, binary_rows, blocks, drop_table, keep_table, mix, partitions, prepare, span_hashes, text_bytes, trimmed, trimmed_groups

LENGTH = 100
GRAM = 32
SORT_BYTES = 1 << 18  # bytes whose suffixes are sorted at a time (more only if one anchor has more)
ANCHOR_BYTES = 1 << 18  # texts' bytes that are searched for anchors at a time (more only if one text has more)
SPANS = 1 << 18  # spans that leave a task at a time


# ---------------------------------------------------------------- anchors

def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ``GRAM`` bytes from each position (fewer positions than bytes)."""
    h, step, power = buf.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while step < GRAM:
        h = h[:-step] * np.uint64(power) + h[step:]
        power, step = power * power % (1 << 64), step * 2
    return mix(h)


def anchor_runs(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, end start, text, anchor hash) of the runs of starts that share an anchor."""
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none, none, none, np.zeros(0, np.uint64)
    h = gram_hashes(buf)
    low = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)  # leftmost of the smallest
    wide, span = length - GRAM + 1, 1
    while 2 * span <= wide:
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    if span < wide:
        low = np.minimum(low[:span - wide], low[wide - span:])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # the anchor of each start
    room = np.maximum(np.diff(offs) - length + 1, 0)
    text = np.repeat(np.arange(len(room)), room)
    start = np.arange(len(text)) - np.repeat(np.cumsum(room) - room - offs[:-1], room)
    if not len(start):
        return none, none, none, np.zeros(0, np.uint64)
    mine = at[start]
    new = np.ones(len(start), bool)
    new[1:] = (mine[1:] != mine[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return start[first], start[last] + 1, text[first], h[mine[first]]


# ---------------------------------------------------------------- suffix order

def _ranks(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    step = np.zeros(len(key), np.int64)
    step[1:] = ordered[1:] != ordered[:-1]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(step)
    return out


def suffix_ranks(buf: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Ranks of the suffixes at ``starts`` by their first ``length`` (8 or more) bytes; equal strings have equal ranks.

    Bytes past the end count as smaller than any other only through the padding zeros, so ``starts`` must have
    ``length`` bytes before the end.
    """
    n = len(buf)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = buf
    key = wide[:n].copy()
    for j in range(1, 8):
        key = (key << np.uint64(8)) | wide[j:n + j]
    rank, have = _ranks(key), 8
    while 2 * have <= length:
        rank, have = _ranks(_pairs(rank, rank, have)), 2 * have
    if have < length:
        return _ranks((rank[starts] << 32) | rank[starts + length - have])
    return rank[starts]


def _pairs(a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    later = np.zeros(len(a), np.int64)
    later[:-step] = b[step:] + 1
    return (a << 32) | later


def smaller_neighbours(place: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Previous and next smaller value of ``place`` (indices, -1 for none), not crossing where ``joined`` is false.

    ``joined[i]`` says whether entry i and entry i - 1 belong together. Pointers jump over larger entries.
    """
    n = len(place)
    out = []
    for back in (True, False):
        p = place if back else place[::-1]
        tie = joined if back else np.append(False, joined[1:][::-1])
        ptr = np.where(tie, np.arange(n) - 1, -1)
        todo = np.flatnonzero(ptr >= 0)
        while len(todo):
            todo = todo[p[ptr[todo]] > p[todo]]
            ptr[todo] = ptr[ptr[todo]]
            todo = todo[ptr[todo] >= 0]
        out.append(ptr if back else np.where(ptr[::-1] >= 0, n - 1 - ptr[::-1], -1))
    return out[0], out[1]


def later_copies(buf: np.ndarray, starts: np.ndarray, place: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of ``starts`` have an earlier (smaller ``place``) start with the same ``length`` bytes."""
    rank = suffix_ranks(buf, starts, length)
    order = np.argsort(rank, kind="stable")  # the suffix array of the starts
    joined = np.zeros(len(order), bool)
    joined[1:] = rank[order][1:] == rank[order][:-1]  # common prefix of ``length`` or more with the one before
    before, after = smaller_neighbours(place[order], joined)
    out = np.zeros(len(starts), bool)
    out[order] = (before >= 0) | (after >= 0)
    return out


# ---------------------------------------------------------------- Spark steps

def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop repeats of a text that this task has sent (its hash says so)."""
    seen: set[str] = set()
    for b in batches:
        keep = []
        for i, m in enumerate(b.column("md5").to_pylist()):
            if m not in seen:
                seen.add(m)
                keep.append(i)
        if keep:
            yield b.take(pa.array(keep))


def _texts(rows) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct texts of a chunk in order of their hashes: (hashes, bytes, offsets)."""
    md5 = rows.column("md5").to_pylist()
    order, last = [], None
    for i in sorted(range(len(md5)), key=md5.__getitem__):
        if md5[i] != last:
            order.append(i)
            last = md5[i]
    col = rows.column("text").take(pa.array(order, pa.int64()))
    buf, offs = text_bytes(col)
    return [md5[i] for i in order], buf, offs


def _anchor_lists(routes: int, length: int):
    """Distinct anchors of each chunk, packed: 31 bits of hash and one that says it occurs twice here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        seen: set[str] = set()
        for b in batches:
            keep = []
            for i, m in enumerate(b.column("md5").to_pylist()):
                if m not in seen:
                    seen.add(m)
                    keep.append(i)
            part = b.take(pa.array(keep, pa.int64()))
            chunk = part.column("chunk").to_numpy(zero_copy_only=False)
            for _, lo, _, buf, offs in batch_blocks([part], size=ANCHOR_BYTES):
                _, _, text, h = anchor_runs(buf, offs, length)
                for c in np.unique(chunk[lo:lo + len(offs) - 1]).tolist():
                    held.setdefault(c, []).append(h[(chunk[lo:lo + len(offs) - 1] == c)[text]])
        for c, parts in held.items():
            h, count = np.unique(np.concatenate(parts), return_counts=True)
            value = ((h & np.uint64(0x7FFFFFFF)) << np.uint64(1)) | (count > 1).astype(np.uint64)
            route = (h >> np.uint64(31)) % np.uint64(routes)
            order = np.argsort(route, kind="stable")
            at = np.searchsorted(route[order], np.arange(routes + 1).astype(np.uint64))
            some = np.flatnonzero(np.diff(at)).tolist()
            data = value[order].astype("<u4")
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([c] * len(some), pa.int32()),
                                              pa.array([data[at[r]:at[r + 1]].tobytes() for r in some], pa.binary())],
                                             names=["route", "chunk", "data"])
    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of some routes -> for each chunk, those that the corpus has twice or more."""
    keys, owner, rows = [], [], []
    for b in batches:
        for r, c, data in zip(b.column("route").to_pylist(), b.column("chunk").to_pylist(), b.column("data").to_pylist()):
            v = np.frombuffer(data, "<u4")
            keys.append(v.astype(np.uint64) | np.uint64(r << 32))
            owner.append(np.full(len(v), len(rows)))
            rows.append((r, c))
    if not rows:
        return
    key, owner = np.concatenate(keys), np.concatenate(owner)
    anchor = key >> np.uint64(1)
    order = np.argsort(anchor, kind="stable")
    a = anchor[order]
    same = a[1:] == a[:-1]
    twice = (key[order] & np.uint64(1)) == 1
    twice[1:] |= same
    twice[:-1] |= same
    some = order[twice]
    some = some[np.argsort(owner[some], kind="stable")]
    at = np.searchsorted(owner[some], np.arange(len(rows) + 1))
    data = ((key[some] & np.uint64(0xFFFFFFFF)) >> np.uint64(1)).astype("<u4")
    full = np.flatnonzero(np.diff(at)).tolist()
    yield pa.RecordBatch.from_arrays([pa.array([rows[i][1] for i in full], pa.int32()), pa.array([1] * len(full), pa.int32()), pa.array([rows[i][0] for i in full], pa.int64()),
                                      pa.array([data[at[i]:at[i + 1]].tobytes() for i in full], pa.binary())], names=["chunk", "kind", "number", "data"])


_RUNS = [("anchor", "<u8"), ("order", "<i8"), ("tie", "<i8"), ("text", "<u4"), ("start", "<i8"), ("starts", "<u4")]


def _runs_of(routes: int, length: int):
    """A chunk's texts and repeated anchors -> its runs with bytes, packed for the anchors' routes."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["route", "kind", "chunk", "data", "bytes"]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        none = pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        if not left.num_rows or not right.num_rows:
            return none
        chunk = left.column("chunk")[0].as_py()
        kind = right.column("kind").to_pylist()
        number, data = right.column("number").to_pylist(), right.column("data").to_pylist()
        lists = [np.frombuffer(d, "<u4").astype(np.uint64) | np.uint64(n << 32) for k, n, d in zip(kind, number, data) if k == 1]
        if not lists:
            return none
        wanted = np.unique(np.concatenate(lists))
        owner = {d.decode(): n for k, n, d in zip(kind, number, data) if k == 0}
        md5, buf, offs = _texts(left)
        order = np.array([owner[m] for m in md5], np.int64)
        tie = np.array([int(m[:15], 16) for m in md5], np.int64)
        rows, begins, hashes = [], [], []
        for lo, _, b, o in blocks(buf, offs, ANCHOR_BYTES):
            first, end, text, h = anchor_runs(b, o, length)
            code = (((h >> np.uint64(31)) % np.uint64(routes)) << np.uint64(32)) | (h & np.uint64(0x7FFFFFFF))
            at = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)
            pick = np.flatnonzero(wanted[at] == code)
            if not len(pick):
                continue
            first, end, text, h = first[pick], end[pick], text[pick], h[pick]
            r = np.zeros(len(pick), np.dtype(_RUNS))
            r["anchor"], r["order"], r["tie"], r["text"] = h, order[lo + text], tie[lo + text], lo + text
            r["start"], r["starts"] = first - o[text], end - first
            rows.append(r)
            begins.append(offs[lo] + first)
            hashes.append(span_hashes(b, first, end + length - 1))
        if not rows:
            return none
        r, begin, body = np.concatenate(rows), np.concatenate(begins), np.concatenate(hashes)
        size = r["starts"].astype(np.int64) + length - 1
        # equal runs of this chunk: the first travels, the others are later copies as a whole
        rank = np.lexsort((r["start"], r["tie"], r["order"], size, body, r["anchor"]))
        again = np.zeros(len(r), bool)
        x, y = rank[1:], rank[:-1]
        again[x] = (r["anchor"][x] == r["anchor"][y]) & (body[x] == body[y]) & (size[x] == size[y])
        out = [none]
        gone = np.flatnonzero(again)
        if len(gone):
            spans = np.stack([r["text"][gone].astype(np.int64), r["start"][gone], r["start"][gone] + r["starts"][gone].astype(np.int64) + length - 1], 1)
            cols = [[chunk % routes], [1], [chunk], [spans.astype("<i8").tobytes()], [b""]]
            out.append(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names))
        left_ = np.flatnonzero(~again)
        route = ((r["anchor"][left_] >> np.uint64(31)) % np.uint64(routes)).astype(np.int64)
        left_, route = left_[np.argsort(route, kind="stable")], np.sort(route, kind="stable")
        cut = np.append(np.flatnonzero(np.append(True, route[1:] != route[:-1])), len(route))
        r, begin, size = r[left_], begin[left_], size[left_]
        at = np.append(0, np.cumsum(size))
        data = np.empty(at[-1], np.uint8)
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
            pos = np.repeat(begin[a:z] - at[a:z], size[a:z]) + np.arange(at[a], at[z])
            data[at[a]:at[z]] = buf[pos]
        some = len(cut) - 1
        out.append(pa.Table.from_arrays([pa.array(route[cut[:-1]], pa.int32()), pa.array([0] * some, pa.int32()), pa.array([chunk] * some, pa.int32()),
                                         binary_rows(r, cut), binary_rows(data, at[cut])], names=names))
        return pa.concat_tables(out)
    return run


def _suffix_task(length: int):
    """Runs of some routes -> the byte ranges that are later copies, for each chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, bodies, chunks = [], [], []
        for b in batches:
            data, offs = text_bytes(b.column("data"))
            for i, (kind, c) in enumerate(zip(b.column("kind").to_pylist(), b.column("chunk").to_pylist())):
                part = data[offs[i]:offs[i + 1]]
                if kind == 1:
                    yield _spans([c], [part.tobytes()])
                    continue
                runs.append(np.frombuffer(part.tobytes(), np.dtype(_RUNS)))
                chunks.append(np.full(len(runs[-1]), c, np.int32))
            bodies.append(text_bytes(b.column("bytes"))[0])  # empty where kind is 1
        if not runs:
            return
        r, chunk = np.concatenate(runs), np.concatenate(chunks)
        body = bodies[0] if len(bodies) == 1 else np.concatenate(bodies)
        runs = chunks = bodies = b = data = part = None
        size = r["starts"].astype(np.int64) + length - 1
        at = np.cumsum(size) - size
        order = np.argsort(r["anchor"], kind="stable")
        anchor = r["anchor"][order]
        group = np.cumsum(np.append(False, anchor[1:] != anchor[:-1]))
        alone = np.bincount(group)[group] < 2
        order, group = order[~alone], group[~alone]
        total = np.cumsum(size[order])
        found, n_found, lo = [], 0, 0
        while lo < len(order):
            hi = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + SORT_BYTES, "right"))
            hi = max(hi, lo + 1)
            if hi < len(order):  # whole anchors only
                back = int(np.searchsorted(group, group[hi]))
                hi = back if back > lo else int(np.searchsorted(group, group[lo], "right"))
            k = order[lo:hi]
            n, s = size[k], r["starts"][k].astype(np.int64)
            text = body[np.repeat(at[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            owner = np.repeat(np.arange(len(k)), s)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(s) - s, s)
            starts = (np.cumsum(n) - n)[owner] + inner
            by = np.lexsort((r["start"][k][owner] + inner, r["tie"][k][owner], r["order"][k][owner]))
            place = np.empty(len(by), np.int64)
            place[by] = np.arange(len(by))
            copy = later_copies(text, starts, place, length)
            edge = np.zeros(len(copy) + 1, bool)  # maximal runs of copied starts within a run
            edge[:-1] = copy
            head = copy & np.append(True, ~copy[:-1] | (owner[1:] != owner[:-1]))
            tail = copy & np.append(~copy[1:] | (owner[1:] != owner[:-1]), True)
            a, z = np.flatnonzero(head), np.flatnonzero(tail)
            if len(a):
                base = r["start"][k]
                spans = np.stack([r["text"][k][owner[a]].astype(np.int64), base[owner[a]] + inner[a], base[owner[a]] + inner[z] + length], 1)
                found.append((chunk[k][owner[a]], spans))
                n_found += len(spans)
            text = owner = inner = starts = by = place = copy = edge = head = tail = None  # not beside those of the next anchors
            lo = hi
            if found and (n_found >= SPANS or lo >= len(order)):
                c, spans = (np.concatenate(x) for x in zip(*found))
                found, n_found = [], 0
                o = np.argsort(c, kind="stable")
                c, spans = c[o], spans[o].astype("<i8")
                cut = np.append(np.flatnonzero(np.append(True, c[1:] != c[:-1])), len(c))
                yield _spans([int(c[i]) for i in cut[:-1]], [spans[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])])
    return run


def _spans(chunks: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(data, pa.binary())], names=["chunk", "data"])


def _cleaner(with_text: bool, as_text: bool, beside: list[str] | None = None):
    """A chunk's texts and its spans -> what is left of each text, with the columns ``beside`` of the text's row in ``right``."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        cols: list[list] = [[], [], [], [], []]
        place: list[int] = []
        if beside is not None:
            named = right.column("md5").is_valid()
            rows, right = right.filter(named), right.filter(pc.invert(named))
            at_row = {m: i for i, m in enumerate(rows.column("md5").to_pylist())}
        if left.num_rows:
            md5, buf, offs = _texts(left)
            parts = [np.frombuffer(d, "<i8").reshape(-1, 3) for d in right.column("data").to_pylist()] if right.num_rows else []
            spans = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
            spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
            at = np.searchsorted(spans[:, 0], np.arange(len(md5) + 1))
            for i, m in enumerate(md5):
                data = buf[offs[i]:offs[i + 1]]
                n_removed = n_spans = 0
                if at[i] < at[i + 1]:
                    mark = np.zeros(len(data) + 1, np.int64)
                    np.add.at(mark, spans[at[i]:at[i + 1], 1], 1)
                    np.add.at(mark, spans[at[i]:at[i + 1], 2], -1)
                    gone = np.cumsum(mark[:-1]) > 0
                    n_removed = int(gone.sum())
                    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    data = data[~gone]
                raw = data.tobytes()
                body = (raw.decode("utf-8", "ignore") if as_text else raw) if with_text else None
                for col, v in zip(cols, (m, n_removed, n_spans, hashlib.sha256(raw).hexdigest(), body)):
                    col.append(v)
                if beside is not None:
                    place.append(at_row[m])
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string() if as_text else pa.binary()]
        names = ["md5", "r_removed", "r_spans", "r_sha256", "r_kept"]
        n = 5 if with_text else 4
        out = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols[:n], types[:n])], names=names[:n])
        if beside is not None:
            own = rows.select(beside).take(pa.array(place, pa.int64()))
            for c in beside:
                out = out.append_column(c, own.column(c))
        return out
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False, as_text: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> its columns without text, n_bytes, n_removed, n_spans, kept_sha256 [, kept].

    ``kept`` is binary: the remaining bytes, which can begin or end within a character; with ``as_text`` it is a
    string without the parts of such characters. Input columns of these names are replaced.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    spark = docs.sparkSession
    prepare(spark)
    n = partitions(spark)
    rest = [c for c in docs.columns if c not in ("text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")]
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = keep_table(docs.select(*[F.col(c).alias(f"c_{i}") for i, c in enumerate(rest)], F.col("doc_id").cast("long").alias("id"), F.md5(t).alias("md5"),
                                  F.octet_length(t).cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row")), "dedup-rows")
    key = F.struct(F.col("id").isNotNull(), "id", "row")
    who = slim.groupBy("md5").agg(F.min(key).alias("o")).select(F.col("md5").alias("m"), F.col("o.row").alias("first"))
    j = keep_table(slim.join(who, F.col("md5") == F.col("m")).drop("m"), "dedup-owners")
    drop_table(slim)
    long_, first = F.col("n_bytes") >= length, F.col("row") == F.col("first")
    chunk = F.pmod(F.xxhash64("md5"), F.lit(n)).cast("int").alias("chunk")
    texts = (docs.select(F.md5(t).alias("md5"), t.alias("text")).where(F.octet_length("text") >= length)
             .mapInArrow(trimmed(_once), "md5 string, text string").select(chunk, "md5", "text").repartition(n, "chunk"))
    anchors = texts.mapInArrow(trimmed(_anchor_lists(n, length)), "route int, chunk int, data binary")
    twice = anchors.repartition(n, "route").mapInArrow(trimmed(_repeated), "chunk int, kind int, number long, data binary")
    own = (j.where(long_ & first)
           .select(chunk, F.lit(0).alias("kind"), F.coalesce("id", F.lit(-(1 << 63)).cast("long")).alias("number"), F.col("md5").cast("binary").alias("data")))
    runs = (texts.groupBy("chunk").cogroup(twice.union(own).groupBy("chunk"))
            .applyInArrow(trimmed_groups(_runs_of(n, length)), "route int, kind int, chunk int, data binary, bytes binary"))
    spans = runs.repartition(n, "route").mapInArrow(trimmed(_suffix_task(length)), "chunk int, data binary")
    schema = "md5 string, r_removed long, r_spans long, r_sha256 string"
    pick = lambda own_, copy, short: F.when(~long_, short).when(first, own_).otherwise(copy)
    zero, nothing = F.lit(0).cast("long"), F.lit(hashlib.sha256(b"").hexdigest())
    out = [F.col(f"c_{i}").alias(c) for i, c in enumerate(rest)]
    if with_text:  # the first row of a text goes to the text, so what is left of the texts isn't shuffled
        beside = [f"c_{i}" for i in range(len(rest))] + ["n_bytes"]
        own = j.where(long_ & first).select(chunk, F.lit(None).cast("binary").alias("data"), "md5", *beside)
        spans = spans.select("chunk", "data", F.lit(None).cast("string").alias("md5"), *[F.lit(None).cast(j.schema[c].dataType).alias(c) for c in beside])
        kind = StructType([*StructType.fromDDL(f"{schema}, r_kept {'string' if as_text else 'binary'}").fields, *[StructField(c, j.schema[c].dataType) for c in beside]])
        clean = texts.groupBy("chunk").cogroup(spans.union(own).groupBy("chunk")).applyInArrow(trimmed_groups(_cleaner(True, as_text, beside)), kind)
        firsts = clean.select(*out, "n_bytes", F.col("r_removed").alias("n_removed"), F.col("r_spans").alias("n_spans"), F.col("r_sha256").alias("kept_sha256"), F.col("r_kept").alias("kept"))
        short = docs.select(F.md5(t).alias("s"), t.alias("short")).where(F.octet_length("short") < length).dropDuplicates(["s"])
        j = j.where(~(long_ & first)).join(short, F.col("md5") == F.col("s"), "left")
        body = F.when(long_, F.lit("")).otherwise(F.col("short"))
        rest_ = j.select(*out, "n_bytes", F.when(long_, F.col("n_bytes")).otherwise(zero).alias("n_removed"), F.when(long_, F.lit(1).cast("long")).otherwise(zero).alias("n_spans"),
                         F.when(long_, nothing).otherwise(F.sha2("short", 256)).alias("kept_sha256"), (body if as_text else body.cast("binary")).alias("kept"))
        return firsts.union(rest_)
    clean = keep_table(texts.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(trimmed_groups(_cleaner(False, as_text)), schema), "dedup-texts")
    j = j.join(clean.withColumnRenamed("md5", "m"), F.col("md5") == F.col("m"), "left")
    out += ["n_bytes", pick(F.col("r_removed"), F.col("n_bytes"), zero).alias("n_removed"), pick(F.col("r_spans"), F.lit(1).cast("long"), zero).alias("n_spans")]
    small = docs.select(F.md5(t).alias("s"), F.sha2(t, 256).alias("whole"), F.octet_length(t).alias("l")).where(F.col("l") < length).select("s", "whole").distinct()
    j = j.join(small, F.col("md5") == F.col("s"), "left")
    return j.select(*out, pick(F.col("r_sha256"), nothing, F.col("whole")).alias("kept_sha256"))


def op3_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated strings of 100 bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs)
