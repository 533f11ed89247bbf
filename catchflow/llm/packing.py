"""Packing token ids into windows by non-negative least squares over a length histogram.

1. Every document becomes pieces: full windows, and one rest shorter than a window.
2. The rests' lengths make a histogram of at most ``window - 1`` bins, whatever the data's size. Shallow
   combinations of lengths that fill a window exactly (pairs, triples, and copies of one length with a filler)
   are the columns of ``A``; coordinate descent solves ``min ||A x - histogram||, x >= 0`` for how often each is
   repeated. Rounding, never above what the histogram holds, gives whole numbers.
3. What rounding leaves over is packed greedily: the leftovers lie end to end, longest first, and are cut where
   a window is full.

A rest finds its window from its rank among the rests of its length alone. Ranks come from (length, task)
counts and their prefix sums, so a length that a third of all rows share is no task's burden.

Results in edge cases: a null or empty text is its end id alone; repeated rows and repeated or null document ids
are packed row by row; no rows give no pieces; other columns of the input are not read. Only the very last
sequence can be short of a window. ``PLAN_COLUMNS`` bounds what the driver solves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_blocks, binary_rows, keep_table, prepare, running_offsets, trimmed
from .tokens import ENCODE_BYTES, TextEncoder, tokenizer_file

PLAN_COLUMNS = 60_000  # combinations considered; depends on the window alone
SWEEPS = 40

_PIECES = "part long, row long, doc_id long, start long, length long, doc_tokens long, rank long, ids binary"
PIECE_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in
                             ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


# ---------------------------------------------------------------- the plan (histogram only, on the driver)

def combinations(window: int, limit: int = PLAN_COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """Length combinations that fill ``window``: (lengths, multiplicities), three places each, 0 where unused."""
    half = np.arange(1, window // 2 + 1)
    rows = [np.stack([window - half, half, 0 * half], 1)]
    mults = [np.where(rows[0][:, :1] == rows[0][:, 1:2], [[2, 0, 0]], [[1, 1, 0]])]
    one = np.arange(1, window // 3 + 1)  # as many copies of one length as go, and a filler
    copies, fill = window // one, window % one
    rows.append(np.stack([one, fill, 0 * one], 1))
    mults.append(np.stack([copies, (fill > 0).astype(int), 0 * one], 1))
    thirds = max(1, (limit - 2 * window) // max(1, window // 2))
    for c in np.unique(np.linspace(1, max(1, window // 3), thirds).astype(int)):
        b = np.arange(c, (window - c) // 2 + 1)
        a = window - c - b
        rows.append(np.stack([a, b, np.full_like(b, c)], 1)[(a > b) & (b > c)])
        mults.append(np.ones_like(rows[-1]))
    lengths, mult = np.concatenate(rows), np.concatenate(mults)
    return lengths * (mult > 0), mult


def solve_counts(hist: np.ndarray, lengths: np.ndarray, mult: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative least squares by coordinate descent: how often each combination is used."""
    open_ = np.where(mult > 0, hist[lengths] > 0, True).all(1)  # a length that never occurs can't help
    cols = np.flatnonzero(open_)
    left = hist.astype(float).tolist()
    plan = [(int(k), [(int(n), int(m)) for n, m in zip(lengths[k], mult[k]) if m]) for k in cols]
    plan = [(k, use, 1.0 / sum(m * m for _, m in use)) for k, use in plan]
    x = np.zeros(len(lengths)).tolist()
    total = max(1.0, float(hist.sum()))
    for _ in range(sweeps):
        moved = 0.0
        for k, use, scale in plan:
            step = sum(m * left[n] for n, m in use) * scale
            new = x[k] + step
            if new < 0.0:
                new = 0.0
            step = new - x[k]
            if step:
                x[k] = new
                for n, m in use:
                    left[n] -= m * step
                moved += abs(step)
        if moved < 1e-3 * total:
            break
    return np.array(x)


def round_counts(x: np.ndarray, hist: np.ndarray, lengths: np.ndarray, mult: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole repeat counts, largest first, never above what is left of the histogram; and what stays."""
    left, out = hist.astype(np.int64).copy(), np.zeros(len(x), np.int64)
    order = np.lexsort((np.arange(len(x)), -x))
    for up in (0.0, 0.5, 1.0):  # whole parts first, then the nearest, then anything that still fits
        for k in order[x[order] > 0]:
            use = mult[k] > 0
            most = int((left[lengths[k][use]] // mult[k][use]).min())
            n = min(most, int(x[k] + up) - int(out[k]))
            if n > 0:
                out[k] += n
                left[lengths[k][use]] -= n * mult[k][use]
    return out, left


class PackPlan:
    """Where the r-th rest of each length goes. Arrays of at most a few entries per combination."""

    def __init__(self, hist: np.ndarray, window: int):
        """``hist[n]`` is the number of rests of length n (n < window)."""
        self.window = window
        lengths, mult = combinations(window)
        x = solve_counts(hist, lengths, mult)
        counts, left = round_counts(x, hist, lengths, mult)
        used = np.flatnonzero(counts)
        seq, taken = 0, np.zeros(window, np.int64)
        segs: list[tuple[int, int, int, int, int]] = []  # length, first rank, first sequence, copies, offset
        for k in used:
            at = 0
            for n, m in zip(lengths[k], mult[k]):
                if m:
                    segs.append((int(n), int(taken[n]), seq, int(m), at))
                    taken[n] += m * counts[k]
                    at += int(n) * int(m)
            seq += int(counts[k])
        self.by_plan, self.planned = int(taken.sum()), seq
        # leftovers, longest first, end to end
        base, at = np.zeros(window, np.int64), 0
        for n in range(window - 1, 0, -1):
            base[n] = at
            at += n * int(left[n])
        self.loose_base, self.loose_tokens, self.taken = base, at, taken
        segs.sort()
        cols = np.array(segs, np.int64).reshape(-1, 5).T
        self.seg_length, self.seg_rank, self.seg_seq, self.seg_mult, self.seg_at = cols
        self.sequences = seq + -(-at // window)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of rests; offset + length can pass the window, the next sequence has the rest."""
        loose = rank >= self.taken[length]
        line = self.loose_base[length] + (rank - self.taken[length]) * length
        seq, at = self.planned + line // self.window, line % self.window
        k = np.flatnonzero(~loose)
        if len(k):
            big = np.int64(1) << 40
            s = np.searchsorted(self.seg_length * big + self.seg_rank, length[k] * big + rank[k], "right") - 1
            inner = rank[k] - self.seg_rank[s]
            seq[k] = self.seg_seq[s] + inner // self.seg_mult[s]
            at[k] = self.seg_at[s] + inner % self.seg_mult[s] * length[k]
        return seq, at


# ---------------------------------------------------------------- on Spark

def _cutter(file: str, kind: str, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc, part = TextEncoder(file, kind), TaskContext.get().partitionId()
        seen, done = np.zeros(window + 1, np.int64), 0
        for batch, lo, hi, buf, offs in batch_blocks(batches, "text", ENCODE_BYTES):
            ids, at = enc.encode(buf, offs, end_id)
            size = np.diff(at)
            pieces = -(-size // window)
            doc = np.repeat(np.arange(len(size)), pieces)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = nth * window
            length = np.minimum(window, size[doc] - start)
            order = np.argsort(length, kind="stable")  # rank: earlier pieces of this length in this task
            sorted_ = length[order]
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.searchsorted(sorted_, sorted_) + seen[sorted_]
            seen += np.bincount(length, minlength=window + 1)
            ends = np.append(0, np.cumsum(length))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(doc), part)), pa.array(done + np.arange(len(doc))),
                batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)), pa.array(start), pa.array(length),
                pa.array(size[doc]), pa.array(rank), binary_rows(ids, ends)], names=[x.split()[0] for x in _PIECES.split(", ")])
            done += len(doc)
    return run


def _placer(plan: PackPlan, dtype: np.dtype, with_ids: bool):
    window = plan.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            start, length, rank = (b.column(k).to_numpy(zero_copy_only=False) for k in ("start", "length", "rank"))
            seq, at = plan.place(np.where(length < window, length, 0), rank)
            full = length == window  # full windows come after the planned and the greedy sequences
            seq, at = np.where(full, plan.sequences + rank, seq), np.where(full, 0, at)
            cut = np.flatnonzero(at + length > window)
            row = np.concatenate([np.arange(n), cut])
            head = np.minimum(length, window - at)
            start2 = np.concatenate([start, start[cut] + head[cut]])
            length2 = np.concatenate([head, (length - head)[cut]])
            seq2, at2 = np.concatenate([seq, seq[cut] + 1]), np.concatenate([at, 0 * cut])
            first = np.concatenate([0 * start, head[cut]])
            data = b.column("ids")
            crc = np.empty(len(row), np.int64)
            out_ids = []
            for j, (r, f, m) in enumerate(zip(row.tolist(), first.tolist(), length2.tolist())):
                part = np.frombuffer(data[r].as_buffer(), dtype, m, f * dtype.itemsize).astype("<u4")
                crc[j] = zlib.crc32(part)
                if with_ids:
                    out_ids.append(part.astype(np.int32))
            take = pa.array(row)
            cols = [b.column("doc_id").take(take), pa.array(start2), pa.array(length2), pa.array(crc),
                    b.column("doc_tokens").take(take), pa.array(seq2), pa.array(at2)]
            names = PIECE_SCHEMA.names
            if with_ids:
                cols.append(pa.array(out_ids, pa.list_(pa.int32())))
                names = [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def pack_documents(docs: DataFrame, window: int = 2048, file: str | None = None, kind: str = "words", end_id: int = 1,
                   with_ids: bool = False) -> DataFrame:
    """Pack all ``docs`` (doc_id long, text) into sequences of ``window`` ids; one row per piece.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset [, ids]. Sequences are numbered
    from 0 without gaps: planned ones, greedy ones, then full windows.
    """
    spark = docs.sparkSession
    prepare(spark)
    file = file or tokenizer_file("word_bpe_49k.json")
    dtype = TextEncoder(file, kind).dtype
    pieces = keep_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                        .mapInArrow(trimmed(_cutter(file, kind, end_id, window)), _PIECES), "pack-pieces")
    counts = keep_table(pieces.groupBy("part", "length").count(), "pack-counts")
    hist = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most ``window`` rows
        hist[r["length"]] = r["n"]
    plan = PackPlan(hist[:window], window)
    base = running_offsets(counts, ["length"], "part", "count", "before").select(
        F.col("part").alias("_part"), F.col("length").alias("_length"), "before")
    placed = (pieces.join(base, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length")))
              .select("doc_id", "start", "length", "doc_tokens", (F.col("rank") + F.col("before")).alias("rank"), "ids"))
    schema = T.StructType(PIECE_SCHEMA.fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)
    return placed.mapInArrow(trimmed(_placer(plan, dtype, with_ids)), schema)


def op1_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 ids."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
