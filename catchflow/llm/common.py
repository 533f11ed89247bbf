"""Shared pieces of the training-data operators.

* ``keep_table``: a written table in the shared folder named by ``spark.checkpoint.dir``; it cuts the
  lineage and survives lost executors.
* ``running_offsets``: prefix sums over many small groups without one big window.
* Vectorised UTF-8 helpers that work on the concatenated bytes of many texts: words, hashes, blocks.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catchflow.session import checkpoint_dir, ship_package

# [\x20\x09-\x0D]: the bytes between words
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
# A-Z to a-z, every other byte unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

WORD_BITS = 18  # marks are 64 << WORD_BITS bins, broadcast as words of 64
BLOCK_BYTES = 1 << 20  # texts are worked on in blocks of about this size; a longer text is a block of its own


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir`` (the context's own folder only where that is unset)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: later steps never recompute it."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def drop_table(df: DataFrame) -> None:
    """Delete a table of ``keep_table`` that nothing reads any more: no frame that is still to be read may come from it."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.kept_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def marks(keys: DataFrame, column: str) -> DataFrame:
    """(word, bits): the bins of the hashes of ``column``; at most ``1 << WORD_BITS`` rows, whatever the table."""
    h = F.xxhash64(column)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(xxhash64(`{column}`), {58 - WORD_BITS}) & 63 AS INT))")
    return keys.select(F.shiftrightunsigned(h, 64 - WORD_BITS).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def parted(df: DataFrame, column: str, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose ``column`` is surely none of the keys behind the ``marks`` ``found``, and those where it may be one.

    Nothing is shuffled, so a join that follows shuffles the rows it is about and few others; with more keys than bins
    (``64 << WORD_BITS``) the second part grows to the whole.
    """
    mine = f"shiftleft(1L, CAST(shiftrightunsigned(xxhash64(`{column}`), {58 - WORD_BITS}) & 63 AS INT))"
    word = F.shiftrightunsigned(F.xxhash64(column), 64 - WORD_BITS)
    b = F.broadcast(found.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    hit = F.expr(f"_bits & {mine}") != 0
    surely = df.join(b, word == F.col("_word"), "left").where(F.col("_bits").isNull() | ~hit)
    return surely.select(*df.columns), df.join(b, word == F.col("_word")).where(hit).select(*df.columns)


def prepare(spark: SparkSession) -> None:
    """Make this package importable on the executors and the shared folder known to the context."""
    checkpoint_dir(spark)
    ship_package(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_offsets(df: DataFrame, keys: list[str], order: str, value: str, name: str, block: int = 1024) -> DataFrame:
    """``df`` plus ``name``: the sum of ``value`` over rows of the same ``keys`` with a smaller ``order``.

    ``order`` is a unique long per key. Sums of blocks of ``block`` consecutive orders come first, so no
    window holds more than ``block`` rows or one row per block.
    """
    b = df.withColumn("_block", F.floor(F.col(order) / block))
    sums = b.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_block").alias("_kb"),
                       F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    on = (F.col("_block") == F.col("_kb"))
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = b.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0))).join(base, on)
    return out.withColumn(name, (F.col("_in") + F.col("_base")).cast("long")).select(*df.columns, name)


def give_back() -> None:
    """Memory that this process freed, and its table of powers, goes back to the system."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(run):
    """``run`` for ``mapInArrow``; after a task's rows the memory it freed goes back to the system, as the worker lives on."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return task


def trimmed_groups(run):
    """As ``trimmed``, for cogrouped ``applyInArrow``: after each pair of groups."""
    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        give_back()
        return out
    return task


# ---------------------------------------------------------------- bytes of many texts

def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; a null text is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def blocks(buf: np.ndarray, offs: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: (first row, end row, bytes, offsets in these bytes)."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def batch_blocks(batches, column: str = "text", size: int = BLOCK_BYTES):
    """Blocks of the texts of Arrow batches, each with the batch and its row range."""
    for batch in batches:
        if batch.num_rows:
            buf, offs = text_bytes(batch.column(column))
            for lo, hi, b, o in blocks(buf, offs, size):
                yield batch, lo, hi, b, o


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words ``[^\\x20\\x09-\\x0D]+``; no word crosses a text."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    dark = ~WHITE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, dark[:-1]
    starts = np.flatnonzero(dark & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, dark[1:]
    ends = np.flatnonzero(dark & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 4096)
        for k, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _POWERS[k] = np.multiply.accumulate(step)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers whose bits all depend on all bits of ``h``."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: a polynomial over prefix sums, so each byte is touched once."""
    up, down = _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive entries of ``h`` (``len(h) - k + 1`` of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + h[j:j + n]
    return mix(out)


def ragged(values: np.ndarray, offs: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``pick`` of the ragged rows ``values[offs[i]:offs[i + 1]]``, joined, and their offsets."""
    size = offs[pick + 1] - offs[pick]
    out = np.zeros(len(pick) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    at = np.repeat(offs[pick] - out[:-1], size) + np.arange(out[-1])
    return values[at], out


def binary_column(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def binary_rows(values: np.ndarray, offs: np.ndarray) -> pa.Array:
    """A binary column whose row i holds the bytes of ``values[offs[i]:offs[i + 1]]``."""
    data = np.ascontiguousarray(values)
    pos = (offs * data.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offs) - 1, [None, pa.py_buffer(pos), pa.py_buffer(data)])
