"""Token ids as word-aligned Simple-8b files, in ascending document order.

A file (``.s8b``) holds whole documents: a header, the documents' ids and token counts, the first word of every
block, the escaped values and the 64-bit words. A word's top four bits are its selector; the selector says how
many ids of how many bits the other sixty bits hold. Values over sixty bits go to the escape table and selector
0 points there. Blocks of ``BLOCK_IDS`` ids start at a word of their own, so blocks are coded and decoded side
by side as numpy lanes, and any block can be read alone.

Results in edge cases: a null text is empty and has only the end id; null document ids come first, as nulls;
repeated document ids keep one entry a row, ordered by a hash of the text; no rows give no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_blocks, keep_table, partitions, prepare, running_offsets, shared_path
from .tokens import CACHE_PIECES, ENCODE_BYTES, TextEncoder, tokenizer_file

BLOCK_IDS = 1024
FILE_IDS = 1_000_000  # a file is closed after the document that reaches this; bounds a task's memory
MAGIC = b"S8BLOCK1"
# fixed values: (ids in a word, bits of an id) by selector; 0 is the escape, 15 is unused
PACKINGS = [(1, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15),
            (3, 20), (2, 30), (1, 60)]
_COUNT = np.array([c for c, _ in PACKINGS] + [0], np.int64)
_PAD = 64


_LANES = 512  # blocks coded side by side; any number gives the same words
_WIDTH = np.array([x.bit_length() for x in range(1 << 16)], np.uint8)


def _lanes(ids: np.ndarray) -> np.ndarray:
    """The ids as rows of one block each; zeros fill the rest."""
    n = len(ids)
    out = np.zeros((-(-n // BLOCK_IDS), BLOCK_IDS + _PAD), ids.dtype)
    full = n // BLOCK_IDS
    out[:full, :BLOCK_IDS] = ids[:full * BLOCK_IDS].reshape(full, BLOCK_IDS)
    if n % BLOCK_IDS:
        out[full, :n % BLOCK_IDS] = ids[full * BLOCK_IDS:]
    return out


def _widths(rows: np.ndarray) -> np.ndarray:
    """Bits of each id."""
    out, rest, add = np.zeros(rows.shape, np.uint8), rows, 0
    while True:
        low = _WIDTH[rest & rest.dtype.type(0xFFFF)] if rest.itemsize > 2 else _WIDTH[rest]
        out = np.where(low > 0, low + np.uint8(add), out) if add else low
        add += 16
        if rest.itemsize <= 2 or not (rest := rest >> rest.dtype.type(16)).any():
            return out


def _all_within(ok: np.ndarray, count: int) -> np.ndarray:
    """Along rows: whether this and the next ``count - 1`` places hold; places past the row's end hold."""
    have, out = 1, ok
    while have < count:
        step = min(have, count - have)
        nxt = out.copy()
        nxt[:, :-step] &= out[:, step:]
        out, have = nxt, have + step
    return out


def _encode_lanes(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, words of each row, escaped values) of rows that hold ``size`` ids each."""
    nb = len(rows)
    width = _widths(rows)
    best = np.zeros(rows.shape, np.uint8)
    for s in range(len(PACKINGS) - 1, 0, -1):  # a selector with more ids goes over one with fewer
        count, bits = PACKINGS[s]
        ok = width <= bits
        best[_all_within(ok, count)] = s
    at, sels, places = np.zeros(nb, np.int64), [], []
    start, flat_best = np.arange(nb) * rows.shape[1], best.reshape(-1)
    count = _COUNT.copy()
    while True:
        sel = flat_best[start + at]
        sel[at >= size] = 15
        if (sel == 15).all():
            break
        sels.append(sel)
        places.append(at)
        at = at + count[sel]
    sel, place = np.stack(sels, 1), np.stack(places, 1) + start[:, None]
    real = sel != 15
    each = real.sum(1)
    sel, place = sel[real], place[real]
    flat, out = rows.reshape(-1), np.zeros(len(sel), np.uint64)
    for s in range(1, len(PACKINGS)):
        mine = np.flatnonzero(sel == s)
        if len(mine):
            count, bits = PACKINGS[s]
            word, where = np.full(len(mine), s << 60, np.uint64), place[mine]
            for j in range(count):
                word |= flat[where + j].astype(np.uint64) << np.uint64(bits * j)
            out[mine] = word
    mine = np.flatnonzero(sel == 0)
    out[mine] = np.arange(len(mine), dtype=np.uint64)
    return out, each, flat[place[mine]].astype(np.uint64)


def encode_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block and the number of words, escaped values) of unsigned ids."""
    if ids.dtype.kind != "u":
        ids = ids.astype(np.uint64)
    parts, step = [], _LANES * BLOCK_IDS
    for lo in range(0, len(ids), step):
        rows = _lanes(ids[lo:lo + step])
        size = np.full(len(rows), BLOCK_IDS, np.int64)
        size[-1] = len(ids[lo:lo + step]) - (len(rows) - 1) * BLOCK_IDS
        parts.append(_encode_lanes(rows, size))
    before = 0
    for words, _, escapes in parts:  # escapes are numbered through the file
        words[words >> np.uint64(60) == 0] += np.uint64(before)
        before += len(escapes)
    first = np.zeros(sum(len(x[1]) for x in parts) + 1, np.int64)
    if parts:
        np.cumsum(np.concatenate([x[1] for x in parts]), out=first[1:])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *[x[0] for x in parts]]), first, np.concatenate([none, *[x[2] for x in parts]])


def _decode_lanes(words: np.ndarray, first: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    nb, wide = len(first) - 1, BLOCK_IDS + _PAD
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNT[sel]
    before = np.cumsum(count) - count
    place = before + np.repeat(np.arange(nb) * wide - before[first[:-1]], np.diff(first))
    out = np.zeros(nb * wide, np.uint64)
    for s in range(1, len(PACKINGS)):
        mine = np.flatnonzero(sel == s)
        if len(mine):
            bits = PACKINGS[s][1]
            mask, word, where = np.uint64((1 << bits) - 1), words[mine], place[mine]
            for j in range(PACKINGS[s][0]):
                out[where + j] = (word >> np.uint64(bits * j)) & mask
    mine = np.flatnonzero(sel == 0)
    out[place[mine]] = escapes[words[mine].astype(np.int64)]
    return out.reshape(nb, wide)[:, :BLOCK_IDS].reshape(-1)


def decode_words(words: np.ndarray, first: np.ndarray, escapes: np.ndarray, n: int, dtype=np.uint64) -> np.ndarray:
    """The ``n`` ids of consecutive whole blocks; ``first`` has the blocks' first words within ``words``."""
    out, lanes = np.empty((len(first) - 1) * BLOCK_IDS, dtype), _LANES // 8
    for lo in range(0, len(first) - 1, lanes):
        part = first[lo:lo + lanes + 1]
        got = _decode_lanes(words[part[0]:part[-1]], part - part[0], escapes)
        out[lo * BLOCK_IDS:lo * BLOCK_IDS + len(got)] = got
    return out[:n]


def file_bytes(doc_ids: np.ndarray, known: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: documents (``known`` is false where the document id is null), their token counts, their ids."""
    words, first, escapes = encode_words(ids)
    head = struct.pack("<8s5q", MAGIC, len(doc_ids), len(ids), len(first) - 1, len(words), len(escapes))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), known.astype(np.uint8).tobytes(), sizes.astype("<i8").tobytes(),
                     first.astype("<i8").tobytes(), escapes.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def parse_file(data: bytes, dtype=np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, known, token counts, ids) of one file."""
    magic, docs, n, nb, nw, ne = struct.unpack_from("<8s5q", data)
    if magic != MAGIC:
        raise ValueError("not a token file of this format")
    at, parts = struct.calcsize("<8s5q"), []
    for kind, k in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<i8", nb + 1), ("<u8", ne), ("<u8", nw)):
        parts.append(np.frombuffer(data, kind, k, at))
        at += k * np.dtype(kind).itemsize
    doc_ids, known, sizes, first, escapes, words = parts
    return doc_ids, known.astype(bool), sizes, decode_words(words, first, escapes, n, dtype)


def _writer(folder: str, file: str, kind: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext
        enc, part = TextEncoder(file, kind, 2 * CACHE_PIECES), TaskContext.get().partitionId()
        attempt = TaskContext.get().taskAttemptId()
        store, base = fs.FileSystem.from_uri(folder)
        held: list[tuple] = []
        seq = 0

        def close() -> pa.RecordBatch:
            doc_ids, known, sizes, ids = (np.concatenate(x) for x in zip(*held))
            name = f"part-{part:06d}-{seq:05d}.s8b"
            with store.open_output_stream(f"{base}/.{name}.{attempt}") as f:  # a name of its own, then renamed: a
                f.write(file_bytes(doc_ids, known, sizes, ids))  # lost or repeated task leaves no half file
            store.move(f"{base}/.{name}.{attempt}", f"{base}/{name}")
            return pa.RecordBatch.from_pydict({"file": [(part << 20) + seq], "name": [name], "n_docs": [len(doc_ids)],
                                               "n_ids": [len(ids)]})

        for batch, lo, hi, buf, offs in batch_blocks(batches, "text", ENCODE_BYTES):
            ids, at = enc.encode(buf, offs, end_id)
            col = batch.column("doc_id").slice(lo, hi - lo)
            held.append((col.fill_null(0).to_numpy(zero_copy_only=False), col.is_valid().to_numpy(zero_copy_only=False),
                         np.diff(at), ids))
            if sum(len(x[3]) for x in held) >= FILE_IDS:
                yield close()
                held, seq = [], seq + 1
        if held:
            yield close()
    return run


def write_token_files(docs: DataFrame, folder: str, file: str | None = None, kind: str = "bytes",
                      end_id: int = 2) -> DataFrame:
    """Write ``docs`` (doc_id long, text) as token files below ``folder``; returns the written manifest.

    Documents are dealt out by ranges of doc_id (ties by a hash of the text), so file numbers follow document
    order and no task gathers one source or one id. ``folder`` is any URI that pyarrow can write.
    """
    spark = docs.sparkSession
    prepare(spark)
    from pyarrow import fs
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    file = file or tokenizer_file("byte_bpe_50k.json")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = d.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    return keep_table(dealt.mapInArrow(_writer(folder, file, kind, end_id),
                                       "file long, name string, n_docs long, n_ids long"), "token-manifest")


_READ = T.StructType([T.StructField("file", T.LongType()), T.StructField("place", T.LongType()),
                      T.StructField("doc_id", T.LongType()), T.StructField("in_file", T.LongType()),
                      T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def _reader(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, seq = batch.column("path")[i].as_py().rsplit("/", 1)[1][5:-4].split("-")
                doc_ids, known, sizes, ids = parse_file(memoryview(batch.column("content")[i].as_buffer()), np.dtype("<u4"))
                ends = np.cumsum(sizes)
                data, at = ids, ends - sizes
                view = memoryview(data).cast("B")
                n = len(doc_ids)
                cols = {"file": np.full(n, (int(part) << 20) + int(seq)), "place": np.arange(n),
                        "doc_id": pa.array(doc_ids, mask=~known), "in_file": at, "n_tokens": sizes,
                        "ids_crc32": np.array([zlib.crc32(view[4 * a:4 * b]) for a, b in zip(at, ends)], np.int64)}
                if with_ids:
                    cols["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()),
                                                           pa.array(data.astype(np.int64)))
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in cols.items()})
    return run


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """The documents of written files: doc_id, start (ids of all documents before), n_tokens, ids_crc32 [, ids]."""
    prepare(spark)
    schema = T.StructType(_READ.fields + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.s8b").load(folder).select("path", "content")
    docs = files.mapInArrow(_reader(with_ids), schema)
    base = running_offsets(manifest.select("file", "n_ids"), [], "file", "n_ids", "before")
    return (docs.join(base.select("file", "before"), "file")
            .select("doc_id", (F.col("before") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32",
                    *["ids"] * with_ids))


def op9_simple8b_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through token files and back, one row a document."""
    folder = shared_path(spark, "token-files")
    manifest = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_token_files(spark, folder, manifest)
