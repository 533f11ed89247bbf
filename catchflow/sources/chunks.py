"""Chunked raster stores (S1, S2, U3): Zarr-v2-style arrays decoded on the executors.

A store holds one folder per variable with a ``.zarray`` JSON (shape, chunks, dtype, compressor,
fill value), optional ``.zattrs`` (``scale_factor``, ``add_offset``, ``_FillValue``) and one file per
chunk named ``<i>.<j>.<k>``. A 1-D ``time`` array holds offsets in ``<unit> since <epoch>``
(seconds, minutes, hours or days).

The scans go through the data source of :mod:`chunk_source`: filters on cell indices, time and variable reach
it as ranges, and only the chunks that meet them are opened. Chunks become Arrow batches of
``(time, iy, ix, variable, value)`` built with numpy, so Python only touches raw bytes; all later work
(joins, aggregates) is Catalyst.
"""

from __future__ import annotations

import gzip
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .chunk_source import ChunkSource

# ---------------------------------------------------------------- codecs

def decompress(buf: bytes, compressor: dict | None) -> bytes:
    """Decode one chunk's bytes. Supported: none, zlib, gzip, zstd, lz4 (size-prefixed block)."""
    if not compressor:
        return buf
    cid = compressor.get("id")
    if cid == "zlib":
        return zlib.decompress(buf)
    if cid == "gzip":
        return gzip.decompress(buf)
    if cid == "zstd":
        import zstandard
        return zstandard.ZstdDecompressor().decompress(buf, max_output_size=1 << 31)
    if cid == "lz4":
        n = int.from_bytes(buf[:4], "little")
        return pa.decompress(buf[4:], decompressed_size=n, codec="lz4_raw").to_pybytes()
    raise ValueError(f"unsupported chunk codec {cid!r} (no decoder for it in this environment)")


def compress(raw: bytes, compressor: dict | None) -> bytes:
    if not compressor:
        return raw
    cid = compressor.get("id")
    if cid == "zlib":
        return zlib.compress(raw, compressor.get("level", 1))
    if cid == "gzip":
        return gzip.compress(raw, compressor.get("level", 1))
    if cid == "zstd":
        import zstandard
        return zstandard.ZstdCompressor(level=compressor.get("level", 1)).compress(raw)
    if cid == "lz4":
        body = pa.compress(raw, codec="lz4_raw", asbytes=True)
        return len(raw).to_bytes(4, "little") + body
    raise ValueError(f"unsupported chunk codec {cid!r}")


# ---------------------------------------------------------------- metadata

UNITS_US = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def file_system(path: str):
    """(file system, path in it) through ``pyarrow.fs``: local, S3 and HDFS URIs."""
    from pyarrow import fs as pafs
    if "://" not in path:
        path = "file://" + (path[len("file:"):] if path.startswith("file:") else path)
    return pafs.FileSystem.from_uri(path)


def read_bytes(path: str) -> bytes:
    f, p = file_system(path)
    with f.open_input_stream(p) as h:
        return h.read()


def folder_there(path: str) -> bool:
    from pyarrow import fs as pafs
    f, p = file_system(path)
    return f.get_file_info(p).type == pafs.FileType.Directory


def list_stores(root: str) -> list[str]:
    """The folders directly below ``root``, as paths like ``root`` itself; one listing."""
    from pyarrow import fs as pafs
    f, p = file_system(root)
    found = f.get_file_info(pafs.FileSelector(p, allow_not_found=True))
    return sorted(f"{root.rstrip('/')}/{i.base_name}" for i in found if i.type == pafs.FileType.Directory)


def read_meta(var_root: str) -> dict:
    """``.zarray`` merged with ``.zattrs`` of one variable. A missing ``.zarray`` and features that have no
    decoder here (filters, unknown codecs) are errors."""
    try:
        meta = json.loads(read_bytes(f"{var_root}/.zarray"))
    except FileNotFoundError as e:
        raise FileNotFoundError(f"no array metadata at {var_root}/.zarray" if folder_there(var_root) else f"{var_root} does not exist") from e
    try:
        meta["attrs"] = json.loads(read_bytes(f"{var_root}/.zattrs"))
    except FileNotFoundError:
        meta["attrs"] = {}
    if meta.get("filters"):
        raise ValueError(f"{var_root}: array filters {meta['filters']} can't be decoded here")
    if (meta.get("compressor") or {}).get("id") not in (None, "zlib", "gzip", "zstd", "lz4"):
        raise ValueError(f"{var_root}: unsupported chunk codec {meta['compressor']['id']!r}")
    return meta


def read_times(store: str) -> np.ndarray:
    """The store's time axis as microseconds since 1970 (UTC wall time)."""
    meta = read_meta(f"{store}/time")
    unit, _, epoch = meta["attrs"].get("units", "hours since 1970-01-01 00:00:00").partition(" since ")
    scale = UNITS_US.get(unit.strip().lower().rstrip("s"))
    if scale is None or not epoch:
        raise ValueError(f"{store}/time: unknown time units {meta['attrs'].get('units')!r}")
    start = int(np.datetime64(epoch.strip().replace(" ", "T"), "us").astype(np.int64))
    parts = [decode_chunk(read_bytes(f"{store}/time/{k}"), (k,), meta) for k in range(-(-meta["shape"][0] // meta["chunks"][0]))]
    return start + np.rint(np.concatenate(parts) * scale).astype(np.int64)


# ---------------------------------------------------------------- decode (executors)

def decode_chunk(content: bytes, key: tuple[int, ...], meta: dict) -> np.ndarray:
    """Chunk bytes -> array of doubles: edge padding trimmed, fill -> NaN, scale and offset applied."""
    shape, chunks = meta["shape"], meta["chunks"]
    dtype = np.dtype(meta["dtype"])
    arr = np.frombuffer(decompress(content, meta.get("compressor")), dtype=dtype)
    arr = arr.reshape(chunks, order=meta.get("order", "C"))
    arr = arr[tuple(slice(0, min(c, n - k * c)) for k, c, n in zip(key, chunks, shape))]
    vals = arr.astype("float64")
    fill = meta["attrs"].get("_FillValue", meta.get("fill_value"))
    if fill is not None and not (isinstance(fill, float) and np.isnan(fill)) and fill != "NaN":
        vals = np.where(arr == np.array(fill, dtype=dtype), np.nan, vals)
    scale = meta["attrs"].get("scale_factor")
    offset = meta["attrs"].get("add_offset")
    if scale is not None:
        vals = vals * scale
    if offset is not None:
        vals = vals + offset
    return vals


# ---------------------------------------------------------------- scan

def _load(spark: SparkSession, variables: list[str], **options: str) -> DataFrame:
    """The registered data source. Spark hands filters to Python sources only where this setting says so."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChunkSource)
    return spark.read.format(ChunkSource.name()).options(variables=json.dumps(variables), **options).load()


def scan_chunks(spark: SparkSession, roots: str | list[str], variables: list[str], drop_fill: bool = False,
                tolerant: bool = False, with_errors: bool = False) -> DataFrame:
    """S1/S2 + U3: the chunks of ``variables`` under all store roots in one job.

    Output ``time, iy, ix, variable, value``. Filters on these columns (see :func:`covered_range
    <catchflow.operators.forcing.covered_range>`) decide which chunks are opened. A store or variable that is missing
    and a chunk that can't be decoded fail the job; with ``tolerant`` (an hour of a forecast archive may be missing)
    they drop out, and ``with_errors`` shows why (with ``store, path, error``, error rows included).
    """
    roots = [r.rstrip("/") for r in ([roots] if isinstance(roots, str) else roots)]
    return _load(spark, variables, stores=json.dumps(roots), tolerant=str(tolerant).lower(), drop_fill=str(drop_fill).lower(),
                 detail=str(with_errors).lower())


def scan_raster(spark: SparkSession, template: str, years: tuple[int, int], variables: list[str],
                drop_fill: bool = False, tolerant: bool = False) -> DataFrame:
    """One store per year from ``range(begin, end)`` (end exclusive), concatenated in time."""
    roots = [template.format(year=y) for y in range(*years)]
    return scan_chunks(spark, roots, variables, drop_fill, tolerant)


def scan_archive(spark: SparkSession, root: str, variables: list[str], drop_fill: bool = True,
                 box: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Every store directly below ``root`` (an archive of one store per run), in one job.

    Output as :func:`scan_chunks` with errors: ``time, iy, ix, variable, value, store, path, error``. A run that isn't
    there is not listed; a chunk, an array or a time axis that can't be decoded is an error row. The tasks read the
    metadata of their own runs, so planning is one listing however many runs there are. ``box`` (first and last row,
    first and last column) leaves out the chunks and cells beyond it.
    """
    cut = {"box": json.dumps(box)} if box else {}
    return _load(spark, variables, archive=root.rstrip("/"), tolerant="true", drop_fill=str(drop_fill).lower(), detail="true", **cut)


def chunk_errors(spark: SparkSession, roots: str | list[str], variables: list[str]) -> DataFrame:
    """S2 report: the chunk files that could not be decoded and why."""
    return (scan_chunks(spark, roots, variables, tolerant=True, with_errors=True)
            .where(F.col("error").isNotNull()).select("variable", "path", "error").distinct())


# ---------------------------------------------------------------- write (fixture / export side)

def write_store(df: DataFrame, root: str, variables: list[str], shape: tuple[int, int, int],
                chunks: tuple[int, int, int], times: list[int], epoch: str, compressor: dict | None,
                dtype: str = "<f4", unit: str = "hours") -> None:
    """Write long rows ``t, iy, ix, <variables>`` as a chunked store (executors write the chunk files).

    Each chunk is one group of at most ``prod(chunks)`` cells, so a group never grows with the data.
    The JSON metadata and the small time axis are written by the driver.
    """
    import os
    ship_package(df.sparkSession)
    fill = float("nan")
    for v in variables + ["time"]:
        os.makedirs(f"{root}/{v}", exist_ok=True)
    for v in variables:
        meta = {"zarr_format": 2, "shape": list(shape), "chunks": list(chunks), "dtype": dtype,
                "compressor": compressor, "fill_value": "NaN", "order": "C", "filters": None}
        with open(f"{root}/{v}/.zarray", "w") as fh:
            json.dump(meta, fh)
        with open(f"{root}/{v}/.zattrs", "w") as fh:
            json.dump({"_ARRAY_DIMENSIONS": ["time", "y", "x"]}, fh)
    tmeta = {"zarr_format": 2, "shape": [len(times)], "chunks": [len(times)], "dtype": "<i8",
             "compressor": None, "fill_value": None, "order": "C", "filters": None}
    with open(f"{root}/time/.zarray", "w") as fh:
        json.dump(tmeta, fh)
    with open(f"{root}/time/.zattrs", "w") as fh:
        json.dump({"units": f"{unit} since {epoch}", "_ARRAY_DIMENSIONS": ["time"]}, fh)
    with open(f"{root}/time/0", "wb") as fh:
        fh.write(np.asarray(times, dtype="<i8").tobytes())

    ct, cy, cx = chunks
    long = df.unpivot(["t", "iy", "ix"], variables, "variable", "value").select(
        "variable", "t", "iy", "ix", "value",
        (F.col("t") / ct).cast("bigint").alias("kt"), (F.col("iy") / cy).cast("bigint").alias("ky"),
        (F.col("ix") / cx).cast("bigint").alias("kx"))

    def write_chunk(pdf):
        import pandas as pd
        var = pdf["variable"].iloc[0]
        kt, ky, kx = int(pdf["kt"].iloc[0]), int(pdf["ky"].iloc[0]), int(pdf["kx"].iloc[0])
        a = np.full(chunks, fill, dtype=np.dtype(dtype))
        a[(pdf["t"] - kt * ct).to_numpy(), (pdf["iy"] - ky * cy).to_numpy(), (pdf["ix"] - kx * cx).to_numpy()] = \
            pdf["value"].to_numpy(dtype="float64", na_value=np.nan)
        with open(f"{root}/{var}/{kt}.{ky}.{kx}", "wb") as fh:
            fh.write(compress(a.tobytes(order="C"), compressor))
        return pd.DataFrame({"variable": [var], "cells": [len(pdf)]})

    long.groupBy("variable", "kt", "ky", "kx").applyInPandas(write_chunk, "variable string, cells long").count()


def _put(path: str, data: bytes) -> None:
    store, p = file_system(path)
    store.create_dir(p.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(p) as f:
        f.write(data)


def write_archive(df: DataFrame, root: str, shape: tuple[int, int], axis: dict[str, list[int]], init_of, compressor: dict | None = None) -> None:
    """Write ``store, variable, t, iy, ix, value`` as one store per ``store`` below ``root``, by the executors.

    ``axis`` gives, by the store name's kind (``_anl`` or ``_fcst``), the hours after the run's start that the time
    axis holds; ``init_of(store)`` is that start. A group is one variable of one run, whatever the archive's size.
    """
    ship_package(df.sparkSession)
    ny, nx = shape

    def write_one(pdf):
        import pandas as pd
        store, var = pdf["store"].iloc[0], pdf["variable"].iloc[0]
        hours = next(v for k, v in axis.items() if f"_{k}." in store)
        base = {"zarr_format": 2, "compressor": compressor, "order": "C", "filters": None}
        a = np.full((len(hours), ny, nx), np.nan)
        a[pdf["t"], pdf["iy"], pdf["ix"]] = pdf["value"]
        meta = base | {"shape": list(a.shape), "chunks": list(a.shape), "dtype": "<f8", "fill_value": "NaN"}
        time = base | {"shape": [len(hours)], "chunks": [len(hours)], "dtype": "<i8", "fill_value": None, "compressor": None}
        for name, data in ((f"{var}/.zarray", json.dumps(meta).encode()), (f"{var}/0.0.0", compress(a.tobytes(), compressor)),
                           ("time/.zarray", json.dumps(time).encode()), ("time/.zattrs", json.dumps({"units": f"hours since {init_of(store)}"}).encode()),
                           ("time/0", np.asarray(hours, "<i8").tobytes())):
            _put(f"{root}/{store}/{name}", data)
        return pd.DataFrame({"store": [store]})

    df.groupBy("store", "variable").applyInPandas(write_one, "store string").count()
