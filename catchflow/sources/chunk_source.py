"""The chunk-store data source (S1, S2 with P1 inside): pushed ranges decide which chunks are opened.

``spark.read.format("catchflow_chunks")`` plans partitions from array metadata alone. Filters on ``iy``, ``ix``,
``time``, ``variable`` and ``store`` that Spark pushes become index ranges; a chunk outside them is never opened, and
of an opened chunk only the wanted box is turned into rows. Spark still evaluates every filter on the rows, so the
pruning can't change a result.

Two ways to plan, by how metadata and data relate:

* ``stores`` (a list of store roots, a few large yearly stores): the array metadata is read while planning and the
  chunks of the wanted box are dealt into partitions of about ``TARGET_CELLS`` cells, at most ``MAX_PARTITIONS``.
* ``archive`` (a folder with one small store for each run): planning lists the folder only; a partition is a run of
  stores, whose metadata its task reads.

A chunk file that isn't there holds nothing but the fill value and gives no rows.
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

NAME = "catchflow_chunks"
TARGET_CELLS = 4_000_000
MAX_PARTITIONS = 20_000
STORES_A_TASK = 16
BATCH_ROWS = 65_536
CORE = "time timestamp_ntz, iy bigint, ix bigint, variable string, value double"
DETAIL = CORE + ", store string, path string, error string"
_CORE_ARROW = [("time", pa.timestamp("us")), ("iy", pa.int64()), ("ix", pa.int64()), ("variable", pa.string()), ("value", pa.float64())]
_DETAIL_ARROW = _CORE_ARROW + [("store", pa.string()), ("path", pa.string()), ("error", pa.string())]
_EPOCH = dt.datetime(1970, 1, 1)


class ChunkSource(DataSource):
    """Options: ``stores`` (JSON list) or ``archive`` (a folder), ``variables`` (JSON list), ``detail``, ``tolerant``,
    ``drop_fill``, ``box`` (JSON: first and last row, first and last column; leaves error rows, as no filter on rows can)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return DETAIL if self.options.get("detail") == "true" else CORE

    def reader(self, schema) -> "ChunkReader":
        return ChunkReader(dict(self.options))


class Piece:
    """Chunks ``first .. last - 1`` in row-major order of a box of chunk indices of one array."""

    def __init__(self, store: str, variable: str, lo: list[int], hi: list[int], first: int, last: int):
        self.store, self.variable, self.lo, self.hi, self.first, self.last = store, variable, lo, hi, first, last

    def keys(self) -> Iterator[tuple[int, ...]]:
        box = itertools.product(*[range(a, b) for a, b in zip(self.lo, self.hi)])
        return itertools.islice(box, self.first, self.last)


class Pieces(InputPartition):
    """Pieces of arrays whose metadata was read while planning, or whole stores whose metadata wasn't."""

    def __init__(self, pieces: list[Piece], stores: list[str] = ()):
        self.pieces, self.stores = pieces, list(stores)


class Ranges:
    """What the pushed filters leave: inclusive ranges of numbers and sets of names; None where nothing is said."""

    def __init__(self):
        self.low: dict[str, int] = {}
        self.high: dict[str, int] = {}
        self.names: dict[str, set[str]] = {}

    def take(self, f: Filter) -> None:
        column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        if column in ("iy", "ix", "time"):
            if isinstance(f, In):
                values = [v for v in map(_number, f.value) if v is not None]
                if values:
                    self._raise(column, min(values))
                    self._lower(column, max(values))
                return
            v = _number(getattr(f, "value", None))
            if v is None:
                return
            if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo, EqualNullSafe)):
                self._raise(column, v + isinstance(f, GreaterThan))
            if isinstance(f, (LessThan, LessThanOrEqual, EqualTo, EqualNullSafe)):
                self._lower(column, v - isinstance(f, LessThan))
        elif column in ("variable", "store") and isinstance(f, (EqualTo, EqualNullSafe, In)):
            said = set(f.value) if isinstance(f, In) else {f.value}
            self.names[column] = said & self.names.get(column, said)

    def _raise(self, column: str, v: int) -> None:
        self.low[column] = max(v, self.low.get(column, v))

    def _lower(self, column: str, v: int) -> None:
        self.high[column] = min(v, self.high.get(column, v))

    def inside(self, column: str, values: np.ndarray) -> np.ndarray:
        ok = np.ones(len(values), bool)
        if column in self.low:
            ok &= values >= self.low[column]
        if column in self.high:
            ok &= values <= self.high[column]
        return ok

    def has(self, column: str, name: str) -> bool:
        return column not in self.names or name in self.names[column]


def _number(v) -> int | None:
    """Whole numbers as they are, times as microseconds since 1970; None for what can't be told."""
    if isinstance(v, bool):
        return None
    if isinstance(v, dt.datetime):
        return (v.replace(tzinfo=None) - _EPOCH) // dt.timedelta(microseconds=1) if v.tzinfo is None or v.utcoffset() == dt.timedelta(0) else None
    return int(v) if isinstance(v, int) else None


class ChunkReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.archive = options.get("archive")
        self.stores = json.loads(options.get("stores", "[]"))
        self.variables = json.loads(options["variables"])
        self.tolerant, self.drop_fill = options.get("tolerant") == "true", options.get("drop_fill") == "true"
        self.arrow = pa.schema(_DETAIL_ARROW if options.get("detail") == "true" else _CORE_ARROW)
        self.target = int(options.get("target_cells", TARGET_CELLS))
        self.ranges = Ranges()
        if "box" in options:
            y0, y1, x0, x1 = json.loads(options["box"])
            self.ranges.low |= {"iy": y0, "ix": x0}
            self.ranges.high |= {"iy": y1, "ix": x1}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            self.ranges.take(f)
            yield f  # Spark checks the rows as well

    # ------------------------------------------------------------ planning

    def _wanted(self, axis: int, meta: dict, times: np.ndarray) -> np.ndarray:
        """Which indices of an axis the ranges leave. The first axis is time, the last two are iy and ix."""
        n, dims = meta["shape"][axis], len(meta["shape"])
        ok = np.ones(n, bool)
        if axis == 0:
            ok &= self.ranges.inside("time", times[:n])
        if dims >= 2 and axis == dims - 2:
            ok &= self.ranges.inside("iy", np.arange(n))
        if dims >= 2 and axis == dims - 1:
            ok &= self.ranges.inside("ix", np.arange(n))
        return ok

    def _box(self, meta: dict, times: np.ndarray) -> tuple[list[int], list[int]] | None:
        """Chunk indices from, to (exclusive) on each axis; None where nothing is wanted."""
        lo, hi = [], []
        for axis, size in enumerate(meta["chunks"]):
            at = np.flatnonzero(self._wanted(axis, meta, times)) // size
            if not len(at):
                return None
            lo.append(int(at[0]))
            hi.append(int(at[-1]) + 1)
        return lo, hi

    def partitions(self) -> list[InputPartition]:
        from .chunks import list_stores, read_meta, read_times
        variables = [v for v in self.variables if self.ranges.has("variable", v)]
        if self.archive is not None:
            stores = [s for s in list_stores(self.archive) if self.ranges.has("store", s)]
            per = max(STORES_A_TASK, -(-len(stores) // MAX_PARTITIONS))
            return [Pieces([], stores[i:i + per]) for i in range(0, len(stores), per)] if variables else []
        arrays = [(s, v) for s in self.stores for v in variables if self.ranges.has("store", s)]

        def look(array):
            store, variable = array
            try:
                meta = read_meta(f"{store}/{variable}")
                box = self._box(meta, read_times(store))
            except FileNotFoundError:
                if self.tolerant:
                    return None  # a store or variable that isn't there
                raise
            except Exception:  # noqa: BLE001 - its task says why, as a failure or as an error row
                return store, variable, None, 0
            return (store, variable, box, int(np.prod(meta["chunks"]))) if box else None

        with ThreadPoolExecutor(16) as pool:
            found = [a for a in pool.map(look, arrays) if a]
        cells = sum(c * int(np.prod([b - a for a, b in zip(*box)])) for _, _, box, c in found if box)
        target = max(self.target, -(-cells // MAX_PARTITIONS))
        parts, held, size = [], [], 0
        for store, variable, box, per in found:
            if box is None:
                parts.append(Pieces([Piece(store, variable, [], [], 0, 0)]))
                continue
            lo, hi = box
            n, at = int(np.prod([b - a for a, b in zip(lo, hi)])), 0
            while at < n:
                take = min(n - at, max(1, (target - size) // per))
                held.append(Piece(store, variable, lo, hi, at, at + take))
                at, size = at + take, size + take * per
                if size >= target:
                    parts.append(Pieces(held))
                    held, size = [], 0
        if held:
            parts.append(Pieces(held))
        return parts

    # ------------------------------------------------------------ reading

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        metas: dict[str, tuple[dict, np.ndarray]] = {}
        for piece in partition.pieces:
            yield from self._array(piece.store, piece.variable, piece, metas)
        for store in partition.stores:
            for variable in self.variables:
                if self.ranges.has("variable", variable):
                    yield from self._array(store, variable, None, metas)

    def _array(self, store: str, variable: str, piece: Piece | None, metas: dict) -> Iterator[pa.RecordBatch]:
        from .chunks import folder_there, read_meta, read_times
        folder = f"{store}/{variable}"
        if piece is None and not folder_there(folder):
            return  # this run doesn't have the variable
        try:
            if folder not in metas:
                if store not in metas:
                    metas[store] = read_times(store)
                metas[folder] = read_meta(folder)
            meta, times = metas[folder], metas[store]
            box = self._box(meta, times)
        except Exception as e:  # noqa: BLE001 - an error row where errors are asked for
            yield from self._failed(store, variable, folder, e)
            return
        if box is None:
            return
        whole = piece is None or not piece.hi
        keys = itertools.product(*[range(a, b) for a, b in zip(*box)]) if whole else piece.keys()
        wanted = [self._wanted(axis, meta, times) for axis in range(len(meta["shape"]))]
        for key in keys:
            yield from self._chunk(store, variable, f"{folder}/{'.'.join(map(str, key))}", key, meta, times, wanted)

    def _chunk(self, store, variable, path, key, meta, times, wanted) -> Iterator[pa.RecordBatch]:
        from .chunks import decode_chunk, read_bytes
        lo = [k * c for k, c in zip(key, meta["chunks"])]
        pick = [np.flatnonzero(w[a:a + c]) for w, a, c in zip(wanted, lo, meta["chunks"])]
        if not all(len(p) for p in pick):
            return
        try:
            content = read_bytes(path)
        except FileNotFoundError:
            return
        try:
            values = decode_chunk(content, key, meta)[np.ix_(*pick)]
        except Exception as e:  # noqa: BLE001
            yield from self._failed(store, variable, path, e)
            return
        axes = [p + a for p, a in zip(pick, lo)]
        per = max(1, values[0].size)
        step = max(1, BATCH_ROWS // per)
        for at in range(0, len(axes[0]), step):  # a few time steps at a time: batches stay small whatever the chunk
            part = values[at:at + step]
            grids = np.meshgrid(axes[0][at:at + step], *axes[1:], indexing="ij")
            t = grids[0].ravel()
            iy, ix = (grids[-2].ravel(), grids[-1].ravel()) if len(grids) >= 2 else (np.zeros_like(t), np.zeros_like(t))
            flat = part.ravel()
            if self.drop_fill:
                keep = ~np.isnan(flat)
                t, iy, ix, flat = t[keep], iy[keep], ix[keep], flat[keep]
            n = len(flat)
            columns = {"time": pa.array(times[t], pa.int64()).cast(pa.timestamp("us")), "iy": pa.array(iy, pa.int64()), "ix": pa.array(ix, pa.int64()),
                       "variable": pa.repeat(pa.scalar(variable), n), "value": pa.array(flat, pa.float64(), from_pandas=True)}
            if "path" in self.arrow.names:
                columns |= {"store": pa.repeat(pa.scalar(store), n), "path": pa.repeat(pa.scalar(path), n), "error": pa.nulls(n, pa.string())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in self.arrow.names], schema=self.arrow)

    def _failed(self, store: str, variable: str, path: str, e: Exception) -> Iterator[pa.RecordBatch]:
        if not self.tolerant:
            raise ValueError(f"{path}: {type(e).__name__}: {e}") from e
        if "error" in self.arrow.names:
            row = {"time": None, "iy": None, "ix": None, "variable": variable, "value": None, "store": store, "path": path, "error": f"{type(e).__name__}: {e}"}
            yield pa.RecordBatch.from_pylist([row], schema=self.arrow)
