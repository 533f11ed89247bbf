"""The polygon-container data source (S3, S4): one file is read by many tasks, in small Arrow batches.

``spark.read.format("catchflow_containers")`` lists the files once. Files are packed into partitions by size; a file
above ``SPLIT_BYTES`` on a mounted file system is split into row-id ranges, each read by its own task straight from the
file (SQLite touches only the pages it needs). A file on another file system is read whole by one task.

Pushed filters on the box columns (``xmin <= b and xmax >= a`` and so on) go to the container's own R-tree where it has
one, so features elsewhere are never decoded. Spark evaluates the filters again on the rows.

The coordinate system comes from the container's tables (``gpkg_geometry_columns``, ``gpkg_spatial_ref_sys``), else
from the blobs' own header.
"""

from __future__ import annotations

import fnmatch
import json
import sqlite3
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

NAME = "catchflow_containers"
SPLIT_BYTES = 64 << 20
BATCH_FEATURES = 1024
BATCH_VERTICES = 200_000
_PT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_RING = pa.struct([("part", pa.int32()), ("hole", pa.bool_()), ("pts", pa.list_(_PT))])
ARROW = pa.schema([("path", pa.string()), ("fid", pa.int64()), ("feature_id", pa.string()), ("rings", pa.list_(_RING)),
                   ("xmin", pa.float64()), ("ymin", pa.float64()), ("xmax", pa.float64()), ("ymax", pa.float64()),
                   ("crs", pa.string()), ("wkt", pa.string()), ("error", pa.string())])
SCHEMA = ("path string, fid bigint, feature_id string, rings array<struct<part:int,hole:boolean,pts:array<struct<x:double,y:double>>>>, "
          "xmin double, ymin double, xmax double, ymax double, crs string, wkt string, error string")


class ContainerSource(DataSource):
    """Options: ``paths`` (JSON list), ``glob``, ``layer``, ``id_col``, ``tolerant``, ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "ContainerReader":
        return ContainerReader(dict(self.options))


class Files(InputPartition):
    """(path, first row id, last row id) of each piece; None for a whole file."""

    def __init__(self, pieces: list[tuple[str, int | None, int | None]]):
        self.pieces = pieces


def _mounted(path: str) -> str | None:
    """The plain path on a mounted file system, None for other schemes."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return None if "://" in path else path


def open_container(path: str) -> sqlite3.Connection:
    plain = _mounted(path)
    if plain is not None:
        return sqlite3.connect(f"file:{plain.replace('%', '%25').replace('?', '%3f').replace('#', '%23')}?mode=ro&immutable=1", uri=True)
    from .chunks import read_bytes
    con = sqlite3.connect(":memory:")
    con.deserialize(read_bytes(path))
    return con


def list_containers(paths: list[str], glob: str, tolerant: bool) -> list[tuple[str, int]]:
    """(path, bytes) of the files below ``paths`` whose name fits."""
    from pyarrow import fs as pafs

    from .chunks import file_system
    out = []
    for path in paths:
        f, p = file_system(path)
        info = f.get_file_info(p)
        if info.type == pafs.FileType.NotFound:
            if tolerant:
                continue
            raise FileNotFoundError(f"no polygon containers at {path}")
        files = [info] if info.type == pafs.FileType.File else [i for i in f.get_file_info(pafs.FileSelector(p, recursive=True)) if i.type == pafs.FileType.File]
        scheme = path.split("://")[0] + "://" if "://" in path else ""
        out += [(scheme + i.path if scheme else i.path, i.size or 0) for i in files if fnmatch.fnmatch(i.base_name, glob)]
    return sorted(set(out))


class ContainerReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths, self.glob = json.loads(options["paths"]), options.get("glob", "*.gpkg")
        self.layer, self.id_col = options.get("layer", "divides"), options.get("id_col", "divide_id")
        self.tolerant, self.split = options.get("tolerant") == "true", int(options.get("split_bytes", SPLIT_BYTES))
        self.bounds: list[tuple[str, str, float]] = []  # (box column, operator, value)

    def pushFilters(self, filters: list[Filter]):
        ops = {GreaterThan: ">=", GreaterThanOrEqual: ">=", LessThan: "<=", LessThanOrEqual: "<="}
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in ("xmin", "ymin", "xmax", "ymax") and isinstance(getattr(f, "value", None), (int, float)):
                for op in (ops.get(type(f)),) if not isinstance(f, EqualTo) else (">=", "<="):
                    if op:
                        self.bounds.append((column, op, float(f.value)))
            yield f

    def partitions(self) -> list[InputPartition]:
        parts, held, size = [], [], 0
        for path, n in list_containers(self.paths, self.glob, self.tolerant):
            if n > self.split and _mounted(path) is not None:
                parts += [Files([(path, lo, hi)]) for lo, hi in self._ranges(path, -(-n // self.split))]
                continue
            held.append((path, None, None))
            size += n
            if size >= self.split:
                parts.append(Files(held))
                held, size = [], 0
        return parts + ([Files(held)] if held else [])

    def _ranges(self, path: str, pieces: int) -> list[tuple[int | None, int | None]]:
        try:
            con = open_container(path)
            lo, hi = con.execute(f'SELECT min(rowid), max(rowid) FROM "{self.layer}"').fetchone()
            con.close()
        except sqlite3.Error:
            return [(None, None)]  # its task says why
        if lo is None:
            return [(None, None)]
        step = -(-(hi - lo + 1) // pieces)
        return [(a, min(hi, a + step - 1)) for a in range(lo, hi + 1, step)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for path, lo, hi in partition.pieces if partition is not None else []:
            try:
                yield from self._file(path, lo, hi)
            except Exception as e:  # noqa: BLE001 - an error row where errors are asked for
                if not self.tolerant:
                    raise
                yield pa.RecordBatch.from_pylist([{"path": path, "error": f"{type(e).__name__}: {e}"}], schema=ARROW)

    def _file(self, path: str, lo: int | None, hi: int | None) -> Iterator[pa.RecordBatch]:
        from .containers import geometry_parts
        con = open_container(path)
        geom, crs, wkt = describe(con, self.layer)
        where, args = [], []
        if lo is not None:
            where.append("t.rowid BETWEEN ? AND ?")
            args += [lo, hi]
        tree = f"rtree_{self.layer}_{geom}"
        if self.bounds and con.execute("SELECT count(*) FROM sqlite_master WHERE name = ?", (tree,)).fetchone()[0]:
            names = {"xmin": "minx", "ymin": "miny", "xmax": "maxx", "ymax": "maxy"}
            inner = " AND ".join(f"{names[c]} {op} ?" for c, op, _ in self.bounds)
            where.append(f't.rowid IN (SELECT id FROM "{tree}" WHERE {inner})')
            # the tree holds single-precision boxes, rounded outwards
            args += [np.nextafter(np.float32(v), np.float32(np.inf if op == "<=" else -np.inf)).item() for _, op, v in self.bounds]
        sql = f'SELECT t.rowid, t."{self.id_col}", t."{geom}" FROM "{self.layer}" t' + (f" WHERE {' AND '.join(where)}" if where else "")
        held, vertices = [], 0
        for fid, ident, blob in con.execute(sql, args):
            srs, rings = geometry_parts(bytes(blob)) if blob is not None else (None, [])
            held.append((fid, None if ident is None else str(ident), rings, crs or (f"EPSG:{srs}" if srs and srs > 0 else None)))
            vertices += sum(len(r[2]) for r in rings)
            if len(held) >= BATCH_FEATURES or vertices >= BATCH_VERTICES:
                yield batch(path, held, wkt)
                held, vertices = [], 0
        if held:
            yield batch(path, held, wkt)
        con.close()


def describe(con: sqlite3.Connection, layer: str) -> tuple[str, str | None, str | None]:
    """(geometry column, system name, system WKT) as the container's own tables have them."""
    tables = {r[0] for r in con.execute("SELECT name FROM sqlite_master")}
    if "gpkg_geometry_columns" not in tables:
        return "geom", None, None
    row = con.execute("SELECT column_name, srs_id FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()
    if row is None:
        return "geom", None, None
    if "gpkg_spatial_ref_sys" not in tables:
        return row[0], None, None
    srs = con.execute("SELECT organization, organization_coordsys_id, definition FROM gpkg_spatial_ref_sys WHERE srs_id = ?", (row[1],)).fetchone()
    return (row[0], f"{srs[0].upper()}:{srs[1]}", srs[2]) if srs and srs[0] and srs[0].upper() != "NONE" else (row[0], None, None)


def batch(path: str, held: list, wkt: str | None) -> pa.RecordBatch:
    """Features (fid, id, [(part, hole, n x 2 vertices)], system) as one Arrow batch, built from offsets."""
    rings = [r for _, _, rs, _ in held for r in rs]
    xy = np.concatenate([r[2] for r in rings]) if rings else np.zeros((0, 2))
    pts = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=list(_PT))
    ring_at = np.append(0, np.cumsum([len(r[2]) for r in rings])).astype(np.int32)
    ring = pa.StructArray.from_arrays([pa.array([r[0] for r in rings], pa.int32()), pa.array([r[1] for r in rings], pa.bool_()),
                                       pa.ListArray.from_arrays(pa.array(ring_at), pts)], fields=list(_RING))
    at = np.append(0, np.cumsum([len(rs) for _, _, rs, _ in held])).astype(np.int32)
    boxes = [(np.concatenate([r[2] for r in rs]) if rs else np.zeros((0, 2))) for _, _, rs, _ in held]
    low = [b.min(0).tolist() if len(b) else [None, None] for b in boxes]
    high = [b.max(0).tolist() if len(b) else [None, None] for b in boxes]
    n = len(held)
    return pa.RecordBatch.from_arrays([
        pa.repeat(pa.scalar(path), n), pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.string()),
        pa.ListArray.from_arrays(pa.array(at), ring), *[pa.array([v[i] for v in box], pa.float64()) for box in (low, high) for i in (0, 1)],
        pa.array([h[3] for h in held], pa.string()), pa.repeat(pa.scalar(wkt, pa.string()), n), pa.nulls(n, pa.string())], schema=ARROW)
