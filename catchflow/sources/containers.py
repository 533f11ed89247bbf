"""Polygon containers (S3, S4): GeoPackage-style SQLite files decoded on the executors.

The scan goes through the data source of :mod:`container_source`: large files are split into row-id ranges, small ones
share tasks, and box filters use the file's R-tree. Geometry blobs (GeoPackage header + WKB Polygon / MultiPolygon, or
Point / MultiPoint for nexus and gage layers, as one-vertex rings) become the ring model
``array<struct<part, hole, pts array<struct<x, y>>>>``. An unreadable file yields an error row (``tolerant=True``)
instead of failing the job.
"""

from __future__ import annotations

import json
import sqlite3
import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .container_source import ContainerSource

_ENVELOPE_BYTES = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}


# ---------------------------------------------------------------- WKB

def _wkb_rings(buf: bytes, off: int, part: int, out: list) -> tuple[int, int]:
    """Decode one WKB geometry at ``off``; append (part, hole, n x 2 vertices); return (new offset, next part number)."""
    bo = "<" if buf[off] == 1 else ">"
    gtype = struct.unpack_from(bo + "I", buf, off + 1)[0]
    off += 5
    code = gtype & 0x0FFFFFFF
    iso = code // 1000  # ISO WKB: 1 = Z, 2 = M, 3 = ZM
    has_z = bool(gtype & 0x80000000) or iso in (1, 3)
    has_m = bool(gtype & 0x40000000) or iso in (2, 3)
    base = code % 1000
    dims = 2 + int(has_z) + int(has_m)

    def vertices(n: int) -> np.ndarray:
        return np.frombuffer(buf, bo + "f8", n * dims, off).reshape(n, dims)[:, :2].astype(float)

    if base == 1:  # Point: a one-vertex ring (nexus and gage locations)
        out.append((part, False, vertices(1)))
        return off + 8 * dims, part + 1
    if base in (4, 6):  # MultiPoint, MultiPolygon
        n = struct.unpack_from(bo + "I", buf, off)[0]
        off += 4
        for _ in range(n):
            off, part = _wkb_rings(buf, off, part, out)
        return off, part
    if base == 3:  # Polygon
        nrings = struct.unpack_from(bo + "I", buf, off)[0]
        off += 4
        for r in range(nrings):
            npts = struct.unpack_from(bo + "I", buf, off)[0]
            off += 4
            out.append((part, r > 0, vertices(npts)))
            off += 8 * npts * dims
        return off, part + 1
    raise ValueError(f"unsupported WKB geometry type {gtype}")


def geometry_parts(blob: bytes) -> tuple[int | None, list]:
    """GeoPackage geometry blob (or bare WKB) -> (its srs id, [(part, hole, vertices)])."""
    off, srs = 0, None
    if blob[:2] == b"GP":
        flags = blob[3]
        srs = struct.unpack_from("<i" if flags & 1 else ">i", blob, 4)[0]
        off = 8 + _ENVELOPE_BYTES[(flags >> 1) & 0x07]
    rings: list = []
    _wkb_rings(blob, off, 0, rings)
    return srs, rings


def decode_geometry(blob: bytes) -> list[dict]:
    """GeoPackage geometry blob (or bare WKB) -> rings as dicts."""
    return [{"part": p, "hole": h, "pts": [{"x": x, "y": y} for x, y in v.tolist()]} for p, h, v in geometry_parts(blob)[1]]


def _wkb_polygon(rings: list[dict]) -> bytes:
    body = struct.pack("<BII", 1, 3, len(rings))
    for r in rings:
        body += struct.pack("<I", len(r["pts"]))
        body += b"".join(struct.pack("<dd", p["x"], p["y"]) for p in r["pts"])
    return body


def encode_point(x: float, y: float, srs_id: int = 4326) -> bytes:
    """A point -> GeoPackage blob with a WKB Point (no envelope)."""
    return b"GP" + bytes([0, 1]) + struct.pack("<i", srs_id) + struct.pack("<BIdd", 1, 1, x, y)


def encode_polygon(rings: list[dict], srs_id: int = 4326) -> bytes:
    """Rings -> GeoPackage blob (no envelope): a WKB Polygon for one part, a MultiPolygon for several.

    Within a part the outer ring comes first, then its holes (``hole`` flags order them).
    """
    parts: dict[int, list[dict]] = {}
    for r in rings:
        parts.setdefault(int(r.get("part") or 0), []).append(r)
    polys = [sorted(rs, key=lambda r: bool(r.get("hole"))) for _, rs in sorted(parts.items())]
    if len(polys) == 1:
        body = _wkb_polygon(polys[0])
    else:
        body = struct.pack("<BII", 1, 6, len(polys)) + b"".join(_wkb_polygon(p) for p in polys)
    return b"GP" + bytes([0, 1]) + struct.pack("<i", srs_id) + body


# ---------------------------------------------------------------- scan

def scan_divides(spark: SparkSession, paths: str | list[str], layer: str = "divides", id_col: str = "divide_id",
                 glob: str = "*.gpkg", tolerant: bool = False, basin_pattern: str = r"([^/]+)\.gpkg$",
                 with_errors: bool = False, with_crs: bool = False, extent: tuple[float, float, float, float] | None = None,
                 split_bytes: int | None = None) -> DataFrame:
    """S3/S4 + P11: every container under ``paths`` in one job; any ``id_col`` becomes ``divide_id``.

    ``basin_id`` is parsed from the file name. With ``tolerant`` unreadable files become error rows
    (kept only with ``with_errors``) and missing folders list nothing; without it both are errors. ``with_crs`` adds the
    features' coordinate system (``crs``, ``wkt``). ``extent`` (xmin, ymin, xmax, ymax, in the containers' own system)
    keeps the features whose box meets it, and reaches the files' R-trees.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ContainerSource)
    options = {"paths": json.dumps([paths] if isinstance(paths, str) else list(paths)), "glob": glob, "layer": layer, "id_col": id_col,
               "tolerant": str(tolerant).lower()} | ({"split_bytes": str(split_bytes)} if split_bytes else {})
    dec = spark.read.format(ContainerSource.name()).options(**options).load()
    if extent is not None:
        x0, y0, x1, y1 = (float(v) for v in extent)
        dec = dec.where((F.col("xmax") >= x0) & (F.col("xmin") <= x1) & (F.col("ymax") >= y0) & (F.col("ymin") <= y1))
    dec = dec.withColumn("basin_id", F.regexp_extract("path", basin_pattern, 1))
    if with_errors:
        return dec
    return dec.where(F.col("error").isNull()).select("basin_id", F.col("feature_id").alias("divide_id"), "rings", *(["crs", "wkt"] if with_crs else []))


def container_errors(spark: SparkSession, paths: str | list[str], **kw) -> DataFrame:
    """S4 report: files that could not be read and why."""
    return (scan_divides(spark, paths, tolerant=True, with_errors=True, **kw)
            .where(F.col("error").isNotNull()).select("path", "error"))


# ---------------------------------------------------------------- write (fixture / export side)

def write_divides(divides: DataFrame, root: str, layer: str = "divides", id_col: str = "divide_id",
                  file_col: str = "basin_id", srs: str | None = None, wkt: str = "undefined", rtree: bool = False) -> None:
    """One container per ``file_col`` value (``<value>.gpkg``), written by the executors.

    ``srs`` (such as ``EPSG:5070``) and ``wkt`` go into the container's tables; ``rtree`` adds the box index. A group is
    one basin's polygons (bounded by the basin, not by the archive).
    """
    import os
    ship_package(divides.sparkSession)
    os.makedirs(root, exist_ok=True)
    organization, _, code = (srs or "EPSG:4326").partition(":")
    srs_id = int(code) if code.isdigit() else 100_000

    def write_one(pdf):
        import pandas as pd
        name = str(pdf[file_col].iloc[0])
        con = sqlite3.connect(":memory:")
        con.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, "{id_col}" TEXT, geom BLOB)')
        if srs:
            con.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT, description TEXT)")
            con.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, ?, NULL)", (srs, srs_id, organization, srs_id, wkt))
            con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z TINYINT, m TINYINT)")
            con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', ?, 0, 0)", (layer, srs_id))
        if rtree:
            con.execute(f'CREATE VIRTUAL TABLE "rtree_{layer}_geom" USING rtree(id, minx, maxx, miny, maxy)')
        for i, (ident, rings) in enumerate(zip(pdf[id_col], pdf["rings"])):
            rl = None if rings is None else [{"part": r["part"], "hole": r["hole"], "pts": [{"x": p["x"], "y": p["y"]} for p in r["pts"]]} for r in rings]
            con.execute(f'INSERT INTO "{layer}" VALUES (?, ?, ?)', (i + 1, ident, encode_polygon(rl, srs_id) if rl is not None else None))
            pts = [p for r in rl or [] for p in r["pts"]]
            if rtree and pts:
                xs, ys = [p["x"] for p in pts], [p["y"] for p in pts]
                con.execute(f'INSERT INTO "rtree_{layer}_geom" VALUES (?, ?, ?, ?, ?)', (i + 1, min(xs), max(xs), min(ys), max(ys)))
        con.commit()
        with open(f"{root}/{name}.gpkg", "wb") as fh:
            fh.write(con.serialize())
        con.close()
        return pd.DataFrame({"file": [name], "n": [len(pdf)]})

    (divides.select(file_col, id_col, "rings").groupBy(file_col)
        .applyInPandas(write_one, "file string, n long").count())
