"""Polygon x grid overlay: exact coverage fractions, extents, nearest fill, nested/flat forms.

The overlay is edge-wise (Green's theorem): polygons become rows of edges, edges are cut at the grid's row and
column lines, and each piece adds its signed area to the cell it lies in and its height to all cells right of it. Sums
by (polygon, row) give the cells on the boundary, and the running height along a row gives the full and empty cells
between them. Work follows the boundary's length and the area, no polygon is copied per strip or cell, and one huge
polygon's edges and rows spread over tasks. All of it is Catalyst expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..schemas import Grid
from ..session import written
from . import nearest

# Coverage below this is floating-point dust from clipping along a cell edge.
COVERAGE_EPS = 1e-12


def _seq_or_empty(lo, hi):
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))


def total_bounds(divides: DataFrame, by: str | list[str] = "basin_id") -> DataFrame:
    """min/max over all vertices per group (partial aggregation, skew safe)."""
    by = [by] if isinstance(by, str) else by
    b = divides.select(*by, geo.bbox(F.col("rings")).alias("bb"))
    return b.groupBy(*by).agg(F.min("bb.xmin").alias("xmin"), F.min("bb.ymin").alias("ymin"),
                              F.max("bb.xmax").alias("xmax"), F.max("bb.ymax").alias("ymax"))


def cells_in_extent(bounds: DataFrame, grid: Grid, expand: int = 0, auto_expand: bool = True) -> DataFrame:
    """Per group, the index ranges of cells whose centre lies in the bounds (inclusive).

    ``expand`` widens the bounds by that many cells. With ``auto_expand`` a range with fewer than two
    cells on an axis is widened by one cell on both sides (a slice that thin cannot define a cell size).
    Output keeps the bounds columns and adds ``iy_lo, iy_hi, ix_lo, ix_hi`` (clamped to the grid).
    """
    def rng(lo, hi, o, d, n):
        a = F.ceil((lo - F.lit(expand * d) - F.lit(o)) / F.lit(d) - F.lit(0.5))
        b = F.floor((hi + F.lit(expand * d) - F.lit(o)) / F.lit(d) - F.lit(0.5))
        if auto_expand:
            thin = (b - a + 1) < 2
            a = F.when(thin, a - 1).otherwise(a)
            b = F.when(thin, b + 1).otherwise(b)
        return F.greatest(a, F.lit(0)).cast("bigint"), F.least(b, F.lit(n - 1)).cast("bigint")

    iy_lo, iy_hi = rng(F.col("ymin"), F.col("ymax"), grid.y0, grid.dy, grid.ny)
    ix_lo, ix_hi = rng(F.col("xmin"), F.col("xmax"), grid.x0, grid.dx, grid.nx)
    return bounds.select("*", iy_lo.alias("iy_lo"), iy_hi.alias("iy_hi"), ix_lo.alias("ix_lo"), ix_hi.alias("ix_hi"))


def extent_cells(bounds: DataFrame, grid: Grid, by: str = "basin_id", expand: int = 0,
                 auto_expand: bool = True) -> DataFrame:
    """The (by, iy, ix) cells of :func:`cells_in_extent`, one row each."""
    r = cells_in_extent(bounds, grid, expand, auto_expand)
    return (r.select(by, F.explode(_seq_or_empty(F.col("iy_lo"), F.col("iy_hi"))).alias("iy"), "ix_lo", "ix_hi")
             .select(by, "iy", F.explode(_seq_or_empty(F.col("ix_lo"), F.col("ix_hi"))).alias("ix")))


def coverage(divides: DataFrame, grid: Grid, cells: str = "centre", expand: int = 0,
             id_col: str = "divide_id", auto_expand: bool = True) -> DataFrame:
    """J2 + G1: exact fraction of each grid cell covered by each polygon.

    ``cells='centre'`` keeps only cells whose centre lies within the bounds of the polygon's basin (the
    slice the reference overlays on); ``cells='touch'`` keeps every cell the polygon touches.
    Output: ``basin_id, divide_id, cell_id, iy, ix, coverage`` with global grid indices.
    """
    d = divides.select(F.col("basin_id"), F.col(id_col).alias("divide_id"), "rings")
    if cells == "centre":
        ext = cells_in_extent(total_bounds(divides, "basin_id"), grid, expand, auto_expand)
        d = d.join(ext.select("basin_id", "iy_lo", "iy_hi", "ix_lo", "ix_hi"), "basin_id")
    elif cells != "touch":
        raise ValueError(f"cells must be 'touch' or 'centre', not {cells!r}")
    else:
        d = d.select("*", *[F.lit(v).cast("bigint").alias(k) for k, v in (("iy_lo", 0), ("iy_hi", grid.ny - 1), ("ix_lo", 0), ("ix_hi", grid.nx - 1))])
    key = ["basin_id", "divide_id", "iy"]

    # edges, then their pieces in each row
    rings = d.select("basin_id", "divide_id", "iy_lo", "iy_hi", "ix_lo", "ix_hi", F.explode(geo.oriented_edges(F.col("rings"))).alias("r"))
    edges = rings.select("basin_id", "divide_id", "iy_lo", "iy_hi", "ix_lo", "ix_hi", F.col("r.sign").alias("sign"), F.inline("r.e")).where("ay <> by")
    y_line = F.lit(grid.y0) + F.col("iy") * F.lit(grid.dy)
    rows = _pieces(edges, "ay", "by", grid.y0, grid.dy, "iy", F.col("iy_lo"), F.col("iy_hi"))
    ya, yb = _held(F.col("ay"), y_line, grid.dy, "iy"), _held(F.col("by"), y_line, grid.dy, "iy")
    slope_x = (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    rows = (rows.withColumn("ya", ya).withColumn("yb", yb).where("ya <> yb")
            .select(*key, "ix_lo", "ix_hi", "sign", "ya", "yb",
                    F.when(F.col("ya") == F.col("ay"), F.col("ax")).otherwise(F.col("ax") + (F.col("ya") - F.col("ay")) * slope_x).alias("xa"),
                    F.when(F.col("yb") == F.col("by"), F.col("bx")).otherwise(F.col("ax") + (F.col("yb") - F.col("ay")) * slope_x).alias("xb")))
    # the rows' pieces in each column; what lies left of the range is one piece in the column before it
    x_line = F.lit(grid.x0) + F.col("ix") * F.lit(grid.dx)
    cols = _pieces(rows, "xa", "xb", grid.x0, grid.dx, "ix", F.col("ix_lo") - 1, F.col("ix_hi"), keep_left=True)
    u, v = _held(F.col("xa"), x_line, grid.dx, "ix"), _held(F.col("xb"), x_line, grid.dx, "ix")

    def height(x: str, end: str, y: str):
        steep = (F.col("yb") - F.col("ya")) / (F.col("xb") - F.col("xa"))  # only where a column line lies between the two
        return F.when(F.col(x) == F.col(end), F.col(y)).otherwise(F.col("ya") + (F.col(x) - F.col("xa")) * steep)
    cols = cols.withColumn("u", u).withColumn("v", v)
    tall = F.col("sign") * (height("v", "xb", "yb") - height("u", "xa", "ya"))
    right = F.lit(grid.x0) + (F.col("ix") + 1) * F.lit(grid.dx)
    part = cols.select(*key, "ix", "ix_lo", "ix_hi", tall.alias("tall"), (right - (F.col("u") + F.col("v")) / 2).alias("wide"))
    # per cell of the boundary, then along the row
    sums = (part.repartition(*key).groupBy(*key, "ix").agg(F.sum(F.col("tall") * F.col("wide")).alias("area"), F.sum("tall").alias("tall"),
                                                          F.first("ix_lo").alias("ix_lo"), F.first("ix_hi").alias("ix_hi")))
    along = Window.partitionBy(*key).orderBy("ix")
    sums = sums.select("*", F.sum("tall").over(along).alias("run"), F.lead("ix").over(along).alias("next"))
    own = F.struct(F.col("ix"), ((F.col("area") + (F.col("run") - F.col("tall")) * F.lit(grid.dx)) / F.lit(grid.cell_area)).alias("coverage"))
    full = F.col("run") / F.lit(grid.dy)
    between = F.when(full > COVERAGE_EPS, F.transform(_seq_or_empty(F.col("ix") + 1, F.coalesce(F.col("next"), F.col("ix_hi") + 1) - 1),
                                                      lambda i: F.struct(i.alias("ix"), full.alias("coverage"))))
    found = F.filter(F.concat(F.array(own), F.coalesce(between, F.array().cast("array<struct<ix:bigint,coverage:double>>"))),
                     lambda c: (c["coverage"] > COVERAGE_EPS) & (c["ix"] >= F.col("ix_lo")))
    out = sums.select(*key, F.inline(found))
    return out.select("basin_id", "divide_id", (F.col("iy") * grid.nx + F.col("ix")).alias("cell_id"),
                      "iy", "ix", F.least("coverage", F.lit(1.0)).alias("coverage"))


def _pieces(df: DataFrame, a: str, b: str, origin: float, step: float, name: str, lo, hi, keep_left: bool = False) -> DataFrame:
    """One row for each grid interval ``name`` that the span ``a .. b`` meets within ``lo .. hi``, with ``_first`` and
    ``_last``: whether the interval is the span's first or last one, so that no part of the span is lost to rounding.
    With ``keep_left``, everything before ``lo`` counts as being in ``lo``."""
    low = F.floor((F.least(a, b) - F.lit(origin)) / F.lit(step)).cast("bigint")
    high = F.greatest(low, (F.ceil((F.greatest(a, b) - F.lit(origin)) / F.lit(step)) - 1).cast("bigint"))
    spans = df.select("*", low.alias("_low"), high.alias("_high"))
    if keep_left:
        spans = spans.withColumn("_high", F.greatest("_high", lo)).withColumn("_low", F.greatest("_low", lo))
    out = spans.select("*", F.explode(_seq_or_empty(F.greatest(F.col("_low"), lo), F.least(F.col("_high"), hi))).alias(name))
    return out.withColumn("_first", F.col(name) == F.col("_low")).withColumn("_last", F.col(name) == F.col("_high")).drop("_low", "_high")


def _held(v, line, step: float, name: str):
    """A span's end held within its interval, but for the outer side of the first and last one."""
    at_least = F.when(F.col("_first"), v).otherwise(F.greatest(v, line))
    return F.when(F.col("_last"), at_least).otherwise(F.least(at_least, line + F.lit(step)))


def unravel(cell_id, nx: int):
    """Row-major flat cell id -> (row, column)."""
    return (F.floor(cell_id / F.lit(nx)).cast("bigint")).alias("iy"), F.pmod(cell_id, F.lit(nx)).cast("bigint").alias("ix")


def to_nested(cov: DataFrame) -> DataFrame:
    """R1 (pack): one row per (basin, feature) with ``cells: array<struct<cell_id, coverage>>`` sorted by cell id."""
    return cov.groupBy("basin_id", "divide_id").agg(
        F.sort_array(F.collect_list(F.struct("cell_id", "coverage"))).alias("cells"))


def nested_coverage(divides: DataFrame, cov: DataFrame, id_col: str = "divide_id") -> DataFrame:
    """R1 (pack) for every feature: features without any cell get an empty array (see R2)."""
    n = to_nested(cov)
    feats = divides.select(F.col(id_col).alias("divide_id"), "basin_id")
    empty = F.array().cast("array<struct<cell_id:bigint,coverage:double>>")
    return feats.join(n, ["basin_id", "divide_id"], "left").select("basin_id", "divide_id", F.coalesce("cells", empty).alias("cells"))


def flatten_coverage(nested: DataFrame, nx: int, basin_id: str | None = None) -> DataFrame:
    """R1 (unpack) + G6: nested per-feature arrays -> flat rows with global (iy, ix)."""
    e = nested.select(*([F.col("basin_id")] if "basin_id" in nested.columns else []), "divide_id",
                      F.explode("cells").alias("c"))
    iy, ix = unravel(F.col("c.cell_id"), nx)
    if "basin_id" not in nested.columns:
        e = e.withColumn("basin_id", F.lit(basin_id).cast("string"))
    return e.select("basin_id", "divide_id", F.col("c.cell_id").alias("cell_id"), iy, ix,
                    F.col("c.coverage").alias("coverage"))


def without_cells(nested: DataFrame) -> DataFrame:
    """R2: features whose cell array is empty."""
    return nested.filter(F.size("cells") == 0)


def nearest_sources(divides: DataFrame, cov: DataFrame) -> DataFrame:
    """J3 + G2 + W2: for each (basin, feature) without cells, the nearest one with cells (see :mod:`nearest`).

    Output: ``basin_id, divide_id`` (missing), ``source_basin, source_id``, ``dist``. Features without geometry have
    no place and no answer: :func:`without_geometry` names them.
    """
    has = cov.select("basin_id", "divide_id").distinct().withColumn("_has", F.lit(True))
    feats = written(divides.select("basin_id", "divide_id", "rings").join(has, ["basin_id", "divide_id"], "left"), "nearest-features")
    return nearest.nearest(feats.where("_has IS NULL"), feats.where("_has"))


def without_geometry(divides: DataFrame) -> DataFrame:
    """Features with null or empty rings: they have neither cells nor a nearest feature."""
    return divides.where(~nearest.has_geometry("rings")).select("basin_id", "divide_id")


def fill_nearest(cov: DataFrame, divides: DataFrame) -> DataFrame:
    """Features without cells copy the cells of their nearest covered feature."""
    cov = written(cov, "coverage")  # used by the search and by the copy below
    copied = (nearest_sources(divides, cov)
              .join(cov.select(F.col("basin_id").alias("source_basin"), F.col("divide_id").alias("source_id"), "cell_id", "iy", "ix", "coverage"),
                    ["source_basin", "source_id"])
              .select("basin_id", "divide_id", "cell_id", "iy", "ix", "coverage"))
    return cov.unionByName(copied)
