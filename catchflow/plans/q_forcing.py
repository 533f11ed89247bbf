"""Queries: grid -> catchment -> basin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..operators import coverage as cov
from ..operators import forcing, pack
from ..schemas import Grid
from . import sql_views as V
from . import views
from .registry import r9, register

G = views.GRID


def rect_coverage(spark, sf):
    return cov.coverage(views.divides(spark, sf), G, cells="touch")


@register("coverage_fraction", sql=V.with_(V.BOXES, V.GRID10, V.RECT_COV) + """
SELECT basin_id, divide_id, cell_id, iy, ix, round(coverage, 9) AS coverage FROM rect_cov""")
def coverage_fraction(spark, sf):
    c = rect_coverage(spark, sf)
    return c.select("basin_id", "divide_id", "cell_id", "iy", "ix", r9("coverage", "coverage"))


@register("coverage_triangle_area", sql=V.with_(V.BOXES) + """
SELECT divide_id, round((x1 - x0) * (y1 - y0) / 2, 9) AS area FROM boxes""")
def coverage_triangle_area(spark, sf):
    c = cov.coverage(views.divides(spark, sf, "tri"), G, cells="touch")
    return c.groupBy("divide_id").agg(r9(F.sum("coverage") * G.cell_area, "area"))


_EXTENT_SQL = """,
bounds AS (SELECT basin_id, min(x0) AS xmin, min(y0) AS ymin, max(x1) AS xmax, max(y1) AS ymax FROM boxes GROUP BY 1),
r0 AS (SELECT basin_id,
         CAST(ceil(ymin - {e} - 0.5) AS BIGINT) AS a_y, CAST(floor(ymax + {e} - 0.5) AS BIGINT) AS b_y,
         CAST(ceil(xmin - {e} - 0.5) AS BIGINT) AS a_x, CAST(floor(xmax + {e} - 0.5) AS BIGINT) AS b_x FROM bounds),
r1 AS (SELECT basin_id,
         greatest(CASE WHEN b_y - a_y + 1 < 2 THEN a_y - 1 ELSE a_y END, 0) AS iy_lo,
         least(CASE WHEN b_y - a_y + 1 < 2 THEN b_y + 1 ELSE b_y END, 9) AS iy_hi,
         greatest(CASE WHEN b_x - a_x + 1 < 2 THEN a_x - 1 ELSE a_x END, 0) AS ix_lo,
         least(CASE WHEN b_x - a_x + 1 < 2 THEN b_x + 1 ELSE b_x END, 9) AS ix_hi FROM r0)
SELECT basin_id, iy, ix FROM r1 JOIN grid ON iy BETWEEN iy_lo AND iy_hi AND ix BETWEEN ix_lo AND ix_hi"""


@register("extent_cells", sql=V.with_(V.BOXES, V.GRID10) + _EXTENT_SQL.format(e=0))
def extent_cells(spark, sf):
    b = cov.total_bounds(views.divides(spark, sf), "basin_id")
    return cov.extent_cells(b, G, "basin_id", expand=0)


@register("extent_expanded", sql=V.with_(V.BOXES, V.GRID10) + _EXTENT_SQL.format(e=1))
def extent_expanded(spark, sf):
    b = cov.total_bounds(views.divides(spark, sf), "basin_id")
    return cov.extent_cells(b, G, "basin_id", expand=1)


_CATCH_SQL = """,
cov AS (SELECT r.*, count(*) OVER (PARTITION BY basin_id, divide_id) AS n FROM rect_cov r),
j AS (SELECT c.basin_id, c.divide_id, r.time, c.coverage, c.n, r.qty, r.disc FROM cov c JOIN raster r USING (iy, ix)),
catch AS (
  SELECT basin_id, divide_id, time,
         CASE WHEN count(qty) = max(n) THEN sum(qty * coverage) / sum(coverage) END AS qty,
         CASE WHEN count(disc) = max(n) THEN sum(disc * coverage) / sum(coverage) END AS disc
  FROM j GROUP BY 1, 2, 3)
"""


@register("catchment_forcing", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, divide_id, time, round(qty, 9) AS qty, round(disc, 9) AS disc FROM catch""")
def catchment_forcing(spark, sf):
    c = forcing.catchment_mean(views.raster(spark, sf), rect_coverage(spark, sf), views.RASTER_VARS)
    return c.select("basin_id", "divide_id", "time", r9("qty", "qty"), r9("disc", "disc"))


def basin_forcing_df(spark, sf):
    c = forcing.catchment_mean(views.raster(spark, sf), rect_coverage(spark, sf), views.RASTER_VARS)
    b = forcing.basin_mean(c, views.RASTER_VARS)
    return b.select("basin_id", "time", r9("qty", "qty"), r9("disc", "disc"))


@register("basin_forcing", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, time, round(avg(qty), 9) AS qty, round(avg(disc), 9) AS disc FROM catch GROUP BY 1, 2""")
def basin_forcing(spark, sf):
    return basin_forcing_df(spark, sf)


@register("raster_long", sql=V.with_(V.RASTER) + """
SELECT time, iy, ix, variable, value FROM raster UNPIVOT INCLUDE NULLS (value FOR variable IN (qty, disc))""")
def raster_long(spark, sf):
    r = views.raster(spark, sf)
    return forcing.to_long(r, ["time", "iy", "ix"], views.RASTER_VARS)


@register("raster_wide_roundtrip", sql=V.with_(V.RASTER) + """
SELECT time, iy, ix, qty, disc FROM raster WHERE qty IS NOT NULL OR disc IS NOT NULL""")
def raster_wide_roundtrip(spark, sf):
    r = views.raster(spark, sf)
    long = forcing.to_long(r, ["time", "iy", "ix"], views.RASTER_VARS).filter(F.col("value").isNotNull())
    return forcing.to_wide(long, ["time", "iy", "ix"], views.RASTER_VARS)


@register("dense_pack", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, divide_id AS ids, CAST(year(time) AS INTEGER) AS chunk, CAST(count(*) AS BIGINT) AS n_time,
       min(time) AS first_time, max(time) AS last_time,
       round(arg_min_null(disc, time), 9) AS first_disc, round(arg_max_null(disc, time), 9) AS last_disc,
       CAST(count(qty) AS BIGINT) AS n_qty
FROM catch GROUP BY 1, 2, 3""")
def dense_pack(spark, sf):
    c = forcing.catchment_mean(views.raster(spark, sf), rect_coverage(spark, sf), views.RASTER_VARS)
    d = pack.to_dense(c, views.RASTER_VARS, chunk="year")
    return d.select("basin_id", "ids", "chunk", F.size("Time").cast("bigint").alias("n_time"),
                    F.element_at("Time", 1).alias("first_time"), F.element_at("Time", -1).alias("last_time"),
                    r9(F.element_at("disc", 1), "first_disc"), r9(F.element_at("disc", -1), "last_disc"),
                    F.size(F.filter("qty", lambda v: v.isNotNull())).cast("bigint").alias("n_qty"))


@register("dense_unpack", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, divide_id, time, round(qty, 9) AS qty, round(disc, 9) AS disc FROM catch""")
def dense_unpack(spark, sf):
    c = forcing.catchment_mean(views.raster(spark, sf), rect_coverage(spark, sf), views.RASTER_VARS)
    d = pack.to_dense(c, views.RASTER_VARS, chunk="year")
    u = pack.from_dense(d, views.RASTER_VARS)
    return u.select("basin_id", "divide_id", "time", r9("qty", "qty"), r9("disc", "disc"))


@register("coverage_nested_roundtrip", sql=V.with_(V.BOXES, V.GRID10, V.RECT_COV) + """
SELECT basin_id, divide_id, cell_id, iy, ix, round(coverage, 9) AS coverage FROM rect_cov""")
def coverage_nested_roundtrip(spark, sf):
    c = rect_coverage(spark, sf)
    nested = cov.to_nested(c)
    flat = cov.flatten_coverage(nested, G.nx)
    return flat.select("basin_id", "divide_id", "cell_id", "iy", "ix", r9("coverage", "coverage"))


# Small grid: divides beyond x >= 5 or y >= 5 get no cells and take the nearest covered feature's.
G5 = Grid(grid_id="unit5", x0=0.0, y0=0.0, dx=1.0, dy=1.0, nx=5, ny=5)


_NEAREST_SQL = """,
grid AS (SELECT CAST(a.range AS BIGINT) AS iy, CAST(b.range AS BIGINT) AS ix FROM range(5) a, range(5) b),
c5 AS (
  SELECT basin_id, divide_id, iy * 5 + ix AS cell_id, iy, ix,
         greatest(0, least(x1, ix + 1) - greatest(x0, ix)) * greatest(0, least(y1, iy + 1) - greatest(y0, iy)) AS coverage
  FROM boxes, grid
  WHERE greatest(0, least(x1, ix + 1) - greatest(x0, ix)) * greatest(0, least(y1, iy + 1) - greatest(y0, iy)) > 1e-12),
miss AS (SELECT * FROM boxes WHERE divide_id NOT IN (SELECT divide_id FROM c5)),
have AS (SELECT * FROM boxes WHERE divide_id IN (SELECT divide_id FROM c5)),
d AS (SELECT m.divide_id, h.divide_id AS source_id,
             sqrt(pow(greatest(0, m.x0 - h.x1, h.x0 - m.x1), 2) + pow(greatest(0, m.y0 - h.y1, h.y0 - m.y1), 2)) AS dist
      FROM miss m, have h),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY divide_id ORDER BY dist, source_id) AS rn FROM d) WHERE rn = 1)
"""


@register("nearest_fill", sql=V.with_(V.BOXES) + _NEAREST_SQL + """
SELECT b.divide_id, b.source_id, round(b.dist, 9) AS dist, c.cell_id, round(c.coverage, 9) AS coverage
FROM best b JOIN c5 c ON c.divide_id = b.source_id""")
def nearest_fill(spark, sf):
    from ..session import written
    d = views.divides(spark, sf)
    c = written(cov.coverage(d, G5, cells="touch"), "coverage")  # searched and copied from: overlay once
    near = cov.nearest_sources(d, c)
    return (near.join(c.select(F.col("basin_id").alias("source_basin"), F.col("divide_id").alias("source_id"), "cell_id", "coverage"), ["source_basin", "source_id"])
                .select("divide_id", "source_id", r9("dist", "dist"), "cell_id", r9("coverage", "coverage")))


_LCC_SQL = """
  {r} * {f} / pow(tan(pi() / 4 + radians({lat}) / 2), {n})"""


def _lcc_sql(lon: str, lat: str) -> tuple[str, str]:
    import math
    p = math.radians(38.5)
    n = math.sin(p)
    f = math.cos(p) * math.tan(math.pi / 4 + p / 2) ** n / n
    rho0 = 6371229.0 * f / math.tan(math.pi / 4 + p / 2) ** n
    def d(v):
        return f"CAST({v!r} AS DOUBLE)"
    rho = f"({d(6371229.0 * f)} / pow(tan(pi() / 4 + radians({lat}) / 2), {d(n)}))"
    theta = f"({d(n)} * radians(((({lon}) - {d(262.5)} + {d(180.0)}) % {d(360.0)} + {d(360.0)}) % {d(360.0)} - {d(180.0)}))"
    return f"{rho} * sin({theta})", f"{d(rho0)} - {rho} * cos({theta})"


_LX, _LY = _lcc_sql("lon", "lat")


@register("reproject_lcc", sql=V.with_(V.BOXES) + f""",
pts AS (SELECT divide_id, CAST(-125.0 AS DOUBLE) + x0 * 6 AS lon, CAST(25.0 AS DOUBLE) + y0 * CAST(2.5 AS DOUBLE) AS lat FROM boxes)
SELECT divide_id, round({_LX}, 3) AS x, round({_LY}, 3) AS y FROM pts""")
def reproject_lcc(spark, sf):
    b = views.boxes(spark, sf)
    lon = F.lit(-125.0) + F.col("x0") * 6
    lat = F.lit(25.0) + F.col("y0") * 2.5
    x, y = geo.lcc_xy(lon, lat, **geo.LCC_FORECAST)
    return b.select("divide_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@register("catchment_forcing_shuffled", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, divide_id, time, round(qty, 9) AS qty, round(disc, 9) AS disc FROM catch""")
def catchment_forcing_shuffled(spark, sf):
    """A1 with the shuffle join that the planner takes when coverage is too large to broadcast."""
    c = forcing.catchment_mean(views.raster(spark, sf), rect_coverage(spark, sf), views.RASTER_VARS, join="merge")
    return c.select("basin_id", "divide_id", "time", r9("qty", "qty"), r9("disc", "disc"))


@register("features_without_cells", sql=V.with_(V.BOXES) + """,
grid AS (SELECT CAST(a.range AS BIGINT) AS iy, CAST(b.range AS BIGINT) AS ix FROM range(5) a, range(5) b),
c5 AS (SELECT divide_id FROM boxes, grid
       WHERE greatest(0, least(x1, ix + 1) - greatest(x0, ix)) * greatest(0, least(y1, iy + 1) - greatest(y0, iy)) > 1e-12)
SELECT divide_id, CAST(0 AS INTEGER) AS n_cells FROM boxes WHERE divide_id NOT IN (SELECT divide_id FROM c5)""")
def features_without_cells(spark, sf):
    """R1 + R2: nested per-feature cell arrays (empty for features the grid misses), then the empty ones."""
    d = views.divides(spark, sf)
    nested = cov.nested_coverage(d, cov.coverage(d, G5))
    return cov.without_cells(nested).select("divide_id", F.size("cells").alias("n_cells"))


_CENTRE_COV = _EXTENT_SQL.format(e=0).replace(
    "SELECT basin_id, iy, ix FROM r1 JOIN grid ON iy BETWEEN iy_lo AND iy_hi AND ix BETWEEN ix_lo AND ix_hi",
    "") + """,
centre_cov AS (SELECT c.* FROM rect_cov c JOIN r1 USING (basin_id)
               WHERE c.iy BETWEEN r1.iy_lo AND r1.iy_hi AND c.ix BETWEEN r1.ix_lo AND r1.ix_hi)
"""


@register("coverage_centre", sql=V.with_(V.BOXES, V.GRID10, V.RECT_COV) + _CENTRE_COV + """
SELECT basin_id, divide_id, cell_id, iy, ix, round(coverage, 9) AS coverage FROM centre_cov""")
def coverage_centre(spark, sf):
    """P1 default: only cells whose centre lies within the bounds of the catchment's basin."""
    c = cov.coverage(views.divides(spark, sf), G, cells="centre")
    return c.select("basin_id", "divide_id", "cell_id", "iy", "ix", r9("coverage", "coverage"))


@register("catchment_forcing_centre", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CENTRE_COV + """,
cov AS (SELECT r.*, count(*) OVER (PARTITION BY basin_id, divide_id) AS n FROM centre_cov r),
j AS (SELECT c.basin_id, c.divide_id, r.time, c.coverage, c.n, r.qty, r.disc FROM cov c JOIN raster r USING (iy, ix))
SELECT basin_id, divide_id, time,
       round(CASE WHEN count(qty) = max(n) THEN sum(qty * coverage) / sum(coverage) END, 9) AS qty,
       round(CASE WHEN count(disc) = max(n) THEN sum(disc * coverage) / sum(coverage) END, 9) AS disc
FROM j GROUP BY 1, 2, 3""")
def catchment_forcing_centre(spark, sf):
    """A1 on the centre-rule coverage: weights renormalise over the cells that are kept."""
    c = cov.coverage(views.divides(spark, sf), G, cells="centre")
    m = forcing.catchment_mean(views.raster(spark, sf), c, views.RASTER_VARS)
    return m.select("basin_id", "divide_id", "time", r9("qty", "qty"), r9("disc", "disc"))


def _ov(a0, a1, b0, b1):
    return f"greatest(0, least({a1}, {b1}) - greatest({a0}, {b0}))"


_HOLE_COV = " + ".join([
    f"{_ov('x0', 'x1', 'ix', 'ix + 1')} * {_ov('y0', 'y1', 'iy', 'iy + 1')}",
    f"- {_ov('x0 + 0.25', 'x1 - 0.25', 'ix', 'ix + 1')} * {_ov('y0 + 0.25', 'y1 - 0.25', 'iy', 'iy + 1')}",
    f"{_ov('x0', 'x0 + 0.5', 'ix', 'ix + 1')} * {_ov('y0 + 5', 'y0 + 5.75', 'iy', 'iy + 1')}",
]).replace("+ -", "-")


@register("coverage_multipart_holes", sql=V.with_(V.BOXES, V.GRID10) + f""",
c AS (SELECT basin_id, divide_id, iy * 10 + ix AS cell_id, iy, ix, {_HOLE_COV} AS coverage FROM boxes, grid)
SELECT basin_id, divide_id, cell_id, iy, ix, round(coverage, 9) AS coverage FROM c WHERE coverage > 1e-12""")
def coverage_multipart_holes(spark, sf):
    """G1 on two-part polygons: the nation box with a hole inset by 0.25, plus a 0.5 x 0.75 box 5 units up
    (partly beyond the grid's top edge)."""
    b = views.boxes(spark, sf)
    x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")
    outer = geo.rectangle(x0, y0, x1, y1)
    hole = F.transform(geo.rectangle(x0 + 0.25, y0 + 0.25, x1 - 0.25, y1 - 0.25),
                       lambda r: r.withField("hole", F.lit(True)))
    part2 = F.transform(geo.rectangle(x0, y0 + 5, x0 + 0.5, y0 + 5.75), lambda r: r.withField("part", F.lit(1)))
    d = b.select("basin_id", "divide_id", F.concat(outer, hole, part2).alias("rings"))
    c = cov.coverage(d, G, cells="touch")
    return c.select("basin_id", "divide_id", "cell_id", "iy", "ix", r9("coverage", "coverage"))


@register("catchment_forcing_dense", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """,
span AS (SELECT min(time) AS t0, max(time) AS t1 FROM raster),
spine AS (SELECT d.basin_id, d.divide_id, unnest(generate_series(t0, t1, INTERVAL 1 MONTH)) AS time
          FROM (SELECT DISTINCT basin_id, divide_id FROM rect_cov) d, span)
SELECT s.basin_id, s.divide_id, s.time, round(c.qty, 9) AS qty, round(c.disc, 9) AS disc
FROM spine s LEFT JOIN catch c USING (basin_id, divide_id, time)""")
def catchment_forcing_dense(spark, sf):
    """A1 with a time spine: every catchment gets every month from the raster's first to last, NULL where
    none of its cells has a raster row."""
    c = forcing.catchment_mean(views.raster(spark, sf), rect_coverage(spark, sf), views.RASTER_VARS, dense="1 month")
    return c.select("basin_id", "divide_id", "time", r9("qty", "qty"), r9("disc", "disc"))


_SHARED_BOXES = V.BOXES.replace("boxes AS", "own_boxes AS", 1) + """,
boxes AS (SELECT * FROM own_boxes UNION ALL
          SELECT 'shared' AS basin_id, divide_id, x0, x1, y0, y1 FROM own_boxes WHERE CAST(substr(divide_id, 5) AS INTEGER) % 2 = 0)"""


def shared_divides(spark, sf):
    """The nations' catchments, and one more basin that holds every second of them again (nested gages)."""
    d = views.divides(spark, sf)
    again = d.where(F.substring("divide_id", 5, 10).cast("int") % 2 == 0).withColumn("basin_id", F.lit("shared"))
    return d.union(again)


@register("catchment_forcing_shared", sql=V.with_(V.RASTER, _SHARED_BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, divide_id, time, round(qty, 9) AS qty, round(disc, 9) AS disc FROM catch""")
def catchment_forcing_shared(spark, sf):
    """A1 where basins share catchments: each (basin, catchment) has its own series."""
    c = cov.coverage(shared_divides(spark, sf), G, cells="touch")
    m = forcing.catchment_mean(views.raster(spark, sf), c, views.RASTER_VARS)
    return m.select("basin_id", "divide_id", "time", r9("qty", "qty"), r9("disc", "disc"))


@register("nested_shared", sql=V.with_(_SHARED_BOXES, V.GRID10, V.RECT_COV) + """
SELECT b.basin_id, b.divide_id, count(c.coverage) AS n_cells, round(coalesce(sum(c.coverage), 0), 9) AS area
FROM boxes b LEFT JOIN rect_cov c ON c.basin_id = b.basin_id AND c.divide_id = b.divide_id GROUP BY 1, 2""")
def nested_shared(spark, sf):
    """R1 where basins share catchments: the nested cells of a (basin, catchment) are its own, once."""
    d = shared_divides(spark, sf)
    n = cov.nested_coverage(d, cov.coverage(d, G, cells="touch"))
    return n.select("basin_id", "divide_id", F.size("cells").cast("long").alias("n_cells"),
                    F.round(F.aggregate("cells", F.lit(0.0), lambda s, c: s + c["coverage"]), 9).alias("area"))


# Half-unit boxes at multiples of 1/64 (exact in binary): two thirds on the grid, the rest beside it in a cluster or far away.
_SCATTER_SQL = """scatter AS (
  SELECT c_custkey AS k, 'far-' || CAST(c_custkey AS VARCHAR) AS divide_id, CAST(c_nationkey AS VARCHAR) AS basin_id,
         CASE WHEN c_custkey % 3 <> 0 THEN ((c_custkey * 7919) % 640) / CAST(64.0 AS DOUBLE)
              WHEN c_custkey % 2 = 0 THEN -20 + ((c_custkey * 13) % 97) / CAST(64.0 AS DOUBLE)
              ELSE 500 + ((c_custkey * 31) % 500) / CAST(8.0 AS DOUBLE) END AS x0,
         CASE WHEN c_custkey % 3 <> 0 THEN ((c_custkey * 104729) % 640) / CAST(64.0 AS DOUBLE)
              WHEN c_custkey % 2 = 0 THEN 12 + ((c_custkey * 29) % 89) / CAST(64.0 AS DOUBLE)
              ELSE -300 + ((c_custkey * 17) % 400) / CAST(1.0 AS DOUBLE) END AS y0
  FROM customer)"""


def scatter(spark, sf):
    k = F.col("c_custkey")

    def part(mult, mod, by):
        return ((k * mult) % mod).cast("double") / F.lit(float(by))
    x0 = F.when(k % 3 != 0, part(7919, 640, 64)).when(k % 2 == 0, part(13, 97, 64) - 20).otherwise(part(31, 500, 8) + 500)
    y0 = F.when(k % 3 != 0, part(104729, 640, 64)).when(k % 2 == 0, part(29, 89, 64) + 12).otherwise(part(17, 400, 1) - 300)
    b = views.table(spark, sf, "customer").select(k.alias("k"), F.concat(F.lit("far-"), k.cast("string")).alias("divide_id"),
                                                  F.col("c_nationkey").cast("string").alias("basin_id"), x0.alias("x0"), y0.alias("y0"))
    rings = geo.rectangle(F.col("x0"), F.col("y0"), F.col("x0") + 0.5, F.col("y0") + 0.5)
    # some features without a shape: null rings, and no rings
    rings = F.when(F.col("k") % 50 == 48, F.filter(rings, lambda r: F.lit(False))).when(F.col("k") % 50 != 49, rings)
    return b.select("basin_id", "divide_id", rings.alias("rings"))


@register("nearest_far", sql=V.with_(_SCATTER_SQL) + """,
shaped AS (SELECT * FROM scatter WHERE k % 50 NOT IN (48, 49)),
d AS (SELECT m.basin_id, m.divide_id, h.basin_id AS source_basin, h.divide_id AS source_id,
             sqrt(pow(greatest(0, m.x0 - h.x0 - 0.5, h.x0 - m.x0 - 0.5), 2) + pow(greatest(0, m.y0 - h.y0 - 0.5, h.y0 - m.y0 - 0.5), 2)) AS dist
      FROM shaped m JOIN shaped h ON m.k % 3 = 0 AND h.k % 3 <> 0)
SELECT basin_id, divide_id, source_basin, source_id, round(dist, 9) AS dist FROM d
QUALIFY row_number() OVER (PARTITION BY basin_id, divide_id ORDER BY d.dist, source_id) = 1
UNION ALL SELECT basin_id, divide_id, NULL, NULL, NULL FROM scatter WHERE k % 50 IN (48, 49)""")
def nearest_far(spark, sf):
    """J3 over the customers' boxes, clustered and far away, with features that have no shape: those are named, with no answer."""
    from ..session import written
    d = written(scatter(spark, sf), "scatter")
    near = cov.nearest_sources(d, written(cov.coverage(d, G, cells="touch"), "coverage"))
    none = cov.without_geometry(d).select("*", F.lit(None).cast("string").alias("source_basin"), F.lit(None).cast("string").alias("source_id"), F.lit(None).cast("double").alias("dist"))
    return near.select("basin_id", "divide_id", "source_basin", "source_id", r9("dist", "dist")).union(none)


# Right triangles of the customers, one cell and more across, slanted over the grid.
_TRIANGLES_SQL = """tri AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS basin_id, 'tri-' || CAST(c_custkey AS VARCHAR) AS divide_id,
         ((c_custkey * 7919) % 640) / CAST(64.0 AS DOUBLE) AS x0, ((c_custkey * 104729) % 640) / CAST(64.0 AS DOUBLE) AS y0,
         CAST(0.5 AS DOUBLE) + ((c_custkey * 31) % 128) / CAST(32.0 AS DOUBLE) AS w, CAST(0.5 AS DOUBLE) + ((c_custkey * 17) % 96) / CAST(32.0 AS DOUBLE) AS h
  FROM customer)"""


def slanted(spark, sf):
    k = F.col("c_custkey")

    def part(mult, mod, by):
        return ((k * mult) % mod).cast("double") / F.lit(float(by))
    b = views.table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("basin_id"), F.concat(F.lit("tri-"), k.cast("string")).alias("divide_id"),
        part(7919, 640, 64).alias("x0"), part(104729, 640, 64).alias("y0"), (part(31, 128, 32) + 0.5).alias("w"), (part(17, 96, 32) + 0.5).alias("h"))
    return b.select("basin_id", "divide_id", geo.triangle(F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")).alias("rings"))


@register("coverage_slanted", sql=V.with_(_TRIANGLES_SQL, V.GRID10) + """,
p AS (SELECT basin_id, divide_id, iy, ix, x0, y0, w, h, greatest(ix, x0) AS a, least(ix + 1, x0 + w) AS b, greatest(iy, y0) AS c, CAST(iy + 1 AS DOUBLE) AS d
      FROM tri, grid WHERE ix < x0 + w AND ix + 1 > x0 AND iy < y0 + h AND iy + 1 > y0),
e AS (SELECT *, greatest(a, least(b, x0 + (y0 + h - d) * w / h)) AS s, x0 + (y0 + h - c) * w / h AS foot FROM p),
m AS (SELECT *, greatest(s, least(b, foot)) AS t FROM e),
r AS (SELECT basin_id, divide_id, iy * 10 + ix AS cell_id, iy, ix,
             (s - a) * (d - c) + (t - s) * ((y0 + h - (s - x0) * h / w + y0 + h - (t - x0) * h / w) / 2 - c) AS coverage FROM m)
SELECT basin_id, divide_id, cell_id, iy, ix, round(coverage, 9) AS coverage FROM r WHERE coverage > 1e-9""")
def coverage_slanted(spark, sf):
    """J2 + G1 cell by cell on slanted edges, with as many polygons as there are customers; parts lie beyond the grid."""
    c = cov.coverage(slanted(spark, sf), G, cells="touch").where("coverage > 1e-9")
    return c.select("basin_id", "divide_id", "cell_id", "iy", "ix", r9("coverage", "coverage"))
