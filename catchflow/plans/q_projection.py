"""Queries: map projections on the catchments, on containers in another system, and in the forcing job."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import projections as proj
from ..operators import coverage as cov
from ..session import scratch_path
from ..sources import containers
from . import sql_views as V
from . import views
from .q_forcing import _CENTRE_COV
from .q_sources import write_raster_stores
from .registry import r6, register


def _d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def albers_inverse_sql(s: proj.System) -> str:
    """DuckDB CTEs ``ll`` (id, lon, lat) from ``pts`` (id, x, y on an Albers map), by the same published formulas."""
    n, c, rho0 = proj._cone(s)
    e2, e, a, qp = s.ellipsoid.e2, s.ellipsoid.e, s.ellipsoid.a, proj._q(s, math.pi / 2)
    k = (e2 / 3 + 31 * e2 ** 2 / 180 + 517 * e2 ** 3 / 5040, 23 * e2 ** 2 / 360 + 251 * e2 ** 3 / 3780, 761 * e2 ** 3 / 45360)
    return f"""polar AS (SELECT id, atan2(x, {_d(rho0)} - y) AS theta, ({_d(c)} - (x * x + ({_d(rho0)} - y) * ({_d(rho0)} - y)) * {_d(n * n / a / a)}) / {_d(n)} AS q FROM pts),
series AS (SELECT id, theta, q, asin(q / {_d(qp)}) + {_d(k[0])} * sin(2 * asin(q / {_d(qp)})) + {_d(k[1])} * sin(4 * asin(q / {_d(qp)}))
           + {_d(k[2])} * sin(6 * asin(q / {_d(qp)})) AS phi FROM polar),
closer AS (SELECT id, theta, phi + pow(1 - {_d(e2)} * sin(phi) * sin(phi), 2) / (2 * cos(phi)) * (q / {_d(1 - e2)} - sin(phi) / (1 - {_d(e2)} * sin(phi) * sin(phi))
           + ln((1 - {_d(e)} * sin(phi)) / (1 + {_d(e)} * sin(phi))) / {_d(2 * e)}) AS phi FROM series),
ll AS (SELECT id, {_d(s.lon0)} + degrees(theta / {_d(n)}) AS lon, degrees(phi) AS lat FROM closer)"""


def lambert_forward_sql(lon: str, lat: str, s: proj.System) -> tuple[str, str]:
    n, f, rho0 = proj._cone(s)
    e, a = s.ellipsoid.e, s.ellipsoid.a
    sin = f"sin(radians({lat}))"
    t = f"(tan(pi() / 4 - radians({lat}) / 2) / pow((1 - {_d(e)} * {sin}) / (1 + {_d(e)} * {sin}), {_d(e / 2)}))"
    rho = f"({_d(a * f)} * pow({t}, {_d(n)}))"
    turn = f"((({lon}) - {_d(s.lon0)} + 180.0::DOUBLE + 720.0::DOUBLE) % 360.0::DOUBLE - 180.0::DOUBLE)"
    theta = f"({_d(n)} * radians({turn}))"
    return f"({rho} * sin({theta}) + {_d(s.x0)})", f"({_d(rho0 + s.y0)} - {rho} * cos({theta}))"


ALBERS = proj.SYSTEMS["EPSG:5070"]
_X, _Y = "CAST(c_custkey * 7919 % 4600000 - 2300000 AS DOUBLE)", "CAST(c_custkey * 104729 % 2900000 + 300000 AS DOUBLE)"
_POINTS = f"""pts AS (SELECT c_custkey AS id, {_X} AS x, {_Y} AS y FROM customer)"""


def albers_points(spark, sf):
    """A point on the continental Albers map for each customer."""
    k = F.col("c_custkey")
    return views.table(spark, sf, "customer").select(k.alias("id"), ((k * 7919) % 4600000 - 2300000).cast("double").alias("x"),
                                                     ((k * 104729) % 2900000 + 300000).cast("double").alias("y"))


def _moved(spark, sf, target: str, names: tuple[str, str], digits: int):
    p = albers_points(spark, sf).withColumn("p", proj.move_point(F.col("x"), F.col("y"), "EPSG:5070", target))
    return p.select("id", *[F.round(F.col("p")[c], digits).alias(n) for c, n in zip("xy", names)])


_LONLAT = V.with_(_POINTS, albers_inverse_sql(ALBERS))


@register("albers_to_lonlat", sql=_LONLAT + "SELECT id, round(lon, 9) AS lon, round(lat, 9) AS lat FROM ll")
def albers_to_lonlat(spark, sf):
    """The continental Albers system to longitude and latitude."""
    return _moved(spark, sf, "EPSG:4269", ("lon", "lat"), 9)


def _albers_to(name: str, digits: int) -> str:
    x, y = lambert_forward_sql("lon", "lat", proj.SYSTEMS[name])
    return _LONLAT + f"SELECT id, round({x}, {digits}) AS x, round({y}, {digits}) AS y FROM ll"


@register("albers_to_lcc", sql=_albers_to("lcc_forecast", 3))
def albers_to_lcc(spark, sf):
    """Albers to the forecast grid's spherical Lambert system."""
    return _moved(spark, sf, "lcc_forecast", ("x", "y"), 3)


@register("albers_to_ellipsoidal_lcc", sql=_albers_to("EPSG:3347", 3))
def albers_to_ellipsoidal_lcc(spark, sf):
    """Albers to an ellipsoidal two-parallel Lambert system with false origin."""
    return _moved(spark, sf, "EPSG:3347", ("x", "y"), 3)


@register("lcc_roundtrip", sql=V.with_(_POINTS) + """
SELECT id, x, y FROM pts""")
def lcc_roundtrip(spark, sf):
    """Albers to Lambert and back ends where it began (to a hundredth of a millimetre and less)."""
    p = albers_points(spark, sf).withColumn("p", proj.move_point(F.col("x"), F.col("y"), "EPSG:5070", "EPSG:3347"))
    p = p.withColumn("q", proj.move_point(F.col("p.x"), F.col("p.y"), "EPSG:3347", "EPSG:5070"))
    return p.select("id", F.round("q.x", 3).alias("x"), F.round("q.y", 3).alias("y"))


@register("container_projected", sql=V.with_(V.BOXES, V.GRID10, V.RECT_COV) + """
SELECT basin_id, divide_id, cell_id, iy, ix, round(coverage, 6) AS coverage FROM rect_cov WHERE coverage > 1e-6""")
def container_projected(spark, sf):
    """S3 + G4: containers in the Albers system, each read in row-id ranges by several tasks, moved to the grid's."""
    root = scratch_path(spark, "gpkg")
    d = views.divides(spark, sf)
    d = d.withColumn("rings", proj.move_rings(F.col("rings"), "EPSG:4326", "EPSG:5070"))
    containers.write_divides(d, root, srs="EPSG:5070", rtree=True)
    back = proj.to_system(containers.scan_divides(spark, root, with_crs=True, split_bytes=4096), views.GRID.crs, wkt_col="wkt").drop("crs", "wkt")
    c = cov.coverage(back, views.GRID, cells="touch").where("coverage > 1e-6")
    return c.select("basin_id", "divide_id", "cell_id", "iy", "ix", r6("coverage", "coverage"))


@register("container_extent", sql=V.with_(V.BOXES) + """
SELECT basin_id, divide_id FROM boxes WHERE x1 >= 2.5 AND x0 <= 5.0 AND y1 >= 1.0 AND y0 <= 6.0""")
def container_extent(spark, sf):
    """S3 + P1: the features whose box meets an extent, found through the containers' R-trees."""
    root = scratch_path(spark, "gpkg")
    containers.write_divides(views.divides(spark, sf), root, srs="EPSG:4326", rtree=True)
    return containers.scan_divides(spark, root, extent=(2.5, 1.0, 5.0, 6.0)).select("basin_id", "divide_id")


@register("forcing_job_projected", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CENTRE_COV + """,
cov AS (SELECT r.*, count(*) OVER (PARTITION BY basin_id, divide_id) AS n FROM centre_cov r),
j AS (SELECT c.basin_id, c.divide_id, r.time, c.coverage, c.n, r.qty, r.disc FROM cov c JOIN raster r USING (iy, ix)),
catch AS (SELECT basin_id, divide_id, time,
         CASE WHEN count(qty) = max(n) THEN sum(qty * coverage) / sum(coverage) END AS qty,
         CASE WHEN count(disc) = max(n) THEN sum(disc * coverage) / sum(coverage) END AS disc FROM j GROUP BY 1, 2, 3)
SELECT basin_id, time, round(avg(qty), 5) AS qty, round(avg(disc), 5) AS disc FROM catch GROUP BY 1, 2""")
def forcing_job_projected(spark, sf):
    """The forcing job on containers in the Albers system and a longitude/latitude raster."""
    from .. import jobs
    root = scratch_path(spark, "job")
    years = write_raster_stores(spark, sf, f"{root}/stores", dtype="<f8")
    d = views.divides(spark, sf).withColumn("rings", proj.move_rings(F.col("rings"), "EPSG:4326", "EPSG:5070"))
    containers.write_divides(d, f"{root}/gpkg", srs="EPSG:5070")
    jobs.forcing_job(spark, root + "/stores/{year}", (years[0], years[-1] + 1), ["qty", "disc"], f"{root}/gpkg", views.GRID, f"{root}/out", f"{root}/ledger")
    back = jobs.forcing_output(spark, f"{root}/out", "basin", ["qty", "disc"])
    return back.select("basin_id", F.col("time").cast("timestamp_ntz").alias("time"), F.round("qty", 5).alias("qty"), F.round("disc", 5).alias("disc"))
