"""Queries over the raw-byte sources: chunked raster stores and polygon containers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage as cov
from ..session import scratch_path, written
from ..sources import chunks, containers
from . import sql_views as V
from . import views
from .q_forcing import _CENTRE_COV as _CENTRE_COV_SQL
from .q_forcing import _NEAREST_SQL, G5
from .registry import r9, register

# Codec of each yearly store, in year order (cycled): exercises every decoder.
CODECS = [None, {"id": "zlib", "level": 1}, {"id": "gzip", "level": 1}, {"id": "zstd", "level": 1},
          {"id": "lz4"}]
CHUNKS = (12, 5, 5)


def write_raster_stores(spark, sf, root, dtype="<f4", shape=CHUNKS):
    """RASTER as one store per year (t = month - 1), chunks of a year x 5 x 5 cells or ``shape``; returns the years."""
    r = views.raster(spark, sf)
    years = sorted(x[0] for x in r.select(F.year("time").alias("y")).distinct().collect())  # a handful of ints
    for i, y in enumerate(years):
        part = r.filter(F.year("time") == y).select((F.month("time") - 1).cast("bigint").alias("t"), "iy", "ix",
                                                    "qty", "disc")
        hours = [int(((__import__("datetime").datetime(y, m, 1) - __import__("datetime").datetime(1995, 1, 1))
                      .total_seconds()) // 3600) for m in range(1, 13)]
        chunks.write_store(part, f"{root}/{y}", ["qty", "disc"], (12, views.GRID.ny, views.GRID.nx), shape,
                           hours, "1995-01-01 00:00:00", CODECS[i % len(CODECS)], dtype=dtype)
    return years


@register("chunk_scan", sql=V.with_(V.RASTER, V.GRID10) + """,
yr AS (SELECT min(year(time)) AS y0, max(year(time)) AS y1 FROM raster),
months AS (SELECT unnest(generate_series(make_timestamp(y0, 1, 1, 0, 0, 0), make_timestamp(y1, 12, 1, 0, 0, 0), INTERVAL 1 MONTH)) AS time FROM yr),
dense AS (SELECT m.time, g.iy, g.ix, r.qty, r.disc FROM months m CROSS JOIN grid g LEFT JOIN raster r USING (time, iy, ix)),
long AS (SELECT time, iy, ix, variable, value FROM dense UNPIVOT INCLUDE NULLS (value FOR variable IN (qty, disc)))
SELECT time, iy, ix, variable, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM long, yr
WHERE NOT (variable = 'qty' AND year(time) = y0 + 2 AND iy >= 5 AND ix < 5)""")
def chunk_scan(spark, sf):
    root = scratch_path(spark, "stores")
    years = write_raster_stores(spark, sf, root)
    with open(f"{root}/{years[2]}/qty/0.1.0", "wb") as fh:  # one corrupt chunk: its cells drop out
        fh.write(b"not a chunk")
    # years as range(begin, end): end is exclusive, so the whole archive is (first, last + 1)
    return chunks.scan_raster(spark, root + "/{year}", (years[0], years[-1] + 1), ["qty", "disc"], tolerant=True)


@register("chunk_scan_extent", sql=V.with_(V.RASTER, V.GRID10) + """,
yr AS (SELECT min(year(time)) AS y0, max(year(time)) AS y1 FROM raster),
months AS (SELECT unnest(generate_series(make_timestamp(y0, 1, 1, 0, 0, 0), make_timestamp(y1, 12, 1, 0, 0, 0), INTERVAL 1 MONTH)) AS time FROM yr),
box AS (SELECT m.time, g.iy, g.ix, r.qty, r.disc FROM yr, months m CROSS JOIN grid g LEFT JOIN raster r USING (time, iy, ix)
        WHERE iy BETWEEN 2 AND 5 AND ix BETWEEN 7 AND 8
          AND m.time >= make_timestamp(y0 + 1, 3, 1, 0, 0, 0) AND m.time < make_timestamp(y0 + 2, 6, 1, 0, 0, 0)),
long AS (SELECT time, iy, ix, variable, value FROM box UNPIVOT INCLUDE NULLS (value FOR variable IN (qty, disc)))
SELECT CAST(year(time) AS INTEGER) AS year, variable,
       count(DISTINCT ((month(time) - 1) // 4) * 100 + (iy // 3) * 10 + ix // 3) AS n_chunks, count(*) AS n_cells,
       count(value) AS n_values, round(sum(CAST(value AS DOUBLE)), 6) AS total FROM long GROUP BY 1, 2""")
def chunk_scan_extent(spark, sf):
    """S1 + P1: a scan over a few cells and months opens the chunks that meet them and no other.

    Every other chunk file of the archive is overwritten with bytes that can't be decoded, and the scan isn't tolerant.
    """
    import os
    root = scratch_path(spark, "stores")
    years = write_raster_stores(spark, sf, root, dtype="<f8", shape=(4, 3, 3))
    first = years[0]
    for folder, _, names in os.walk(root):  # a fixture: what lies outside the box can't be read
        year, variable = folder.split("/")[-2:]
        for name in names:
            if variable not in ("qty", "disc") or name.startswith("."):
                continue
            kt, ky, kx = (int(k) for k in name.split("."))
            months = range(4 * kt + 1, 4 * kt + 5)
            inside = ky in (0, 1) and kx == 2 and any((int(year) == first + 1 and m >= 3) or (int(year) == first + 2 and m < 6) for m in months)
            if not inside:
                with open(f"{folder}/{name}", "wb") as fh:
                    fh.write(b"never to be opened")
    scan = chunks.scan_chunks(spark, [f"{root}/{y}" for y in years], ["qty", "disc"], with_errors=True)
    scan = scan.where(F.col("iy").between(2, 5) & F.col("ix").between(7, 8)
                      & (F.col("time") >= F.lit(f"{first + 1}-03-01").cast("timestamp_ntz")) & (F.col("time") < F.lit(f"{first + 2}-06-01").cast("timestamp_ntz")))
    return scan.groupBy(F.year("time").alias("year"), "variable").agg(
        F.countDistinct("path").alias("n_chunks"), F.count("*").alias("n_cells"), F.count("value").alias("n_values"), F.round(F.sum("value"), 6).alias("total"))


@register("chunk_scan_missing_hour", sql=V.with_(V.RASTER) + """,
yr AS (SELECT min(year(time)) AS y0 FROM raster)
SELECT variable, CAST(count(*) AS BIGINT) AS n_cells, min(time) AS first_time, max(time) AS last_time
FROM (SELECT time, year(time) AS y, variable, value FROM raster UNPIVOT (value FOR variable IN (qty, disc))), yr
WHERE y <> y0 + 1 GROUP BY 1""")
def chunk_scan_missing_hour(spark, sf):
    """A whole store of the archive is missing; a tolerant scan goes on with the others."""
    root = scratch_path(spark, "stores")
    years = write_raster_stores(spark, sf, root)
    missing = [f"{root}/{y}" if y != years[1] else f"{root}/never-written" for y in years]
    long = chunks.scan_chunks(spark, missing, ["qty", "disc"], drop_fill=True, tolerant=True)
    return long.groupBy("variable").agg(F.count("value").alias("n_cells"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))


@register("chunk_scan_days", sql=V.with_(V.RASTER) + """
SELECT time, iy, ix, CAST(CAST(disc AS FLOAT) AS DOUBLE) AS value FROM raster""")
def chunk_scan_days(spark, sf):
    """S1 + D3: a store whose time axis counts days."""
    root = scratch_path(spark, "stores")
    r = views.raster(spark, sf)
    months = sorted(x[0] for x in r.select("time").distinct().collect())  # the time axis, as the store's writer has it
    axis = spark.createDataFrame([(m, i) for i, m in enumerate(months)], "time timestamp_ntz, t bigint")
    import datetime
    days = [(m - datetime.datetime(1990, 1, 1)).days for m in months]
    chunks.write_store(r.join(axis, "time").select("t", "iy", "ix", "disc"), f"{root}/all", ["disc"], (len(months), views.GRID.ny, views.GRID.nx),
                       (12, 10, 10), days, "1990-01-01 00:00:00", {"id": "zstd", "level": 1}, unit="days")
    return chunks.scan_chunks(spark, f"{root}/all", ["disc"], drop_fill=True).select("time", "iy", "ix", "value")


@register("polygon_container_scan", sql=V.with_(V.BOXES) + """
SELECT basin_id, divide_id, x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax, CAST(5 AS INTEGER) AS n_pts FROM boxes""")
def polygon_container_scan(spark, sf):
    root = scratch_path(spark, "gpkg")
    containers.write_divides(views.divides(spark, sf), root)
    with open(f"{root}/broken.gpkg", "wb") as fh:  # unreadable file: an error row, not a failed job
        fh.write(b"this is not a database")
    d = containers.scan_divides(spark, root, tolerant=True)
    from ..functions import geometry as geo
    bb = geo.bbox(F.col("rings"))
    return d.select("basin_id", "divide_id", bb["xmin"].alias("xmin"), bb["ymin"].alias("ymin"),
                    bb["xmax"].alias("xmax"), bb["ymax"].alias("ymax"),
                    F.size(F.element_at("rings", 1)["pts"]).alias("n_pts"))


@register("container_coverage", sql=V.with_(V.BOXES, V.GRID10, V.RECT_COV) + """
SELECT basin_id, divide_id, cell_id, iy, ix, round(coverage, 9) AS coverage FROM rect_cov""")
def container_coverage(spark, sf):
    root = scratch_path(spark, "gpkg")
    containers.write_divides(views.divides(spark, sf), root)
    d = containers.scan_divides(spark, root)
    c = cov.coverage(d, views.GRID, cells="touch")
    return c.select("basin_id", "divide_id", "cell_id", "iy", "ix", r9("coverage", "coverage"))


@register("file_catalog", sql=V.with_(V.RASTER) + """,
yr AS (SELECT DISTINCT CAST(year(time) AS INTEGER) AS year FROM raster)
SELECT year, variable, CAST(4 AS BIGINT) AS n_chunks FROM yr, (VALUES ('qty'), ('disc')) v(variable)""")
def file_catalog(spark, sf):
    """List the chunk files of every store (bytes never read), parse year and variable, count per pair."""
    from ..operators import catalog
    root = scratch_path(spark, "stores")
    write_raster_stores(spark, sf, root)
    files = catalog.list_files(spark, root, glob="[0-9]*.[0-9]*.[0-9]*")
    parts = files.select(F.regexp_extract("path", r"/(\d{4})/([^/]+)/[^/]+$", 1).cast("int").alias("year"),
                         F.regexp_extract("path", r"/(\d{4})/([^/]+)/[^/]+$", 2).alias("variable"))
    return parts.groupBy("year", "variable").agg(F.count(F.lit(1)).alias("n_chunks"))


@register("forcing_job_files", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CENTRE_COV_SQL + """,
cov AS (SELECT r.*, count(*) OVER (PARTITION BY basin_id, divide_id) AS n FROM centre_cov r),
j AS (SELECT c.basin_id, c.divide_id, r.time, c.coverage, c.n, r.qty, r.disc FROM cov c JOIN raster r USING (iy, ix)),
catch AS (SELECT basin_id, divide_id, time,
         CASE WHEN count(qty) = max(n) THEN sum(qty * coverage) / sum(coverage) END AS qty,
         CASE WHEN count(disc) = max(n) THEN sum(disc * coverage) / sum(coverage) END AS disc FROM j GROUP BY 1, 2, 3)
SELECT basin_id, time, round(avg(qty), 9) AS qty, round(avg(disc), 9) AS disc FROM catch GROUP BY 1, 2""")
def forcing_job_files(spark, sf):
    """The whole forcing job from files: yearly chunk stores (float64) and polygon containers written from
    the tables, then scan -> resume -> centre-rule coverage -> long-form catchment mean -> basin mean ->
    K1/K2/K3 writes -> ledger; the basin files are read back."""
    from .. import jobs
    root = scratch_path(spark, "job")
    years = write_raster_stores(spark, sf, f"{root}/stores", dtype="<f8")
    containers.write_divides(views.divides(spark, sf), f"{root}/gpkg")
    jobs.forcing_job(spark, root + "/stores/{year}", (years[0], years[-1] + 1), ["qty", "disc"], f"{root}/gpkg",
                     views.GRID, f"{root}/out", f"{root}/ledger")
    back = jobs.forcing_output(spark, f"{root}/out", "basin", ["qty", "disc"])
    return back.select("basin_id", F.col("time").cast("timestamp_ntz").alias("time"), r9("qty", "qty"), r9("disc", "disc"))


@register("forcing_job_killed", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CENTRE_COV_SQL + """,
cov AS (SELECT r.*, count(*) OVER (PARTITION BY basin_id, divide_id) AS n FROM centre_cov r),
j AS (SELECT c.basin_id, c.divide_id, r.time, c.coverage, c.n, r.qty, r.disc FROM cov c JOIN raster r USING (iy, ix)),
catch AS (SELECT basin_id, divide_id, time,
         CASE WHEN count(qty) = max(n) THEN sum(qty * coverage) / sum(coverage) END AS qty,
         CASE WHEN count(disc) = max(n) THEN sum(disc * coverage) / sum(coverage) END AS disc FROM j GROUP BY 1, 2, 3),
basin AS (SELECT basin_id, time, CAST(count(DISTINCT divide_id) AS BIGINT) AS n_divides, round(avg(qty), 9) AS qty, round(avg(disc), 9) AS disc
          FROM catch GROUP BY 1, 2),
older AS (SELECT * FROM basin WHERE basin_id IN ('0', '1') AND year(time) = (SELECT min(year(time)) FROM raster))
SELECT 'killed after catchment' AS phase, * FROM older UNION ALL
SELECT 'killed after dense' AS phase, * FROM older UNION ALL
SELECT 'killed after published' AS phase, * FROM basin UNION ALL
SELECT 'resumed' AS phase, * FROM basin""")
def forcing_job_killed(spark, sf):
    """K1/K2/K3/K9 as one: two basins' first year is published; a run over all basins and years is killed after its first
    write, after its last one and after publishing, then left to end. Both outputs are read after each: they stand at
    the older state until the run is published, never at a mix."""
    from .. import jobs
    root = scratch_path(spark, "killed")
    years = write_raster_stores(spark, sf, f"{root}/stores", dtype="<f8")
    d = views.divides(spark, sf)
    containers.write_divides(d.filter(F.col("basin_id").isin("0", "1")), f"{root}/gpkg-first")
    containers.write_divides(d, f"{root}/gpkg-all")

    def run(name, end, ledger, kill=None):
        def on_step(done):
            if done == kill:
                raise InterruptedError(f"killed after {done}")
        try:
            jobs.forcing_job(spark, root + "/stores/{year}", (years[0], end), ["qty", "disc"], f"{root}/{name}", views.GRID,
                             f"{root}/out", f"{root}/{ledger}", cache=f"{root}/cache", on_step=on_step)
        except InterruptedError:
            pass
        each = jobs.forcing_output(spark, f"{root}/out", "catchment", ["qty", "disc"]).groupBy("basin_id", "time").agg(F.countDistinct("divide_id").alias("n_divides"))
        both = jobs.forcing_output(spark, f"{root}/out", "basin", ["qty", "disc"]).join(each, ["basin_id", "time"], "full")
        return written(both.select(F.lit(f"killed after {kill}" if kill else "resumed").alias("phase"), "basin_id", F.col("time").cast("timestamp_ntz").alias("time"),
                                   "n_divides", r9("qty", "qty"), r9("disc", "disc")), "phase")

    run("gpkg-first", years[0] + 1, "ledger-first")
    phases = [run("gpkg-all", years[-1] + 1, "ledger", kill) for kill in ("catchment", "dense", "published", None)]
    out = phases[0]
    for p in phases[1:]:
        out = out.union(p)
    return out


@register("forcing_job_resume", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CENTRE_COV_SQL + """,
cov AS (SELECT r.*, count(*) OVER (PARTITION BY basin_id, divide_id) AS n FROM centre_cov r),
j AS (SELECT c.basin_id, c.divide_id, r.time, c.coverage, c.n, r.qty, r.disc FROM cov c JOIN raster r USING (iy, ix)),
catch AS (SELECT basin_id, divide_id, time,
         CASE WHEN count(qty) = max(n) THEN sum(qty * coverage) / sum(coverage) END AS qty,
         CASE WHEN count(disc) = max(n) THEN sum(disc * coverage) / sum(coverage) END AS disc FROM j GROUP BY 1, 2, 3)
SELECT basin_id, time, round(avg(qty), 9) AS qty, round(avg(disc), 9) AS disc FROM catch GROUP BY 1, 2""")
def forcing_job_resume(spark, sf):
    """ST3: the job over two basins, again over all of them, and again with nothing pending; the table is whole."""
    from .. import jobs
    root = scratch_path(spark, "resume")
    years = write_raster_stores(spark, sf, f"{root}/stores", dtype="<f8")
    d = views.divides(spark, sf)
    for name, part in (("gpkg-first", d.filter(F.col("basin_id").isin("0", "1"))), ("gpkg-all", d), ("gpkg-all", None)):
        if part is not None:
            containers.write_divides(part, f"{root}/{name}")
        out = jobs.forcing_job(spark, root + "/stores/{year}", (years[0], years[-1] + 1), ["qty", "disc"], f"{root}/{name}",
                               views.GRID, f"{root}/out", f"{root}/ledger")
    return out.select(F.col("basin_id").cast("string").alias("basin_id"), F.col("time").cast("timestamp_ntz").alias("time"), r9("qty", "qty"), r9("disc", "disc"))


@register("forcing_job_filled", sql=V.with_(V.RASTER, V.BOXES) + _NEAREST_SQL + """,
filled AS (SELECT basin_id, divide_id, iy, ix, coverage FROM c5 UNION ALL
           SELECT m.basin_id, b.divide_id, c.iy, c.ix, c.coverage FROM best b JOIN miss m USING (divide_id) JOIN c5 c ON c.divide_id = b.source_id),
cov AS (SELECT f.*, count(*) OVER (PARTITION BY basin_id, divide_id) AS n FROM filled f),
j AS (SELECT c.basin_id, c.divide_id, r.time, c.coverage, c.n, r.qty, r.disc FROM cov c JOIN raster r USING (iy, ix)),
catch AS (SELECT basin_id, divide_id, time,
         CASE WHEN count(qty) = max(n) THEN sum(qty * coverage) / sum(coverage) END AS qty,
         CASE WHEN count(disc) = max(n) THEN sum(disc * coverage) / sum(coverage) END AS disc FROM j GROUP BY 1, 2, 3)
SELECT basin_id, CAST(count(DISTINCT divide_id) AS BIGINT) AS n_divides, time, round(avg(qty), 9) AS qty, round(avg(disc), 9) AS disc
FROM catch GROUP BY basin_id, time""")
def forcing_job_filled(spark, sf):
    """J3 in the job: on a grid that misses some catchments, each of them still has a series."""
    from .. import jobs
    root = scratch_path(spark, "filled")
    years = write_raster_stores(spark, sf, f"{root}/stores", dtype="<f8")
    containers.write_divides(views.divides(spark, sf), f"{root}/gpkg")
    basin = jobs.forcing_job(spark, root + "/stores/{year}", (years[0], years[-1] + 1), ["qty", "disc"], f"{root}/gpkg", G5,
                             f"{root}/out", f"{root}/ledger", cells="touch")
    each = jobs.forcing_output(spark, f"{root}/out", "catchment", ["qty", "disc"]).groupBy("basin_id", "time").agg(F.countDistinct("divide_id").alias("n_divides"))
    b = basin.join(each, ["basin_id", "time"])
    return b.select("basin_id", "n_divides", F.col("time").cast("timestamp_ntz").alias("time"), r9("qty", "qty"), r9("disc", "disc"))
