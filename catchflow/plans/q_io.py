"""Queries that write with a sink and read back with a source.

Each writes under a fresh folder inside the shared checkpoint folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks
from ..functions import geometry as geo
from ..functions import scalars as S
from ..operators import forcing, pack, post
from ..session import scratch_path
from ..sources import series as src
from . import sql_views as V
from . import views
from .q_forcing import G, _CATCH_SQL, rect_coverage
from .registry import r9, register


@register("series_roundtrip", sql=V.with_(V.SERIES) + """
SELECT datetime, id, round(value, 9) AS value FROM series""")
def series_roundtrip(spark, sf):
    s = views.series(spark, sf).withColumn(
        "index", F.timestamp_diff("HOUR", F.lit(S.EPOCH_1980).cast("timestamp_ntz"), F.col("datetime")))
    path = scratch_path(spark, "nexus")
    sinks.write_nexus_files(s, path)
    back = src.scan_nexus(spark, path)
    return back.select("datetime", F.col("nex_id").alias("id"), r9("value", "value"))


@register("catchment_files_roundtrip", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, divide_id, time, round(qty, 9) AS qty, round(disc, 9) AS disc FROM catch""")
def catchment_files_roundtrip(spark, sf):
    c = forcing.catchment_mean(views.raster(spark, sf), rect_coverage(spark, sf), views.RASTER_VARS)
    path = scratch_path(spark, "catchment")
    sinks.write_catchment_series(c, path)  # K2
    back = src.scan_series(spark, path, "time string, qty double, disc double", "time", with_path=True)
    back = back.select(F.regexp_extract("source_path", r"basin_id=([^/]+)", 1).alias("basin_id"),
                       F.regexp_extract("source_path", r"divide_id=([^/]+)", 1).alias("divide_id"),
                       "time", r9("qty", "qty"), r9("disc", "disc"))
    return back


@register("compile_gage", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT '0100000' || basin_id AS gage_id, '0100000' || basin_id AS divide_id, time,
       round(avg(qty), 9) AS qty, round(avg(disc), 9) AS disc FROM catch GROUP BY basin_id, time""")
def compile_gage(spark, sf):
    c = forcing.catchment_mean(views.raster(spark, sf), rect_coverage(spark, sf), views.RASTER_VARS)
    b = forcing.basin_mean(c, views.RASTER_VARS)
    daily = scratch_path(spark, "daily")
    # daily files per basin and day (the forecast job's output layout): basin_id=<id>/day=<yyyyMMdd>/*.csv
    (sinks._ts_strings(b.withColumn("day", S.day_string("time")).repartition("basin_id", "day"))
        .write.partitionBy("basin_id", "day").option("header", True).csv(daily))
    g = post.compile_gage(spark, daily, "time string, qty double, disc double",
                          gage_from=lambda b_: F.concat(F.lit("100000"), b_))
    out = scratch_path(spark, "gage")
    sinks.write_gage_series(g, out)
    back = src.scan_series(spark, out, "time string, qty double, disc double, divide_id string", "time", with_path=True)
    back = back.withColumn("gage_id", F.regexp_extract("source_path", r"gage_id=([^/]+)", 1))
    return back.select("gage_id", "divide_id", "time", r9("qty", "qty"), r9("disc", "disc"))


@register("water_year_roundtrip", sql=V.with_(V.WATER) + """
SELECT key, time, value, CAST(year(time) + CASE WHEN month(time) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS water_year FROM water""")
def water_year_roundtrip(spark, sf):
    w = views.water(spark, sf)
    path = scratch_path(spark, "wy")
    sinks.write_water_years(w, path, by=[], compression="gzip")  # K6 + K7
    back = src.scan_series(spark, path, "key bigint, time string, value double, water_year int", "time")
    return back.select("key", "time", "value", "water_year")


@register("coverage_cache_roundtrip", sql=V.with_(V.BOXES, V.GRID10, V.RECT_COV) + """
SELECT basin_id, divide_id, cell_id, iy, ix, round(coverage, 9) AS coverage FROM rect_cov""")
def coverage_cache_roundtrip(spark, sf):
    root = scratch_path(spark, "covcache")
    d = views.divides(spark, sf)
    post.cached_coverage(spark, root, "nations", views.divides(spark, sf, "tri"), G, cells="touch")  # other polygons: a cache of their own
    post.cached_coverage(spark, root, "nations", d, G, cells="touch")        # computes and writes
    c = post.cached_coverage(spark, root, "nations", d, G, cells="touch")    # reads the cache
    return c.select("basin_id", "divide_id", "cell_id", "iy", "ix", r9("coverage", "coverage"))


@register("array_table_roundtrip", sql=V.with_(V.FLOW) + """
SELECT feature_id AS ids, CAST(year(time) AS INTEGER) AS chunk,
       CAST(row_number() OVER (PARTITION BY feature_id, year(time) ORDER BY time) - 1 AS INTEGER) AS time_idx,
       time, round(flow, 6) AS flow FROM flow""")
def array_table_roundtrip(spark, sf):
    fl = views.flow(spark, sf)
    dense = pack.to_dense(fl, ["flow"], chunk="year", id_col="feature_id")  # K1: arrays per feature and year
    path = scratch_path(spark, "routed")
    sinks.write_dense(dense, path)
    back = src.scan_routed(spark, path, "Time", "flow")  # S7
    return back.select("ids", "chunk", "time_idx", "time", F.round("flow", 6).alias("flow"))


@register("reference_scan", sql=V.with_(V.SERIES) + """
SELECT id AS basin, datetime AS date, round(value, 9) AS total_precipitation FROM series""")
def reference_scan(spark, sf):
    s = views.series(spark, sf).select(F.col("id").alias("basin"), F.col("datetime").alias("date"),
                                       F.col("value").alias("total_precipitation"))
    path = scratch_path(spark, "reference")
    s.write.partitionBy("basin").parquet(path)
    back = src.scan_reference(spark, path)
    return back.select("basin", "date", r9("total_precipitation", "total_precipitation"))


@register("select_label", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, time, round(avg(qty), 9) AS qty, round(avg(disc), 9) AS disc FROM catch WHERE basin_id = '3' GROUP BY 1, 2""")
def select_label(spark, sf):
    c = forcing.catchment_mean(views.raster(spark, sf), rect_coverage(spark, sf), views.RASTER_VARS)
    b = forcing.basin_mean(c.filter(F.col("basin_id") == "3"), views.RASTER_VARS)  # P8: filter pushed below the aggregate
    return b.select("basin_id", "time", r9("qty", "qty"), r9("disc", "disc"))


@register("missing_labels", sql=V.with_(V.BOXES) + """
SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS basin_id FROM customer
WHERE CAST(c_nationkey AS VARCHAR) NOT IN (SELECT basin_id FROM boxes)""")
def missing_labels(spark, sf):
    requested = views.table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("basin_id")).distinct()
    have = views.divides(spark, sf).select("basin_id").distinct()
    return requested.join(have, "basin_id", "left_anti")  # P8 not-found report as an anti-join


@register("reproject_identity", sql=V.with_(V.BOXES) + """
SELECT divide_id, 'EPSG:5070' AS crs, x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax FROM boxes""")
def reproject_identity(spark, sf):
    d = views.divides(spark, sf)
    d = geo.reproject(d, "EPSG:4326")                                  # G4: already in the target system
    d = geo.set_crs(d, "EPSG:5070")                                    # G5: label only, no vertex moves
    bb = geo.bbox(F.col("rings"))
    return d.select("divide_id", "crs", bb["xmin"].alias("xmin"), bb["ymin"].alias("ymin"),
                    bb["xmax"].alias("xmax"), bb["ymax"].alias("ymax"))


@register("basin_files_roundtrip", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, time, round(avg(qty), 9) AS qty, round(avg(disc), 9) AS disc FROM catch GROUP BY 1, 2""")
def basin_files_roundtrip(spark, sf):
    """K3 write, S11 read (basin id parsed from the path, every file in one read)."""
    c = forcing.catchment_mean(views.raster(spark, sf), rect_coverage(spark, sf), views.RASTER_VARS)
    path = scratch_path(spark, "basin")
    sinks.write_basin_series(forcing.basin_mean(c, views.RASTER_VARS), path)
    back = src.scan_daily_basin_files(spark, path, "time string, qty double, disc double")
    return back.select("basin_id", "time", r9("qty", "qty"), r9("disc", "disc"))


@register("rounded_files_roundtrip", sql=V.with_(V.RASTER) + """
SELECT time, iy, ix, round_even(qty * CAST(1000.0 AS DOUBLE), 0) / CAST(1000.0 AS DOUBLE) AS qty,
       round_even(disc * CAST(100000.0 AS DOUBLE), 0) / CAST(100000.0 AS DOUBLE) AS disc FROM raster""")
def rounded_files_roundtrip(spark, sf):
    """K5: per-variable rounding written as CSV, read back."""
    r = views.raster(spark, sf).select("time", "iy", "ix", "qty", "disc")
    path = scratch_path(spark, "rounded")
    sinks.write_rounded(r, path, {"qty": 3, "disc": 5})
    return src.scan_series(spark, path, "time string, iy bigint, ix bigint, qty double, disc double", "time")


@register("raster_table_roundtrip", sql=V.with_(V.RASTER) + """
SELECT time, iy, ix, qty, disc FROM raster""")
def raster_table_roundtrip(spark, sf):
    """S1 table layout: write partitioned by year and 5 x 5 tiles, read every year back (end-exclusive range)."""
    r = views.raster(spark, sf).select("time", "iy", "ix", "qty", "disc")
    path = scratch_path(spark, "raster")
    sinks.write_raster(r, path, tile=5)
    y0, y1 = r.agg(F.min(F.year("time")), F.max(F.year("time"))).first()
    return src.scan_raster_table(spark, path, years=(y0, y1 + 1), tile=5, variables=["qty", "disc"])


@register("post_process_files", sql=V.with_(V.RASTER) + """
SELECT CAST(iy * 10 + ix AS VARCHAR) AS series_id, time,
       round_even(qty * CAST(1000.0 AS DOUBLE), 0) / CAST(1000.0 AS DOUBLE) AS PRES_surface,
       round_even(disc * CAST(10000000.0 AS DOUBLE), 0) / CAST(10000000.0 AS DOUBLE) AS SPFH_2maboveground,
       CAST(year(time) + CASE WHEN month(time) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS water_year
FROM raster""")
def post_process_files(spark, sf):
    """The post-processing job on series files: the fixed per-variable decimals (the two present variables
    here, the six absent ones skipped), water-year split, gzip; read back."""
    from .. import jobs
    r = views.raster(spark, sf).select(
        "time", (F.col("iy") * 10 + F.col("ix")).cast("string").alias("divide_id"), F.lit("0").alias("basin_id"),
        F.col("qty").alias("PRES_surface"), F.col("disc").alias("SPFH_2maboveground"))
    src_path, out = scratch_path(spark, "series"), scratch_path(spark, "post")
    sinks.write_catchment_series(r, src_path)
    jobs.post_process_job(spark, src_path, "time string, PRES_surface double, SPFH_2maboveground double", out)
    back = src.scan_series(spark, out, "time string, PRES_surface double, SPFH_2maboveground double, "
                                       "series_id string, water_year int", "time")
    return back.select("series_id", "time", "PRES_surface", "SPFH_2maboveground", "water_year")


@register("evaluation_files", sql=V.with_(V.SERIES) + """,
m0 AS (SELECT datetime, id, value FROM series WHERE id IN ('error', 'purchase', 'signup', 'view')),
mem AS (SELECT * FROM m0 UNION ALL SELECT datetime, 'mean' AS id, avg(value) AS value FROM m0 GROUP BY datetime),
obs AS (SELECT datetime, value AS obs FROM series WHERE id = 'click'),
j AS (SELECT m.id, o.obs, m.value FROM mem m JOIN obs o USING (datetime) WHERE o.obs IS NOT NULL AND m.value IS NOT NULL),
a AS (SELECT id, avg(obs) AS mo FROM j GROUP BY 1)
SELECT '01187300' AS gage_id, id,
       round(CASE WHEN sum((obs - mo) * (obs - mo)) > 0 THEN 1 - sum((obs - value) * (obs - value)) / sum((obs - mo) * (obs - mo)) END, 9) AS nse,
       CAST(count(*) AS BIGINT) AS n
FROM j JOIN a USING (id) GROUP BY id""")
def evaluation_files(spark, sf):
    """The evaluation notebook as a job: members written as nexus output files, the observed series as a
    discharge CSV (header ``date,QObs(mm/h)``, gage id in the name), then ensemble + NSE table."""
    from .. import jobs
    s = views.series(spark, sf)
    root = scratch_path(spark, "eval")
    mem = s.filter(F.col("id").isin(views.MEMBERS)).withColumn(
        "index", F.timestamp_diff("HOUR", F.lit(S.EPOCH_1980).cast("timestamp_ntz"), F.col("datetime")))
    sinks.write_nexus_files(mem, f"{root}/nexus")
    obs = s.filter(F.col("id") == views.OBSERVED).select(
        F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("date"), F.col("value").alias("QObs(mm/h)"))
    obs.write.option("header", True).csv(f"{root}/obs/01187300-usgs-hourly")
    t = jobs.evaluation_job(spark, f"{root}/nexus", f"{root}/obs")
    return t.select("gage_id", "id", r9("nse", "nse"), F.col("n").cast("bigint"))


@register("nexus_map_files", sql=V.with_(V.NEXUS, V.NEXUS_VALUES) + """,
lv AS (SELECT 'nex-' || nex_id AS id, arg_max(value, "index") AS value FROM nexus_values GROUP BY nex_id),
m AS (SELECT n.vpu, n.id, coalesce(lv.value, 0.0) AS value FROM nexus n LEFT JOIN lv USING (id)),
b AS (SELECT vpu, min(value) AS lo, max(value) AS hi FROM m GROUP BY 1),
a AS (SELECT min(value) AS alo, max(value) AS ahi FROM m)
SELECT vpu, id, round(value, 9) AS value,
       round(CASE WHEN hi = lo THEN 1.0 ELSE 0.1 + 0.6 * (value - lo) / (hi - lo) END, 9) AS scaled_region,
       round(CASE WHEN ahi = alo THEN 1.0 ELSE 0.1 + 0.6 * (value - alo) / (ahi - alo) END, 9) AS scaled_all
FROM m JOIN b USING (vpu), a""")
def nexus_map_files(spark, sf):
    """The regional nexus map job: nexus output files written per region folder (``<vpu>/nex-<id>_output``),
    read back in one scan, last value, zero fill, rescaled per region and overall."""
    from .. import jobs
    nx = views.nexus(spark, sf)
    vals = views.nexus_values(spark, sf)
    region_of = nx.select("vpu", F.regexp_extract("id", r"nex-(.+)", 1).alias("nex_id"))
    per_region = vals.join(region_of, "nex_id", "left").select(
        F.coalesce("vpu", F.lit("none")).alias("vpu"), F.col("nex_id").alias("id"), "index",
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("datetime"), "value")
    root = scratch_path(spark, "regions")
    sinks.write_nexus_files(per_region, root, partition_by=["vpu"])
    m = jobs.nexus_map_job(spark, root, nx)
    return m.select("vpu", "id", r9("value", "value"), r9("scaled_region", "scaled_region"), r9("scaled_all", "scaled_all"))


@register("routing_frames_files", sql=V.with_(V.NEXUS, V.FLOW) + """,
steps AS (SELECT time, CAST(dense_rank() OVER (ORDER BY time) - 1 AS INTEGER) AS time_idx FROM (SELECT DISTINCT time FROM flow)),
vals AS (SELECT 'nex-' || CAST(feature_id AS VARCHAR) AS id, time_idx, flow AS value FROM flow JOIN steps USING (time) WHERE time_idx BETWEEN 5 AND 12),
frames AS (SELECT vpu, id, CAST(f.range AS INTEGER) AS time_idx FROM nexus, range(5, 13) f),
m AS (SELECT vpu, id, time_idx, coalesce(value, 0.0) AS value FROM frames LEFT JOIN vals USING (id, time_idx)),
b AS (SELECT time_idx, min(value) AS lo, max(value) AS hi FROM m GROUP BY 1)
SELECT vpu, id, time_idx, round(value, 6) AS value,
       round(CASE WHEN hi > lo THEN pow((value - lo) / (hi - lo), 0.4) END, 9) AS norm FROM m JOIN b USING (time_idx)""")
def routing_frames_files(spark, sf):
    """The routing-frames job from files: routed flow written as array tables (K1 layout per feature and
    year), read back (S7), frames 5..12 for every nexus, zero fill, per-frame power norm."""
    from .. import jobs
    fl = views.flow(spark, sf).select(F.col("feature_id").cast("string").alias("feature_id"), "time", "flow")
    path = scratch_path(spark, "routed")
    sinks.write_dense(pack.to_dense(fl, ["flow"], chunk="year", id_col="feature_id"), path)
    t = jobs.routing_frames_job(spark, path, views.nexus(spark, sf), 5, 12)
    return t.select("vpu", "id", "time_idx", F.round("value", 6).alias("value"), r9("norm", "norm"))
