"""Queries: rounding, water years, dates, catalog, ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import catalog
from . import sql_views as V
from . import views
from .registry import register

ROUND_SPEC = {"qty": 3, "disc": 5, "TMP_2maboveground": 4}  # the last is absent: P10 skips it


@register("round_decimals", sql=V.with_(V.RASTER) + """
SELECT time, iy, ix, round_even(qty * CAST(1000.0 AS DOUBLE), 0) / CAST(1000.0 AS DOUBLE) AS qty,
       round_even(disc * CAST(100000.0 AS DOUBLE), 0) / CAST(100000.0 AS DOUBLE) AS disc FROM raster""")
def round_decimals(spark, sf):
    r = views.raster(spark, sf).select("time", "iy", "ix", "qty", "disc")
    return S.round_columns(r, ROUND_SPEC)


_SIG = "(3 - floor(log10(abs(value))) - 1)"


@register("round_sigfigs", sql=V.with_(V.WATER) + f"""
SELECT key, CASE WHEN value IS NULL OR value = 0 THEN value
                 WHEN {_SIG} >= 0 THEN round_even(value * pow(10.0, {_SIG}), 0) / pow(10.0, {_SIG})
                 ELSE round_even(value / pow(10.0, -{_SIG}), 0) * pow(10.0, -{_SIG}) END AS value
FROM water""")
def round_sigfigs(spark, sf):
    w = views.water(spark, sf)
    return w.select("key", S.round_sigfigs("value", 3).alias("value"))


@register("water_year_summary", sql=V.with_(V.WATER) + """
SELECT CAST(year(time) + CASE WHEN month(time) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS water_year,
       CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS total, min(time) AS first_time, max(time) AS last_time
FROM water GROUP BY 1""")
def water_year_summary(spark, sf):
    w = views.water(spark, sf).withColumn("water_year", S.water_year("time"))
    return w.groupBy("water_year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"),
                                       F.min("time").alias("first_time"), F.max("time").alias("last_time"))


@register("water_year_window", sql=V.with_(V.WATER) + """
SELECT key, CAST(year(time) + CASE WHEN month(time) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS water_year,
       time AS window_start,
       least(time + to_hours(CAST(key % 2000 AS BIGINT)),
             make_timestamp(year(time) + CASE WHEN month(time) >= 10 THEN 1 ELSE 0 END, 9, 30, 23, 59, 59)) AS window_end
FROM water""")
def water_year_window(spark, sf):
    w = views.water(spark, sf)
    return w.select("key", S.water_year("time").alias("water_year"), F.col("time").alias("window_start"),
                    S.clamp_to_water_year("time", (F.col("key") % 2000).cast("int")).alias("window_end"))


@register("date_spine", sql="""
WITH b AS (SELECT CAST(min(ts) AS DATE) AS d0, CAST(max(ts) AS DATE) AS d1 FROM events),
d AS (SELECT unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS d FROM b)
SELECT strftime(d, '%Y%m%d') AS day, lpad(CAST(h.range AS VARCHAR), 2, '0') AS hour FROM d, range(24) h""")
def date_spine(spark, sf):
    ev = views.table(spark, sf, "events")
    b = ev.agg(F.to_date(F.min("ts")).alias("d0"), F.to_date(F.max("ts")).alias("d1"))
    return catalog.date_spine(b)


@register("hour_decode", sql="""
SELECT event_id, TIMESTAMP '1980-01-01 00:00:00' + to_hours(event_id) AS time FROM events""")
def hour_decode(spark, sf):
    ev = views.table(spark, sf, "events")
    return ev.select("event_id", S.hours_since("event_id").alias("time"))


@register("parse_timestamps", sql="""
WITH s AS (SELECT event_id, CASE WHEN user_id % 5 = 0 THEN props ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS s FROM events)
SELECT event_id, s AS raw, try_strptime(s, '%Y-%m-%d %H:%M:%S') AS parsed FROM s""")
def parse_timestamps(spark, sf):
    ev = views.table(spark, sf, "events")
    raw = F.when(F.col("user_id") % 5 == 0, F.col("props")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return ev.select("event_id", raw.alias("raw")).select("event_id", "raw", S.parse_time("raw", strict=False).alias("parsed"))


@register("catalog_paths", sql=V.with_(V.RUNS) + """,
r AS (SELECT DISTINCT init_hour, CASE WHEN step = 0 THEN 'anl' ELSE 'fcst' END AS kind FROM runs),
p AS (SELECT 'sfc/' || strftime(init_hour, '%Y%m%d') || '/' || strftime(init_hour, '%Y%m%d') || '_' || strftime(init_hour, '%H') || 'z_' || kind || '.zarr' AS path,
             strftime(init_hour, '%Y%m%d') AS day, init_hour, kind,
             unnest(CASE WHEN kind = 'anl' THEN ['2m_above_ground/TMP', '2m_above_ground/SPFH', 'surface/DLWRF', 'surface/DSWRF',
                  'surface/PRES', '10m_above_ground/UGRD', '10m_above_ground/VGRD'] ELSE ['surface/APCP_1hr_acc_fcst'] END) AS lv FROM r)
SELECT path, day, init_hour, kind, split_part(lv, '/', 1) AS level, split_part(lv, '/', 2) AS variable,
       path || '/' || split_part(lv, '/', 1) || '/' || split_part(lv, '/', 2) || '/' || split_part(lv, '/', 1) AS data_path,
       path || '/' || split_part(lv, '/', 1) || '/' || split_part(lv, '/', 2) AS meta_path
FROM p""")
def catalog_paths(spark, sf):
    r = views.runs(spark, sf).select("init_hour", F.when(F.col("step") == 0, "anl").otherwise("fcst").alias("kind")).distinct()
    return catalog.run_paths(r)


@register("catalog_ids", sql="""
WITH names AS (SELECT 'basins/Gage_' || CAST(c_custkey AS VARCHAR) || '.gpkg' AS path FROM customer
               UNION ALL SELECT 'basins/Gage_' || CAST(o_custkey AS VARCHAR) || '_' || CAST(o_orderkey AS VARCHAR) || '.csv' FROM orders)
SELECT DISTINCT split_part(regexp_replace(regexp_extract(path, '([^/]+)$', 1), '\\.gpkg$', ''), 'Gage_', 2) AS basin_id
FROM names WHERE regexp_extract(path, '([^/]+)$', 1) LIKE 'Gage_%.gpkg'""")
def catalog_ids(spark, sf):
    c = views.table(spark, sf, "customer").select(F.concat(F.lit("basins/Gage_"), F.col("c_custkey").cast("string"), F.lit(".gpkg")).alias("path"))
    o = views.table(spark, sf, "orders").select(
        F.concat(F.lit("basins/Gage_"), F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("path"))
    return catalog.ids_from_names(c.unionByName(o))


@register("gage_pad", sql="""
WITH g AS (SELECT CAST(c_custkey * 1000 + c_nationkey AS VARCHAR) AS raw FROM customer)
SELECT raw, CASE WHEN length(raw) = 7 THEN '0' || raw ELSE raw END AS gage_id FROM g""")
def gage_pad(spark, sf):
    c = views.table(spark, sf, "customer").select((F.col("c_custkey") * 1000 + F.col("c_nationkey")).cast("string").alias("raw"))
    return c.select("raw", S.pad_gage("raw").alias("gage_id"))


@register("numeric_suffix_order", sql=V.with_(V.FLOW) + """,
steps AS (SELECT DISTINCT time FROM flow),
n AS (SELECT 'frame_' || CAST(CAST(dense_rank() OVER (ORDER BY time) - 1 AS INTEGER) AS VARCHAR) || '.png' AS name FROM steps)
SELECT name, CAST(row_number() OVER (ORDER BY CAST(regexp_extract(name, '_(\\d+)\\.', 1) AS INTEGER)) AS INTEGER) AS position FROM n""")
def numeric_suffix_order(spark, sf):
    from ..operators.evaluate import position_index
    from ..operators.ordering import ordered_index
    idx = position_index(views.flow(spark, sf), "time", "time_idx")
    names = idx.select(F.concat(F.lit("frame_"), F.col("time_idx").cast("string"), F.lit(".png")).alias("name"))
    pos = ordered_index(names.withColumn("_k", S.numeric_suffix("name")), ["_k"], "position")  # O4
    return pos.select("name", (F.col("position") + 1).cast("int").alias("position"))
