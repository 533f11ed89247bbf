"""Queries: ensembles, NSE, routed-flow features, map tables, comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import compare, evaluate, forcing, maps
from . import sql_views as V
from . import views
from .q_forcing import rect_coverage
from .registry import r9, register

MEMBERS_SQL = "('error', 'purchase', 'signup', 'view')"


def obs_members(spark, sf):
    s = views.series(spark, sf)
    obs = s.filter(F.col("id") == views.OBSERVED).select("datetime", F.col("value").alias("obs"))
    mem = s.filter(F.col("id").isin(views.MEMBERS))
    return obs, mem


@register("ensemble_wide", sql=V.with_(V.SERIES) + """
SELECT datetime, max(CASE WHEN id = 'error' THEN value END) AS error, max(CASE WHEN id = 'purchase' THEN value END) AS purchase,
       max(CASE WHEN id = 'signup' THEN value END) AS signup, max(CASE WHEN id = 'view' THEN value END) AS view
FROM series WHERE id IN ('error', 'purchase', 'signup', 'view') GROUP BY 1""")
def ensemble_wide(spark, sf):
    _, mem = obs_members(spark, sf)
    return evaluate.ensemble_wide(mem, views.MEMBERS)


@register("ensemble_mean", sql=V.with_(V.SERIES) + f"""
SELECT datetime, round(avg(value), 9) AS value FROM series WHERE id IN {MEMBERS_SQL} GROUP BY 1""")
def ensemble_mean(spark, sf):
    _, mem = obs_members(spark, sf)
    return evaluate.ensemble_mean(mem).select("datetime", r9("value", "value"))


_NSE_MASKED = """,
obs AS (SELECT datetime, value AS obs FROM series WHERE id = 'click'),
j AS (SELECT m.id, o.obs, m.value FROM {members} m JOIN obs o USING (datetime) WHERE o.obs IS NOT NULL AND m.value IS NOT NULL),
a AS (SELECT id, avg(obs) AS mo FROM j GROUP BY 1)
SELECT id, round(CASE WHEN sum((obs - mo) * (obs - mo)) > 0 THEN 1 - sum((obs - value) * (obs - value)) / sum((obs - mo) * (obs - mo)) END, 9) AS nse,
       CAST(count(*) AS BIGINT) AS n
FROM j JOIN a USING (id) GROUP BY id"""


@register("nse_masked", sql=V.with_(V.SERIES) + f""",
mem AS (SELECT datetime, id, value FROM series WHERE id IN {MEMBERS_SQL})""" + _NSE_MASKED.format(members="mem"))
def nse_masked(spark, sf):
    obs, mem = obs_members(spark, sf)
    return evaluate.nse_table(obs, mem, "masked").select("id", r9("nse", "nse"), F.col("n").cast("bigint"))


@register("nse_table", sql=V.with_(V.SERIES) + f""",
m0 AS (SELECT datetime, id, value FROM series WHERE id IN {MEMBERS_SQL}),
mem AS (SELECT * FROM m0 UNION ALL SELECT datetime, 'mean' AS id, avg(value) AS value FROM m0 GROUP BY datetime)""" + _NSE_MASKED.format(members="mem"))
def nse_table(spark, sf):
    obs, mem = obs_members(spark, sf)
    allm = evaluate.with_mean_member(mem)
    return evaluate.nse_table(obs, allm, "masked").select("id", r9("nse", "nse"), F.col("n").cast("bigint"))


@register("nse_obs_all", sql=V.with_(V.SERIES) + f""",
obs AS (SELECT datetime, value AS obs FROM series WHERE id = 'click' AND datetime >= TIMESTAMP '2024-01-01' AND datetime < TIMESTAMP '2025-01-01'),
den AS (SELECT sum((obs - (SELECT avg(obs) FROM obs)) * (obs - (SELECT avg(obs) FROM obs))) AS den FROM obs WHERE obs IS NOT NULL),
j AS (SELECT m.id, o.obs, m.value FROM series m JOIN obs o USING (datetime) WHERE m.id IN {MEMBERS_SQL} AND o.obs IS NOT NULL AND m.value IS NOT NULL)
SELECT id, round(CASE WHEN max(den) > 0 THEN 1 - sum((obs - value) * (obs - value)) / max(den) END, 9) AS nse, CAST(count(*) AS BIGINT) AS n
FROM j, den GROUP BY id""")
def nse_obs_all(spark, sf):
    obs, mem = obs_members(spark, sf)
    obs = obs.filter((F.col("datetime") >= F.lit("2024-01-01").cast("timestamp_ntz"))
                     & (F.col("datetime") < F.lit("2025-01-01").cast("timestamp_ntz")))  # P6 year slice
    return evaluate.nse_table(obs, mem, "obs_all").select("id", r9("nse", "nse"), F.col("n").cast("bigint"))


# ---------------------------------------------------------------- routed flow

def flow_stats(spark, sf):
    fl = views.flow(spark, sf)
    idx = evaluate.position_index(fl, "feature_id", "feature_idx")
    return fl, idx, evaluate.feature_stats(fl, idx)


_FSTATS = """,
idx AS (SELECT feature_id, CAST(dense_rank() OVER (ORDER BY feature_id) - 1 AS INTEGER) AS feature_idx FROM (SELECT DISTINCT feature_id FROM flow)),
st AS (SELECT feature_id, coalesce(bool_or(flow <> 0), false) AS nonzero, max(flow) AS peak, sum(flow) AS flow_sum,
              CAST(count(*) FILTER (WHERE flow > 0) AS BIGINT) AS duration FROM flow GROUP BY 1),
s AS (SELECT * FROM st JOIN idx USING (feature_id))
"""


@register("nonzero_features", sql=V.with_(V.FLOW) + _FSTATS + """
SELECT feature_idx, feature_id, round(peak, 6) AS peak, round(flow_sum, 6) AS flow_sum, duration FROM s WHERE nonzero""")
def nonzero_features(spark, sf):
    _, _, st = flow_stats(spark, sf)
    return st.filter("nonzero").select("feature_idx", "feature_id", F.round("peak", 6).alias("peak"),
                                       F.round("flow_sum", 6).alias("flow_sum"), "duration")


def _top_sql(metric: str) -> str:
    return V.with_(V.FLOW) + _FSTATS + f"""
SELECT feature_idx, feature_id, '{metric}' AS metric, round(CAST({metric} AS DOUBLE), 6) AS score
FROM s WHERE nonzero ORDER BY {metric} DESC, feature_idx ASC LIMIT 1"""


def _top(metric):
    def q(spark, sf):
        _, _, st = flow_stats(spark, sf)
        t = evaluate.top_feature(st, metric)
        return t.select("feature_idx", "feature_id", "metric", F.round("score", 6).alias("score"))
    return q


register("peak_feature", sql=_top_sql("peak"))(_top("peak"))
register("volume_feature", sql=_top_sql("flow_sum"))(_top("flow_sum"))
register("duration_feature", sql=_top_sql("duration"))(_top("duration"))


@register("first_nonzero", sql=V.with_(V.FLOW) + _FSTATS + """,
f AS (SELECT feature_idx, feature_id FROM s WHERE nonzero ORDER BY feature_idx LIMIT 1)
SELECT f.feature_idx, f.feature_id, flow.time, round(flow.flow, 6) AS flow FROM f JOIN flow USING (feature_id)""")
def first_nonzero(spark, sf):
    fl, _, st = flow_stats(spark, sf)
    f = evaluate.first_nonzero(st)
    return f.join(fl, "feature_id").select("feature_idx", "feature_id", "time", F.round("flow", 6).alias("flow"))


_STEPS = """,
steps AS (SELECT time, CAST(dense_rank() OVER (ORDER BY time) - 1 AS INTEGER) AS time_idx FROM (SELECT DISTINCT time FROM flow))
"""


@register("position_select", sql=V.with_(V.FLOW) + _FSTATS + _STEPS + """
SELECT s.feature_idx, s.feature_id, st.time_idx, round(flow.flow, 6) AS flow
FROM s JOIN flow USING (feature_id) JOIN steps st USING (time) WHERE s.feature_idx = 28""")
def position_select(spark, sf):
    fl, idx, _ = flow_stats(spark, sf)
    steps = evaluate.position_index(fl, "time", "time_idx")
    one = idx.filter(F.col("feature_idx") == 28)
    return (fl.join(one, "feature_id").join(steps, "time")
              .select("feature_idx", "feature_id", "time_idx", F.round("flow", 6).alias("flow")))


@register("step_range", sql=V.with_(V.FLOW) + _STEPS + """
SELECT feature_id, time_idx, round(flow, 6) AS flow FROM flow JOIN steps USING (time) WHERE time_idx BETWEEN 10 AND 20""")
def step_range(spark, sf):
    fl = views.flow(spark, sf)
    steps = evaluate.position_index(fl, "time", "time_idx").filter(F.col("time_idx").between(10, 20))
    return fl.join(steps, "time").select("feature_id", "time_idx", F.round("flow", 6).alias("flow"))


@register("three_way_join", sql=V.with_(V.FLOW, V.SERIES) + _FSTATS + f""",
f AS (SELECT feature_id FROM s WHERE nonzero ORDER BY feature_idx LIMIT 1),
routed AS (SELECT time AS datetime, flow AS routed FROM flow JOIN f USING (feature_id)),
ens AS (SELECT datetime, avg(value) AS ens FROM series WHERE id IN {MEMBERS_SQL} GROUP BY 1),
obs AS (SELECT datetime, value AS obs FROM series WHERE id = 'click')
SELECT datetime, round(routed, 6) AS routed, round(ens, 9) AS ens, round(obs, 9) AS obs
FROM routed JOIN ens USING (datetime) JOIN obs USING (datetime)
WHERE datetime >= TIMESTAMP '2024-01-01' AND datetime < TIMESTAMP '2025-01-01'""")
def three_way_join(spark, sf):
    fl, _, st = flow_stats(spark, sf)
    f = evaluate.first_nonzero(st).select("feature_id")
    routed = fl.join(f, "feature_id").select(F.col("time").alias("datetime"), F.col("flow").alias("routed"))
    obs, mem = obs_members(spark, sf)
    ens = evaluate.ensemble_mean(mem).withColumnRenamed("value", "ens")
    j = evaluate.join_three(routed, ens, obs, year=2024)
    return j.select("datetime", F.round("routed", 6).alias("routed"), r9("ens", "ens"), r9("obs", "obs"))


# ---------------------------------------------------------------- map tables

_LAST = """,
lv AS (SELECT 'nex-' || nex_id AS id, arg_max(value, "index") AS value FROM nexus_values GROUP BY nex_id),
m AS (SELECT n.vpu, n.id, coalesce(lv.value, 0.0) AS value FROM nexus n LEFT JOIN lv USING (id))
"""


def last_map(spark, sf):
    lv = maps.last_value(views.nexus_values(spark, sf)).select(S.nex_id("nex_id").alias("id"), "value")
    return maps.map_table(views.nexus(spark, sf), lv, ["id"], fill=0.0)


@register("last_value_map", sql=V.with_(V.NEXUS, V.NEXUS_VALUES) + _LAST + "SELECT vpu, id, round(value, 9) AS value FROM m")
def last_value_map(spark, sf):
    return last_map(spark, sf).select("vpu", "id", r9("value", "value"))


@register("rescale_region", sql=V.with_(V.NEXUS, V.NEXUS_VALUES) + _LAST + """,
b AS (SELECT vpu, min(value) AS lo, max(value) AS hi FROM m GROUP BY 1)
SELECT vpu, id, round(value, 9) AS value,
       round(CASE WHEN hi = lo THEN 1.0 ELSE 0.1 + 0.6 * (value - lo) / (hi - lo) END, 9) AS scaled FROM m JOIN b USING (vpu)""")
def rescale_region(spark, sf):
    m = maps.rescale(last_map(spark, sf), "value", by=["vpu"])
    return m.select("vpu", "id", r9("value", "value"), r9("scaled", "scaled"))


@register("rescale_all", sql=V.with_(V.NEXUS, V.NEXUS_VALUES) + _LAST + """,
b AS (SELECT min(value) AS lo, max(value) AS hi FROM m)
SELECT vpu, id, round(value, 9) AS value,
       round(CASE WHEN hi = lo THEN 1.0 ELSE 0.1 + 0.6 * (value - lo) / (hi - lo) END, 9) AS scaled FROM m, b""")
def rescale_all(spark, sf):
    m = maps.rescale(last_map(spark, sf), "value", by=None)
    return m.select("vpu", "id", r9("value", "value"), r9("scaled", "scaled"))


@register("step_map", sql=V.with_(V.NEXUS, V.FLOW) + _STEPS + """,
vals AS (SELECT 'nex-' || CAST(feature_id AS VARCHAR) AS id, time_idx, flow AS value FROM flow JOIN steps USING (time) WHERE time_idx BETWEEN 5 AND 12),
frames AS (SELECT vpu, id, CAST(f.range AS INTEGER) AS time_idx FROM nexus, range(5, 13) f),
m AS (SELECT vpu, id, time_idx, coalesce(value, 0.0) AS value FROM frames LEFT JOIN vals USING (id, time_idx)),
b AS (SELECT time_idx, min(value) AS lo, max(value) AS hi FROM m GROUP BY 1)
SELECT vpu, id, time_idx, round(value, 6) AS value,
       round(CASE WHEN hi > lo THEN pow((value - lo) / (hi - lo), 0.4) END, 9) AS norm FROM m JOIN b USING (time_idx)""")
def step_map(spark, sf):
    fl = views.flow(spark, sf)
    steps = evaluate.position_index(fl, "time", "time_idx")
    flow = fl.select(S.nex_id("feature_id").alias("id"), "time", "flow")
    t = maps.step_table(flow, steps, views.nexus(spark, sf), 5, 12)
    t = maps.power_norm(t, "value", by=["time_idx"])
    return t.select("vpu", "id", "time_idx", F.round("value", 6).alias("value"), r9("norm", "norm"))


# ---------------------------------------------------------------- comparisons, profile, sampling, previews

@register("compare_sources", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + """,
cov AS (SELECT r.*, count(*) OVER (PARTITION BY basin_id, divide_id) AS n FROM rect_cov r),
j AS (SELECT c.basin_id, c.divide_id, r.time, c.coverage, c.n, r.qty, r.disc FROM cov c JOIN raster r USING (iy, ix)),
catch AS (SELECT basin_id, divide_id, time,
         CASE WHEN count(qty) = max(n) THEN sum(qty * coverage) / sum(coverage) END AS qty,
         CASE WHEN count(disc) = max(n) THEN sum(disc * coverage) / sum(coverage) END AS disc FROM j GROUP BY 1, 2, 3),
basin AS (SELECT basin_id, time, avg(qty) AS qty, avg(disc) AS disc FROM catch GROUP BY 1, 2),
lumped AS (SELECT time, avg(qty) AS qty, avg(disc) AS disc FROM raster GROUP BY 1),
u AS (SELECT 'catchment' AS source, divide_id AS id, time, qty, disc FROM catch
      UNION ALL SELECT 'basin', basin_id, time, qty, disc FROM basin
      UNION ALL SELECT 'lumped', 'all', time, qty, disc FROM lumped)
SELECT source, id, time, variable, round(value, 9) AS value
FROM u UNPIVOT INCLUDE NULLS (value FOR variable IN (qty, disc))
WHERE time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-01'""")
def compare_sources(spark, sf):
    r = views.raster(spark, sf)
    c = forcing.catchment_mean(r, rect_coverage(spark, sf), views.RASTER_VARS)
    b = forcing.basin_mean(c, views.RASTER_VARS)
    lumped = r.groupBy("time").agg(*[F.avg(v).alias(v) for v in views.RASTER_VARS]).withColumn("id", F.lit("all"))
    u = compare.label_union({"catchment": c.withColumnRenamed("divide_id", "id").drop("basin_id"),
                             "basin": b.withColumnRenamed("basin_id", "id"), "lumped": lumped},
                            ["id", "time"], views.RASTER_VARS)
    u = compare.in_range(u, "time", "1996-01-01", "1997-12-01")
    return u.select("source", "id", "time", "variable", r9("value", "value"))


@register("obs_in_sim_span", sql=V.with_(V.SERIES) + """,
sim AS (SELECT min(datetime) AS t0, max(datetime) AS t1 FROM series WHERE id = 'purchase')
SELECT datetime, round(value, 9) AS obs FROM series, sim WHERE id = 'click' AND datetime BETWEEN t0 AND t1""")
def obs_in_sim_span(spark, sf):
    obs, mem = obs_members(spark, sf)
    sim = mem.filter(F.col("id") == "purchase")
    return compare.in_span(obs, sim, "datetime").select("datetime", r9("obs", "obs"))


@register("profile", sql=V.with_(V.RASTER) + """,
c AS (SELECT count(*) AS n, count(time) AS time, count(iy) AS iy, count(ix) AS ix, count(y) AS y, count(x) AS x,
             count(qty) AS qty, count(disc) AS disc FROM raster)
SELECT col AS "column", dtype, CAST(n AS BIGINT) AS n_rows, CAST(nn AS BIGINT) AS n_non_null FROM (
  SELECT 'time' AS col, 'timestamp_ntz' AS dtype, n, time AS nn FROM c UNION ALL
  SELECT 'iy', 'bigint', n, iy FROM c UNION ALL SELECT 'ix', 'bigint', n, ix FROM c UNION ALL
  SELECT 'y', 'double', n, y FROM c UNION ALL SELECT 'x', 'double', n, x FROM c UNION ALL
  SELECT 'qty', 'double', n, qty FROM c UNION ALL SELECT 'disc', 'double', n, disc FROM c)""")
def profile(spark, sf):
    return compare.profile(views.raster(spark, sf))


@register("sample_basins", sql=V.with_(V.BASINS) + """,
d AS (SELECT basin_id, row_number() OVER (ORDER BY basin_id) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT basin_id FROM basins)),
g AS (SELECT i AS draw, CAST('0x' || substr(md5('42:' || CAST(i AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM range(15) t(i))
SELECT draw, basin_id FROM g JOIN d ON d.pos = g.h % d.n""")
def sample_basins(spark, sf):
    return compare.sample_ids(views.basins(spark, sf), "basin_id", n=15, seed=42)


@register("head_tail", sql=V.with_(V.SERIES) + """,
o AS (SELECT datetime, value FROM series WHERE id = 'click')
SELECT * FROM (SELECT 'head' AS part, datetime, round(value, 9) AS obs FROM o ORDER BY datetime LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'tail' AS part, datetime, round(value, 9) AS obs FROM o ORDER BY datetime DESC LIMIT 5)""")
def head_tail(spark, sf):
    obs, _ = obs_members(spark, sf)
    h, t = compare.head_tail(obs, "datetime", 5)
    return (h.withColumn("part", F.lit("head")).unionByName(t.withColumn("part", F.lit("tail")))
             .select("part", "datetime", r9("obs", "obs")))
