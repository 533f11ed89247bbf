"""Queries: forecast assembly and resume."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assemble, ledger
from . import sql_views as V
from . import views
from .registry import r9, register

H = 1  # forecast horizon of the alignment queries


@register("forecast_align", sql=V.with_(V.RUNS) + f"""
SELECT init_hour, step, variable, round(value, 9) AS value, seq, init_hour + to_hours({H + 1}) AS time,
       CAST(init_hour + to_hours({H + 1}) AS DATE) AS day
FROM runs WHERE step = {H}""")
def forecast_align(spark, sf):
    a = assemble.align_forecast(views.runs(spark, sf), H)
    return a.select("init_hour", "step", "variable", r9("value", "value"), "seq", "time", "day")


@register("dedupe_last", sql=V.with_(V.RUNS) + """
SELECT variable, init_hour, step, round(arg_max(value, seq), 9) AS value, max(seq) AS seq FROM runs GROUP BY 1, 2, 3""")
def dedupe_last(spark, sf):
    d = assemble.dedupe_last(views.runs(spark, sf), ["variable", "init_hour", "step"], "seq")
    return d.select("variable", "init_hour", "step", r9("value", "value"), "seq")


@register("duplicates", sql=V.with_(V.RUNS) + """
SELECT variable, init_hour, step, CAST(count(*) AS BIGINT) AS n FROM runs GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def duplicates(spark, sf):
    return assemble.duplicates(views.runs(spark, sf), ["variable", "init_hour", "step"])


def _anl_fcst(spark, sf):
    """Analysis = step 0 valid at init, forecast = step 1 valid at init + 2 h; keep-last per (variable, time)."""
    r = views.runs(spark, sf)
    a = assemble.align_analysis(r).select("variable", "time", "value", "seq")
    f = assemble.align_forecast(r, 1).select("variable", "time", "value", "seq")
    a = assemble.dedupe_last(a, ["variable", "time"]).drop("seq")
    f = assemble.dedupe_last(f, ["variable", "time"]).drop("seq")
    return a, f


_AF = """,
a AS (SELECT variable, init_hour AS time, arg_max(value, seq) AS value FROM runs WHERE step = 0 GROUP BY 1, 2),
f AS (SELECT variable, init_hour + to_hours(2) AS time, arg_max(value, seq) AS value FROM runs WHERE step = 1 GROUP BY 1, 2)
"""


@register("merge_outer", sql=V.with_(V.RUNS) + _AF + """
SELECT coalesce(a.variable, f.variable) AS variable, coalesce(a.time, f.time) AS time, round(coalesce(a.value, f.value), 9) AS value
FROM a FULL OUTER JOIN f ON a.variable = f.variable AND a.time = f.time""")
def merge_outer(spark, sf):
    a, f = _anl_fcst(spark, sf)
    m = assemble.merge_fields(a, f, ["variable", "time"], on_conflict="first")
    return m.select("variable", "time", r9("value", "value"))


@register("merge_conflicts", sql=V.with_(V.RUNS) + _AF + """
SELECT variable, time, round(a.value, 9) AS left_value, round(f.value, 9) AS right_value
FROM a JOIN f USING (variable, time) WHERE a.value <> f.value""")
def merge_conflicts(spark, sf):
    a, f = _anl_fcst(spark, sf)
    c = assemble.merge_conflicts(a, f, ["variable", "time"], ["value"])
    return c.select("variable", "time", r9("left_value", "left_value"), r9("right_value", "right_value"))


@register("valid_time_semi", sql=V.with_(V.RUNS) + """,
cat AS (SELECT DISTINCT variable, init_hour + to_hours(1) AS time FROM runs WHERE step = 0)
SELECT variable, init_hour + to_hours(2) AS time, round(value, 9) AS value, seq FROM runs r
WHERE step = 1 AND EXISTS (SELECT 1 FROM cat c WHERE c.variable = r.variable AND c.time = r.init_hour + to_hours(2))""")
def valid_time_semi(spark, sf):
    r = views.runs(spark, sf)
    cat = assemble.align_forecast(r, 0).select("variable", "time")
    data = assemble.align_forecast(r, 1).select("variable", "time", "value", "seq")
    return assemble.keep_promised(data, cat, ["variable", "time"]).select("variable", "time", r9("value", "value"), "seq")


@register("completeness", sql=V.with_(V.RUNS) + """,
cat AS (SELECT DISTINCT variable, init_hour + to_hours(1) AS time, CAST(init_hour + to_hours(1) AS DATE) AS day FROM runs WHERE step = 0),
have AS (SELECT DISTINCT variable, init_hour + to_hours(2) AS time FROM runs WHERE step = 1)
SELECT day, variable, CAST(count(*) AS BIGINT) AS n_promised, CAST(count(h.time) AS BIGINT) AS n_matched,
       CAST(count(*) - count(h.time) AS BIGINT) AS shortfall
FROM cat LEFT JOIN have h USING (variable, time) GROUP BY 1, 2""")
def completeness(spark, sf):
    r = views.runs(spark, sf)
    cat = assemble.align_forecast(r, 0).select("variable", "time", "day")
    data = assemble.align_forecast(r, 1).select("variable", "time")
    return assemble.completeness(cat, data, ["variable", "time"], ["day", "variable"])


REQUIRED = ["click", "view"]


@register("required_vars", sql=V.with_(V.RUNS) + """,
ok AS (SELECT init_hour FROM (SELECT DISTINCT init_hour, variable FROM runs WHERE variable IN ('click', 'view'))
       GROUP BY 1 HAVING count(*) = 2)
SELECT init_hour, variable, round(value, 9) AS value, seq FROM runs WHERE init_hour IN (SELECT init_hour FROM ok)""")
def required_vars(spark, sf):
    kept, _ = assemble.required_vars(views.runs(spark, sf), REQUIRED)
    return kept.select("init_hour", "variable", r9("value", "value"), "seq")


@register("required_vars_skipped", sql=V.with_(V.RUNS) + """,
ok AS (SELECT init_hour FROM (SELECT DISTINCT init_hour, variable FROM runs WHERE variable IN ('click', 'view'))
       GROUP BY 1 HAVING count(*) = 2)
SELECT DISTINCT init_hour FROM runs WHERE init_hour NOT IN (SELECT init_hour FROM ok)""")
def required_vars_skipped(spark, sf):
    _, skipped = assemble.required_vars(views.runs(spark, sf), REQUIRED)
    return skipped


@register("ledger_anti", sql=V.with_(V.BASINS, V.LEDGER) + """
SELECT basin_id FROM basins b WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.basin_id = b.basin_id AND l.status = 'finished')""")
def ledger_anti(spark, sf):
    return ledger.pending(views.basins(spark, sf), views.ledger(spark, sf), skip="finished")


@register("ledger_anti_any", sql=V.with_(V.BASINS, V.LEDGER) + """
SELECT basin_id FROM basins b WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.basin_id = b.basin_id)""")
def ledger_anti_any(spark, sf):
    return ledger.pending(views.basins(spark, sf), views.ledger(spark, sf), skip="any")


@register("drop_rename_flip", sql=V.with_(V.RASTER) + """
SELECT time, CAST(9 - iy AS BIGINT) AS iy_north_up, ix, qty AS APCP_surface FROM raster""")
def drop_rename_flip(spark, sf):
    r = views.raster(spark, sf)
    r = assemble.drop_vars(r, ["disc", "y", "x", "forecast_period", "height"])  # P9: absent names ignored
    r = r.withColumnRenamed("qty", "APCP_surface")  # P11-style standardisation
    return r.select("time", (F.lit(views.GRID.ny - 1) - F.col("iy")).cast("bigint").alias("iy_north_up"), "ix", "APCP_surface")


FCST_VARS = ["purchase"]  # in forecast files (step 1); every other variable of the view is in analysis files (step 0)
ANL_VARS = sorted({views.OBSERVED, *views.MEMBERS} - set(FCST_VARS))


_FORECAST_SQL = V.with_(V.RUN_CELLS, V.BOXES, V.GRID10, V.RECT_COV) + """,
a AS (SELECT variable, init_hour AS time, iy, ix, arg_max(value, seq) AS value
      FROM run_cells WHERE step = 0 AND variable <> 'purchase' GROUP BY 1, 2, 3, 4),
f AS (SELECT variable, init_hour + to_hours(2) AS time, iy, ix, arg_max(value, seq) AS value
      FROM run_cells WHERE step = 1 AND variable = 'purchase' GROUP BY 1, 2, 3, 4),
aw AS (SELECT time, iy, ix, max(CASE WHEN variable = 'click' THEN value END) AS click,
              max(CASE WHEN variable = 'error' THEN value END) AS error, max(CASE WHEN variable = 'signup' THEN value END) AS signup,
              max(CASE WHEN variable = 'view' THEN value END) AS view
       FROM a GROUP BY 1, 2, 3),
fw AS (SELECT time, iy, ix, max(value) AS purchase FROM f GROUP BY 1, 2, 3),
raster AS (SELECT coalesce(aw.time, fw.time) AS time, coalesce(aw.iy, fw.iy) AS iy, coalesce(aw.ix, fw.ix) AS ix,
                  click, error, signup, view, purchase
           FROM aw FULL OUTER JOIN fw ON aw.time = fw.time AND aw.iy = fw.iy AND aw.ix = fw.ix),
cov AS (SELECT r.*, count(*) OVER (PARTITION BY basin_id, divide_id) AS n FROM rect_cov r),
j AS (SELECT c.basin_id, c.divide_id, r.time, c.coverage, c.n, r.click, r.error, r.signup, r.view, r.purchase
      FROM cov c JOIN raster r USING (iy, ix)),
catch AS (SELECT basin_id, divide_id, time,
         CASE WHEN count(click) = max(n) THEN sum(click * coverage) / sum(coverage) END AS click,
         CASE WHEN count(error) = max(n) THEN sum(error * coverage) / sum(coverage) END AS error,
         CASE WHEN count(signup) = max(n) THEN sum(signup * coverage) / sum(coverage) END AS signup,
         CASE WHEN count(view) = max(n) THEN sum(view * coverage) / sum(coverage) END AS view,
         CASE WHEN count(purchase) = max(n) THEN sum(purchase * coverage) / sum(coverage) END AS purchase
  FROM j GROUP BY 1, 2, 3)
SELECT basin_id, time, round(avg(click), 9) AS click, round(avg(error), 9) AS error, round(avg(signup), 9) AS signup,
       round(avg(view), 9) AS view,
       round(avg(purchase), 9) AS purchase
FROM catch GROUP BY 1, 2"""


@register("forecast_forcing", sql=_FORECAST_SQL)
def forecast_forcing(spark, sf):
    """The forecast-archive job as one plan: align (J13) -> keep-last (W1) -> wide (P16) ->
    merge analysis with forecast (J9) -> catchment mean (J1/A1) -> basin mean (A2)."""
    from ..operators import forcing
    from .q_forcing import rect_coverage
    r = views.run_cells(spark, sf)
    keys = ["variable", "time", "iy", "ix"]
    a = assemble.align_analysis(r.filter(F.col("variable").isin(ANL_VARS))).select(*keys, "value", "seq")
    f = assemble.align_forecast(r.filter(F.col("variable").isin(FCST_VARS)), 1).select(*keys, "value", "seq")
    a = assemble.dedupe_last(a, keys).drop("seq")
    f = assemble.dedupe_last(f, keys).drop("seq")
    aw = forcing.to_wide(a, ["time", "iy", "ix"], ANL_VARS)
    fw = forcing.to_wide(f, ["time", "iy", "ix"], FCST_VARS)
    raster = assemble.merge_fields(aw, fw, ["time", "iy", "ix"], on_conflict="error")
    variables = ANL_VARS + FCST_VARS
    c = forcing.catchment_mean(raster, rect_coverage(spark, sf), variables)
    b = forcing.basin_mean(c, variables)
    return b.select("basin_id", "time", *[r9(v, v) for v in variables])


def _init_of(store: str) -> str:
    return f"{store[:4]}-{store[4:6]}-{store[6:8]} {store[9:11]}:00:00"


def write_run_archive(spark, sf, root, init_of=_init_of):
    """RUNS on the grid as an archive: one store per run and kind (hours without a run have none)."""
    from ..sources import chunks
    r = views.run_cells(spark, sf)
    kind = F.when(F.col("variable").isin(FCST_VARS), "fcst").otherwise("anl")
    r = assemble.dedupe_last(r, ["variable", "init_hour", "step", "iy", "ix"]).where((kind == "fcst") | (F.col("step") == 0))
    name = F.concat(F.date_format("init_hour", "yyyyMMdd_HH"), F.lit("z_"), kind, F.lit(".zarr"))
    rows = r.select(name.alias("store"), "variable", F.col("step").cast("bigint").alias("t"), "iy", "ix", "value")
    chunks.write_archive(rows, root, (views.GRID.ny, views.GRID.nx), {"anl": [0], "fcst": [1, 2, 3]}, init_of, {"id": "zstd", "level": 1})


@register("forecast_job_files", sql=_FORECAST_SQL)
def forecast_job_files(spark, sf):
    """The forecast job from files: one store per run and kind, written from the tables (hours without a run have none)."""
    from .. import jobs
    from ..session import scratch_path
    root = scratch_path(spark, "archive")
    write_run_archive(spark, sf, f"{root}/runs")
    out = jobs.forecast_job(spark, f"{root}/runs", ANL_VARS, FCST_VARS, 1, views.divides(spark, sf), views.GRID, f"{root}/out", cells="touch", fill=False)
    return out.select("basin_id", "time", *[r9(v, v) for v in ANL_VARS + FCST_VARS])


# Whole days of January 2024; of the analysis runs, those of hour 5 are shifted by a day inside, those of hour 7 have a
# broken 'click' array, those of hour 9 aren't there.
_STATUS_SQL = V.with_(V.RUN_CELLS) + """,
hours AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS time),
promised AS (SELECT strftime(time, '%Y%m%d_%H') || 'z_anl.zarr' AS store, variable, time FROM hours, (VALUES ('click'), ('error'), ('signup'), ('view')) v(variable)
             UNION ALL SELECT strftime(time - INTERVAL 2 HOUR, '%Y%m%d_%H') || 'z_fcst.zarr', 'purchase', time FROM hours),
anl AS (SELECT DISTINCT init_hour, variable FROM run_cells r JOIN (SELECT DISTINCT iy, ix FROM rect_cov) c USING (iy, ix)
        WHERE step = 0 AND variable <> 'purchase' AND hour(init_hour) <> 9),
seen AS (SELECT strftime(init_hour, '%Y%m%d_%H') || 'z_anl.zarr' AS store, variable,
                CASE WHEN hour(init_hour) = 5 THEN init_hour + INTERVAL 24 HOUR ELSE init_hour END AS time FROM anl WHERE NOT (hour(init_hour) = 7 AND variable = 'click')
         UNION SELECT strftime(init_hour, '%Y%m%d_%H') || 'z_fcst.zarr', variable, init_hour + INTERVAL 2 HOUR
         FROM run_cells JOIN (SELECT DISTINCT iy, ix FROM rect_cov) c USING (iy, ix) WHERE step = 1 AND variable = 'purchase'),
bad AS (SELECT DISTINCT strftime(init_hour, '%Y%m%d_%H') || 'z_anl.zarr' AS store, variable FROM run_cells WHERE step = 0 AND variable = 'click' AND hour(init_hour) = 7),
status AS (SELECT coalesce(p.store, s.store) AS store, coalesce(p.variable, s.variable) AS variable, coalesce(p.time, s.time) AS time,
                  CASE WHEN p.store IS NULL THEN 'extra' WHEN s.store IS NOT NULL THEN 'present' WHEN b.store IS NOT NULL THEN 'unreadable' ELSE 'missing' END AS status
           FROM promised p FULL JOIN seen s ON p.store = s.store AND p.variable = s.variable AND p.time = s.time
           LEFT JOIN bad b ON b.store = p.store AND b.variable = p.variable)
""".replace("hours AS (", V.BOXES + ",\n" + V.GRID10 + ",\n" + V.RECT_COV + ",\nhours AS (", 1)


def broken_archive(spark, sf, root):
    """The archive with planted faults: shifted runs (hour 5), broken arrays (hour 7), no analysis runs (hour 9)."""
    import glob
    import json
    import os
    write_run_archive(spark, sf, f"{root}/all")
    for store in glob.glob(f"{root}/all/*.zarr"):  # a fixture of small files
        name = os.path.basename(store)
        hour, anl = name[9:11], "_anl." in name
        if anl and hour == "09":
            continue
        os.makedirs(f"{root}/runs", exist_ok=True)
        os.symlink(store, f"{root}/runs/{name}")
        if anl and hour == "05":
            with open(f"{store}/time/.zattrs", "w") as fh:
                json.dump({"units": f"hours since {_init_of(name)}"}, fh)
            with open(f"{store}/time/0", "wb") as fh:
                fh.write((24).to_bytes(8, "little"))
        if anl and hour == "07" and os.path.exists(f"{store}/click"):
            with open(f"{store}/click/0.0.0", "wb") as fh:
                fh.write(b"torn")
    import datetime
    return datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 30, 23)


@register("forecast_job_status", sql=_STATUS_SQL + "SELECT store, variable, time, status FROM status")
def forecast_job_status(spark, sf):
    """A17 + J10: one status for each promised hour, from runs that are missing, unreadable or hold another hour."""
    from .. import jobs
    from ..session import scratch_path
    root = scratch_path(spark, "archive")
    span = broken_archive(spark, sf, root)
    jobs.forecast_job(spark, f"{root}/runs", ANL_VARS, FCST_VARS, 1, views.divides(spark, sf), views.GRID, f"{root}/out", cells="touch", fill=False, span=span)
    return spark.read.parquet(f"{root}/out/status")


@register("forecast_job_required", sql=_STATUS_SQL + """,
there AS (SELECT DISTINCT variable, time FROM status WHERE status = 'present'),
whole AS (SELECT time FROM there WHERE variable IN ('click', 'view') GROUP BY time HAVING count(*) = 2)
SELECT CAST(time AS DATE) AS day, variable, count(*) AS n_promised, count_if(status = 'present') AS n_matched,
       count_if(status <> 'present') AS shortfall, count_if(status = 'present' AND time NOT IN (SELECT time FROM whole)) AS n_left_out
FROM status WHERE status <> 'extra' GROUP BY 1, 2""")
def forecast_job_required(spark, sf):
    """P13 + A17 in the job: hours without click and view are left out as a whole; the shortfall by day and variable."""
    from .. import jobs
    from ..session import scratch_path
    root = scratch_path(spark, "archive")
    span = broken_archive(spark, sf, root)
    jobs.forecast_job(spark, f"{root}/runs", ANL_VARS, FCST_VARS, 1, views.divides(spark, sf), views.GRID, f"{root}/out", cells="touch", fill=False,
                      span=span, required=["click", "view"])
    skipped = spark.read.parquet(f"{root}/out/skipped")
    status = spark.read.parquet(f"{root}/out/status").where("status = 'present'").join(skipped, "time", "left_semi")
    left = status.groupBy(F.to_date("time").alias("day"), "variable").agg(F.count("*").alias("n_left_out"))
    return (spark.read.parquet(f"{root}/out/completeness").join(left, ["day", "variable"], "left")
            .select("day", "variable", "n_promised", "n_matched", "shortfall", F.coalesce("n_left_out", F.lit(0)).cast("long").alias("n_left_out")))


_MANY_SQL = V.with_(V.RUNS) + """,
base AS (SELECT variable, init_hour AS time, arg_max(value, seq) AS value FROM runs GROUP BY 1, 2),
inputs AS (SELECT 0 AS input, * FROM base WHERE hour(time) % 3 = 0
  UNION ALL SELECT 1, * FROM base WHERE hour(time) % 3 <= 1
  UNION ALL SELECT 2, * FROM base WHERE hour(time) % 3 = 2 OR variable = 'view'
  UNION ALL SELECT 3, variable, time, CASE WHEN variable = 'click' AND hour(time) = 13 THEN value + 1 ELSE value END FROM base WHERE variable IN ('click', 'error')),
firsts AS (SELECT *, arg_min(value, input) OVER (PARTITION BY variable, time) AS f FROM inputs),
aside AS (SELECT DISTINCT input, variable FROM firsts WHERE value <> f)
"""


def four_inputs(spark, sf):
    """Four overlapping inputs of one table; the last one contradicts the others in one variable, at hour 13 alone."""
    base = assemble.dedupe_last(views.runs(spark, sf).select("variable", F.col("init_hour").alias("time"), "value", "seq"), ["variable", "time"]).drop("seq")
    h = F.hour("time")
    planted = F.when((F.col("variable") == "click") & (h == 13), F.col("value") + 1).otherwise(F.col("value"))
    return [base.where(h % 3 == 0), base.where(h % 3 <= 1), base.where((h % 3 == 2) | (F.col("variable") == "view")),
            base.where(F.col("variable").isin("click", "error")).withColumn("value", planted)]


@register("merge_many", sql=_MANY_SQL + """
SELECT variable, time, round(arg_min(value, input), 9) AS value FROM inputs
WHERE NOT EXISTS (SELECT 1 FROM aside a WHERE a.input = inputs.input AND a.variable = inputs.variable) GROUP BY variable, time""")
def merge_many(spark, sf):
    """J9 over four inputs: the variable that contradicts is set aside as a whole, everything else is merged."""
    merged, _, _ = assemble.merge_many(four_inputs(spark, sf), ["time"])
    return merged.select("variable", "time", r9("value", "value"))


@register("merge_many_salvage", sql=_MANY_SQL + """
SELECT i.input, i.variable, time, round(value, 9) AS value FROM inputs i JOIN aside a ON a.input = i.input AND a.variable = i.variable""")
def merge_many_salvage(spark, sf):
    """What was set aside."""
    _, salvage, _ = assemble.merge_many(four_inputs(spark, sf), ["time"])
    return salvage.select("input", "variable", "time", r9("value", "value"))
