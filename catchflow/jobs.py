"""File-to-file jobs composed from the operators (the reference's main scripts, one plan each).

``forcing_job``: yearly raster stores + polygon containers -> per-catchment and per-basin series,
resumable through the ledger (SURVEY 3.1). All basins run in one plan; no per-basin loop.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import publish, sinks
from .functions import projections
from .operators import coverage as cov
from .operators import forcing, ledger
from .operators.post import cached_coverage
from .schemas import Grid
from .session import written
from .sources import chunks, containers


def forcing_job(spark: SparkSession, raster_template: str, years: tuple[int, int], variables: list[str],
                divides_paths: str | list[str], grid: Grid, out: str, ledger_path: str, cells: str = "centre",
                id_col: str = "divide_id", skip: str = "finished", dense: bool = True, fill: bool = True, source_crs: str | None = None,
                cache: str | None = None, on_step: Callable[[str], None] | None = None) -> DataFrame:
    """S1 + S3 + J11 + J2 + J3 + A1 + A2 + K1/K2/K3 + K9. Returns the basin table as it stands after the run.

    Polygons in another coordinate system move to the grid's first (G3/G4): the containers say theirs, ``source_crs``
    overrides that. Containers that can't be read, and features without a shape, are written to ``out/errors``. A
    catchment without cells takes those of its nearest covered one, unless ``fill`` is off.

    The outputs ``catchment``, ``basin`` and ``dense`` are staged and published as one (:mod:`catchflow.publish`; read
    them with :func:`forcing_output`), so a run that is killed leaves all of them as they were. A resumed run
    replaces the basins it works on and leaves finished ones alone. ``cache`` names a folder that keeps coverages (K4).
    ``on_step`` is told each output's name once it is staged, and ``published``; an error it raises ends the run there.
    """
    step = on_step or (lambda name: None)
    raw = written(containers.scan_divides(spark, divides_paths, id_col=id_col, tolerant=True, with_errors=True), "divides")  # decoded once
    divides = raw.where("error IS NULL").select("basin_id", F.col("feature_id").alias("divide_id"), "rings", "crs", "wkt")  # P11: id -> divide_id
    shapeless = cov.without_geometry(divides).select(F.lit(None).cast("string").alias("path"), "basin_id", "divide_id", F.lit("no geometry").alias("error"))
    (raw.where("error IS NOT NULL").select("path", "basin_id", F.lit(None).cast("string").alias("divide_id"), "error").union(shapeless)
     .write.mode("overwrite").parquet(f"{out}/errors"))
    divides = projections.to_system(divides, grid.crs, wkt_col="wkt", override=source_crs).drop("crs", "wkt")
    _finish_published(spark, out, ledger_path)
    todo = written(ledger.pending(divides.select("basin_id").distinct(), ledger.read_ledger(spark, ledger_path), skip), "todo")
    if not todo.limit(1).count():  # nothing pending: what is finished stays as it is
        return forcing_output(spark, out, "basin", variables)
    divides = divides.join(todo, "basin_id", "left_semi")
    run = publish.begin(spark, out)
    ledger.record(todo, ledger_path, "processing")
    c = cached_coverage(spark, cache, "forcing", divides, grid, cells) if cache else cov.coverage(divides, grid, cells=cells)
    c = forcing.prepare_coverage(cov.fill_nearest(c, divides) if fill else c)
    long = chunks.scan_raster(spark, raster_template, years, variables, drop_fill=True)
    catch = written(forcing.catchment_mean_long(long, c, variables), "catchment")  # one raster scan; the rest derives from it
    sinks.write_catchment_series(catch, publish.staged(out, run, "catchment"))  # K2
    step("catchment")
    basin = forcing.basin_mean(catch, variables)
    sinks.write_basin_series(basin, publish.staged(out, run, "basin"))          # K3
    step("basin")
    if dense:
        from .operators.pack import to_dense
        sinks.write_dense(to_dense(catch, variables), publish.staged(out, run, "dense"))  # K1
        step("dense")
    publish.commit(todo, out, run)
    step("published")
    ledger.record(todo, ledger_path, "finished")                                # K9, after the writes
    return forcing_output(spark, out, "basin", variables)


def _finish_published(spark: SparkSession, out: str, ledger_path: str) -> None:
    """The ledger lines of a run that was killed after it published: basins published since they were begun are finished."""
    begun = (ledger.read_ledger(spark, ledger_path).groupBy("basin_id")
             .agg(F.max(F.when(F.col("status") == "processing", F.col("ts"))).alias("begun"), F.bool_or(F.col("status") == "finished").alias("done")))
    late = publish.manifest(spark, out).join(begun.where("begun IS NOT NULL AND NOT done"), "basin_id").where("ts >= begun").select("basin_id")
    late = written(late, "late")
    if late.limit(1).count():
        ledger.record(late, ledger_path, "finished")


def forcing_output(spark: SparkSession, out: str, output: str, variables: list[str]) -> DataFrame:
    """``catchment`` (K2) or ``basin`` (K3) of :func:`forcing_job` as last published, times as text as in the files."""
    values = "".join(f", `{v}` double" for v in variables)
    ids = {"catchment": "basin_id string, divide_id string", "basin": "basin_id string"}
    if output not in ids:
        raise ValueError(f"output must be one of {sorted(ids)}, not {output!r}")
    return publish.published(spark, out, output, f"time string{values}, {ids[output]}")


def _promised_span(stores: list[str], horizon: int) -> tuple[dt.datetime, dt.datetime] | None:
    """Whole days from the first to the last valid hour that the archive's run names stand for."""
    times = []
    for s in stores:
        m = re.search(r"(\d{8}_\d{2})z_(anl|fcst)\.", s)
        if m:
            times.append(dt.datetime.strptime(m[1], "%Y%m%d_%H") + dt.timedelta(hours=horizon + 1 if m[2] == "fcst" else 0))
    return (min(times).replace(hour=0), max(times).replace(hour=23)) if times else None


def forecast_job(spark: SparkSession, root: str, analysis: list[str], forecast: list[str], horizon: int,
                 divides: DataFrame, grid: Grid, out: str, cells: str = "centre", fill: bool = True,
                 span: tuple[dt.datetime, dt.datetime] | None = None, required: list[str] = (), on_conflict: str = "salvage") -> DataFrame:
    """S2 + J13 + W1 + J10 + A17 + P13 + J9 + J1/A1 + A2 + K3: an archive of run stores -> daily basin files, in one plan.

    Stores are named ``<yyyymmdd>_<HH>z_anl.zarr`` (valid at their init hour) and ``.._fcst.zarr`` (a step's valid
    time is ``init + h + 1``; ``horizon`` picks the step). ``span`` is the first and last valid hour that the archive
    promises; by default the whole days that its run names reach. Only chunks that the catchments cover are opened.

    * Hours that no run promises are left out, and ``out/status`` has one status for each promised hour of each variable
      (present, missing, unreadable) and for each extra one; ``out/completeness`` counts them by day and variable;
      ``out/errors`` says what couldn't be read.
    * Hours that lack one of ``required`` are left out as a whole and listed in ``out/skipped``.
    * Analysis and forecast are merged; a variable of one that contradicts the other is set aside in ``out/salvage``
      (``on_conflict`` as in :func:`merge_many <catchflow.operators.assemble.merge_many>`), ``out/conflicts`` counts.
    * ``divides`` with a ``crs`` column (and ``wkt``) move to the grid's coordinate system first.
    """
    from .functions.scalars import time_from_name
    from .operators import assemble
    if not 0 <= horizon <= 23:
        raise ValueError(f"forecast horizon must be 0..23, not {horizon}")
    variables = list(dict.fromkeys([*analysis, *forecast]))
    if "crs" in divides.columns:
        wkt = "wkt" if "wkt" in divides.columns else None
        divides = projections.to_system(divides, grid.crs, wkt_col=wkt).drop("crs", "wkt")
    c = cov.coverage(divides, grid, cells=cells)
    c = forcing.prepare_coverage(cov.fill_nearest(c, divides) if fill else c)
    raw = written(chunks.scan_archive(spark, root, variables, box=forcing.covered_box(c) or (0, -1, 0, -1)), "archive")  # decoded once
    raw = raw.withColumn("name", F.regexp_extract("store", r"([^/]+)$", 1))
    raw.where("error IS NOT NULL").select("store", "variable", "path", "error").write.mode("overwrite").parquet(f"{out}/errors")
    is_fcst = F.col("name").contains("_fcst.")
    mine = F.when(is_fcst, F.col("variable").isin(list(forecast))).otherwise(F.col("variable").isin(list(analysis)))
    runs = raw.where(F.col("error").isNull() & mine).withColumn("init_hour", time_from_name(F.col("name"))).withColumn("is_fcst", is_fcst)
    valid = F.when(F.col("is_fcst"), F.timestamp_add("HOUR", F.lit(horizon + 1), F.col("init_hour"))).otherwise(F.col("init_hour"))
    # a forecast run's other steps are nobody's extra hours; an analysis run has its own hour and no other
    runs = runs.withColumn("valid", valid).where(~F.col("is_fcst") | (F.col("time") == F.col("valid")))

    span = span or _promised_span(chunks.list_stores(root), horizon)
    promised = (assemble.promised_hours(spark, *span, analysis, forecast, horizon) if span
                else spark.createDataFrame([], "store string, variable string, time timestamp_ntz"))
    seen = runs.select(F.col("name").alias("store"), "variable", "time").distinct()
    failed = raw.where(F.col("error").isNotNull() & mine).select(F.col("name").alias("store"), "variable")
    status = written(assemble.hour_status(promised, seen, failed), "status")
    status.write.mode("overwrite").parquet(f"{out}/status")
    day = F.to_date("time").alias("day")
    assemble.completeness(status.where("status <> 'extra'").select("variable", "time", day), status.where("status = 'present'").select("variable", "time"),
                          ["variable", "time"], ["day", "variable"]).write.mode("overwrite").parquet(f"{out}/completeness")
    there = status.where("status = 'present'").select("variable", "time")
    if required:
        whole, _ = assemble.required_vars(there, list(required), key="time")
        there.select("time").distinct().join(whole.select("time").distinct(), "time", "left_anti").write.mode("overwrite").parquet(f"{out}/skipped")
        there = whole

    keys = ["time", "iy", "ix"]
    good = assemble.keep_promised(runs.where(F.col("time") == F.col("valid")), there, ["variable", "time"])  # J10
    both = [assemble.dedupe_last(good.where(F.col("is_fcst") == kind).select("variable", *keys, "value", F.col("init_hour").alias("seq")), ["variable", *keys]).drop("seq")
            for kind in (False, True)]
    long, salvage, report = assemble.merge_many(both, keys, on_conflict)  # J9
    salvage.write.mode("overwrite").parquet(f"{out}/salvage")
    report.write.mode("overwrite").parquet(f"{out}/conflicts")
    catch = written(forcing.catchment_mean_long(long, c, variables), "catchment")
    sinks.write_daily_series(forcing.basin_mean(catch, variables), f"{out}/daily")
    from .sources.series import scan_daily_basin_files
    return scan_daily_basin_files(spark, f"{out}/daily", "time string, " + ", ".join(f"`{v}` double" for v in variables))


def post_process_job(spark: SparkSession, series_root: str, schema: str, out: str, spec: dict[str, int] | None = None,
                     id_pattern: str = r"divide_id=([^/]+)", time_col: str = "time") -> DataFrame:
    """M1 + P10 + D1 + K5/K6/K7: every series file in one read, each listed variable rounded to its
    decimals (absent ones skipped), then split by id and water year into gzip CSV. Returns what was written."""
    from .functions.scalars import ANALYSIS_DECIMALS, round_columns
    from .sources.series import scan_series
    raw = scan_series(spark, series_root, schema, time_col, with_path=True)
    values = [f.name for f in spark.createDataFrame([], schema).schema.fields if f.name != time_col]
    df = raw.select(F.regexp_extract("source_path", id_pattern, 1).alias("series_id"), time_col, *values)
    df = round_columns(df, spec or ANALYSIS_DECIMALS)
    sinks.write_water_years(df, out, by=["series_id"], time_col=time_col, compression="gzip")
    return df


# The observed-discharge file layout (header ``date,QObs(mm/h)``, gage id in the name).
OBS_SCHEMA = "date string, `QObs(mm/h)` double"
OBS_NAME = r"(\d+)-usgs-hourly"


def evaluation_job(spark: SparkSession, nexus_root: str, obs_root: str, mode: str = "masked",
                   gage_of_nexus: DataFrame | None = None, year: int | None = None) -> DataFrame:
    """S6 + S5 + D4 + A3 + A6 + A4/A5 (+ P6): member series from nexus files, observed discharge from CSV,
    the ensemble mean scored as one more member; NSE per (gage, member) in one aggregate.

    ``gage_of_nexus`` (``nex_id, gage_id``) assigns members to gages; without it every member is scored
    against the single observed gage.
    """
    from .operators import evaluate
    from .sources.series import scan_nexus, scan_series
    sims = scan_nexus(spark, nexus_root).select(F.col("nex_id").alias("id"), "datetime", "value")
    obs = scan_series(spark, obs_root, OBS_SCHEMA, "date", with_path=True, recursive=True)
    obs = obs.select(F.regexp_extract("source_path", OBS_NAME, 1).alias("gage_id"),
                     F.col("date").alias("datetime"), F.col("`QObs(mm/h)`").alias("obs"))
    if gage_of_nexus is None:
        gages = [r["gage_id"] for r in obs.select("gage_id").distinct().limit(2).collect()]
        if len(gages) != 1:
            raise ValueError("without gage_of_nexus there must be exactly one observed gage, " + ("none was found" if not gages else f"not {sorted(gages)} and more"))
        sims = sims.withColumn("gage_id", F.lit(gages[0]))
    else:
        sims = sims.join(gage_of_nexus.withColumnRenamed("nex_id", "id"), "id")
    if year is not None:
        lo, hi = F.lit(f"{year}-01-01").cast("timestamp_ntz"), F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
        obs = obs.filter((F.col("datetime") >= lo) & (F.col("datetime") < hi))
        sims = sims.filter((F.col("datetime") >= lo) & (F.col("datetime") < hi))
    members = evaluate.with_mean_member(sims, by=["gage_id"])
    return evaluate.nse_table(obs, members, mode, by=["gage_id"])


def nexus_map_job(spark: SparkSession, outputs_root: str, features: DataFrame, fill: float = 0.0) -> DataFrame:
    """S4 + S6 + A12 + T2 + J8 + V1 + U1 + M3/W4: one read over every region's output folder, listed
    and read by tasks (a missing region just lists nothing), last value per nexus in file order, joined to the map features
    (``vpu, id``) with ``fill`` for nexuses without output, rescaled per region and over all regions."""
    from .functions.scalars import nex_id
    from .operators import maps
    from .sources.series import scan_nexus_values
    values = scan_nexus_values(spark, outputs_root)
    last = written(maps.last_value(values).select(nex_id("nex_id").alias("id"), "value"), "nexus-last")  # the files are read once
    m = maps.map_table(features, last, ["id"], fill=fill)
    m = maps.rescale(m, "value", by=["vpu"], out="scaled_region")
    return maps.rescale(m, "value", by=None, out="scaled_all")


def routing_frames_job(spark: SparkSession, routed_path: str, features: DataFrame, lo: int, hi: int,
                       gamma: float = 0.4, fill: float = 0.0) -> DataFrame:
    """S7 + P7 + T2 + J8 + V1 + M4/W4: routed-flow array tables (one row per feature and time chunk,
    any number of regions) -> time steps ``lo..hi`` by position -> every map feature per frame, zero
    filled -> power-law normalisation per frame. One job for all regions and frames."""
    from .functions.scalars import nex_id
    from .operators import evaluate, maps
    from .sources.series import scan_routed
    long = scan_routed(spark, routed_path, "Time", "flow").select(nex_id("ids").alias("id"), "time", "flow")
    steps = evaluate.position_index(long, "time", "time_idx")
    t = maps.step_table(long, steps, features, lo, hi, fill)
    return maps.power_norm(t, "value", by=["time_idx"], gamma=gamma)
