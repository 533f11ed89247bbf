"""Weighted catchment mean, basin mean, dense pack."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catchflow.operators import forcing, pack

T0 = dt.datetime(2000, 1, 1)


def cov_df(spark, rows):
    return spark.createDataFrame(rows, "basin_id string, divide_id string, cell_id long, iy long, ix long, coverage double")


def raster_df(spark, rows):
    return spark.createDataFrame(rows, "time timestamp_ntz, iy long, ix long, v double")


def test_weighted_mean(spark):
    c = cov_df(spark, [("b", "d", 0, 0, 0, 1.0), ("b", "d", 1, 0, 1, 0.5)])
    r = raster_df(spark, [(T0, 0, 0, 2.0), (T0, 0, 1, 4.0)])
    v = forcing.catchment_mean(r, c, ["v"]).first()["v"]
    assert v == pytest.approx(2.666667, abs=1e-6)


def test_poisoning_null_and_missing_row(spark):
    c = cov_df(spark, [("b", "d", 0, 0, 0, 1.0), ("b", "d", 1, 0, 1, 0.5)])
    r = raster_df(spark, [(T0, 0, 0, 2.0), (T0, 0, 1, None), (T0 + dt.timedelta(hours=1), 0, 0, 2.0)])
    rows = {x.time: x.v for x in forcing.catchment_mean(r, c, ["v"]).collect()}
    assert rows[T0] is None                           # NULL cell poisons
    assert rows[T0 + dt.timedelta(hours=1)] is None   # missing row poisons
    skip = {x.time: x.v for x in forcing.catchment_mean(r, c, ["v"], missing="skip").collect()}
    assert skip[T0] == pytest.approx(2.0)


def test_constant_raster_gives_constant(spark):
    c = cov_df(spark, [("b", "d", i, 0, i, 0.1 * (i + 1)) for i in range(5)])
    r = raster_df(spark, [(T0, 0, i, 7.5) for i in range(5)])
    assert forcing.catchment_mean(r, c, ["v"]).first()["v"] == pytest.approx(7.5)


def test_basin_mean_skips(spark):
    df = spark.createDataFrame([("b", "d1", T0, 2.0), ("b", "d2", T0, None), ("b", "d3", T0, 4.0)],
                               "basin_id string, divide_id string, time timestamp_ntz, v double")
    assert forcing.basin_mean(df, ["v"]).first()["v"] == pytest.approx(3.0)


def test_split_polygon_area_weighted_recombination(spark):
    # two halves of one catchment, recombined area-weighted, equal the whole
    whole = cov_df(spark, [("b", "w", i, 0, i, 1.0) for i in range(4)])
    halves = cov_df(spark, [("b", "h1", i, 0, i, 1.0) for i in range(2)] + [("b", "h2", i, 0, i, 1.0) for i in range(2, 4)])
    r = raster_df(spark, [(T0, 0, i, float(i * i)) for i in range(4)])
    w = forcing.catchment_mean(r, whole, ["v"]).first()["v"]
    h = forcing.catchment_mean(r, halves, ["v"])
    weights = spark.createDataFrame([("h1", 2.0), ("h2", 2.0)], "divide_id string, weight double")
    assert forcing.basin_mean(h, ["v"], weights=weights).first()["v"] == pytest.approx(w)


def test_pack_unpack_identity(spark):
    rows = [("b", f"d{k}", T0 + dt.timedelta(hours=h), float(h * k) if h % 5 else None) for k in range(3) for h in range(30)]
    df = spark.createDataFrame(rows, "basin_id string, divide_id string, time timestamp_ntz, v double")
    d = pack.to_dense(df, ["v"], chunk="day")
    assert d.filter(F.size("Time") != F.size("v")).count() == 0
    first = d.orderBy("ids", "chunk").first()
    assert first["Time"] == sorted(first["Time"])
    back = pack.from_dense(d, ["v"])
    assert sorted(back.collect()) == sorted(df.collect())


def test_long_wide_roundtrip(spark):
    df = spark.createDataFrame([(T0, 0, 0, 1.0, 2.0), (T0, 0, 1, None, 3.0)], "time timestamp_ntz, iy long, ix long, a double, b double")
    long = forcing.to_long(df, ["time", "iy", "ix"], ["a", "b"])
    assert long.count() == 4
    wide = forcing.to_wide(long, ["time", "iy", "ix"], ["a", "b"])
    assert sorted(wide.collect()) == sorted(df.collect())


def test_shuffle_join_equals_broadcast(spark):
    from catchflow.operators import coverage as cov
    from catchflow.plans import views
    sf = "/root/testdata/sf0.001"
    r = views.raster(spark, sf)
    c = cov.coverage(views.divides(spark, sf), views.GRID, cells="touch")
    whole = forcing.catchment_mean(r, c, views.RASTER_VARS)
    shuffled = forcing.catchment_mean(r, c, views.RASTER_VARS, join="merge")
    assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()

    def norm(df):
        def r(v):
            return None if v is None else round(v, 9)
        return sorted(((x.divide_id, x.time, r(x.qty), r(x.disc)) for x in df.collect()), key=str)
    assert norm(shuffled) == norm(whole)


def test_incremental_equals_batch(spark):
    from catchflow.plans import load_all
    from catchflow.plans.registry import QUERIES
    load_all()
    sf = "/root/testdata/sf0.001"
    inc = sorted(tuple(r) for r in QUERIES["incremental_daily"](spark, sf).collect())
    batch = sorted(tuple(r) for r in QUERIES["catchment_forcing"](spark, sf).collect())
    assert inc == batch and len(inc) > 0


def test_stream_many_batches_and_rerun_is_idempotent(spark, tmp_dir):
    from catchflow.operators import coverage as cov
    from catchflow.plans import views
    from catchflow.streaming import daily
    sf = "/root/testdata/sf0.001"
    r = views.raster(spark, sf).select("time", "iy", "ix", "qty", "disc")
    c = cov.coverage(views.divides(spark, sf), views.GRID, cells="touch")
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    r.repartition(4, "time").write.parquet(src)
    daily.ingest_daily(spark, src, r.schema, c, ["qty", "disc"], out, ck, max_files_per_trigger=1)
    first = sorted(tuple(x) for x in daily.read_output(spark, out).collect())
    assert spark.read.parquet(out).select("batch").distinct().count() >= 2   # several micro-batches
    daily.ingest_daily(spark, src, r.schema, c, ["qty", "disc"], out, ck)      # nothing new: no new batch
    again = sorted(tuple(x) for x in daily.read_output(spark, out).collect())
    assert again == first
    batch = sorted(tuple(x) for x in forcing.catchment_mean(r, c, ["qty", "disc"]).collect())
    assert first == batch


def test_dense_spine_fills_missing_steps(spark):
    c = cov_df(spark, [("b", "d", 0, 0, 0, 1.0)])
    r = raster_df(spark, [(T0, 0, 0, 1.0), (T0 + dt.timedelta(hours=3), 0, 0, 4.0)])
    sparse = forcing.catchment_mean(r, c, ["v"]).count()
    dense = sorted((x.time, x.v) for x in forcing.catchment_mean(r, c, ["v"], dense="1 hour").collect())
    assert sparse == 2 and len(dense) == 4
    assert dense[1][1] is None and dense[3][1] == 4.0


def test_covered_range_reaches_the_scan(spark, tmp_dir):
    from catchflow.operators import coverage as cov
    from catchflow.plans import views
    from catchflow.schemas import Grid
    sf = "/root/testdata/sf0.001"
    views.raster(spark, sf).select("time", "iy", "ix", *views.RASTER_VARS).write.parquet(f"{tmp_dir}/raster")
    raster = spark.read.parquet(f"{tmp_dir}/raster")
    one = views.divides(spark, sf).filter("divide_id = 'cat-12'")
    c = forcing.prepare_coverage(cov.coverage(one, Grid("unit10", 0.0, 0.0, 1.0, 1.0, 10, 10), cells="touch"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = forcing.catchment_mean(raster, c, views.RASTER_VARS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and f"{tmp_dir}/raster" in line]
    assert pushed and all(f"{op}({col}," in pushed[0] for op in ("GreaterThanOrEqual", "LessThanOrEqual") for col in ("iy", "ix"))
