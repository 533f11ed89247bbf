"""N-way merge (J9), promised hours (A17, J10), and the forecast job's side tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catchflow.operators import assemble

LONG = "variable string, time int, value double"


def inputs(spark, *rows):
    return [spark.createDataFrame(r, LONG) for r in rows]


A = [("p", 1, 1.0), ("p", 2, 2.0), ("q", 1, 5.0), ("q", 9, None)]
B = [("p", 2, 2.0), ("p", 3, 3.0), ("q", 1, 6.0), ("q", 2, 7.0)]
C = [("q", 2, 7.0), ("q", 3, 8.0), ("r", 1, 0.0), ("p", 1, None)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_salvage_sets_whole_variables_aside(spark):
    merged, aside, report = assemble.merge_many(inputs(spark, A, B, C), ["time"])
    # B's q contradicts A's at time 1 and goes as a whole; C's q agrees with what was first everywhere
    assert rows(merged) == [("p", 1, 1.0), ("p", 2, 2.0), ("p", 3, 3.0), ("q", 1, 5.0), ("q", 2, 7.0), ("q", 3, 8.0), ("r", 1, 0.0)]
    assert rows(aside) == [(1, "q", 1, 6.0), (1, "q", 2, 7.0)]
    assert rows(report) == [(0, "p", 2, 0), (0, "q", 1, 0), (1, "p", 2, 0), (1, "q", 2, 1), (2, "q", 2, 0), (2, "r", 1, 0)]


def test_other_policies(spark):
    first, aside, _ = assemble.merge_many(inputs(spark, A, B, C), ["time"], on_conflict="first")
    assert ("q", 1, 5.0) in rows(first) and aside.count() == 0
    nulled, _, _ = assemble.merge_many(inputs(spark, A, B, C), ["time"], on_conflict="null")
    assert [r for r in rows(nulled) if r[0] == "q"] == [("q", 2, 7.0), ("q", 3, 8.0)]
    with pytest.raises(Exception, match="merge conflict in q"):
        assemble.merge_many(inputs(spark, A, B, C), ["time"], on_conflict="error")[0].collect()
    assert rows(assemble.merge_many(inputs(spark, A, C), ["time"], on_conflict="error")[0])[0] == ("p", 1, 1.0)
    with pytest.raises(ValueError):
        assemble.merge_many(inputs(spark, A), ["time"], on_conflict="guess")
    empty, aside, report = assemble.merge_many(inputs(spark, [], []), ["time"])
    assert empty.count() == aside.count() == report.count() == 0


def test_one_plain_aggregate(spark):
    from catchflow.session import written
    merged, _, _ = assemble.merge_many([written(d, "input") for d in inputs(spark, A, B, C)], ["time"])
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString()


def test_promised_hours_and_status(spark):
    begin = dt.datetime(2024, 5, 1, 0)
    p = assemble.promised_hours(spark, begin, begin + dt.timedelta(hours=2), ["T"], ["P"], 3)
    assert rows(p)[:2] == [("20240430_20z_fcst.zarr", "P", begin), ("20240430_21z_fcst.zarr", "P", begin + dt.timedelta(hours=1))] and p.count() == 6
    seen = spark.createDataFrame([("20240430_20z_fcst.zarr", "P", begin), ("20240501_00z_anl.zarr", "T", begin + dt.timedelta(hours=1))], p.schema)
    errors = spark.createDataFrame([("20240501_02z_anl.zarr", "T")] * 2 + [("20240430_20z_fcst.zarr", "P")], "store string, variable string")
    got = {(r.store, r.time.hour): r.status for r in assemble.hour_status(p, seen, errors).collect()}
    assert got == {("20240430_20z_fcst.zarr", 0): "present", ("20240430_21z_fcst.zarr", 1): "missing", ("20240430_22z_fcst.zarr", 2): "missing",
                   ("20240501_00z_anl.zarr", 0): "missing", ("20240501_00z_anl.zarr", 1): "extra", ("20240501_01z_anl.zarr", 1): "missing", ("20240501_02z_anl.zarr", 2): "unreadable"}


def test_job_with_a_conflict_and_projected_catchments(spark, tmp_dir):
    """A variable in both kinds of runs: the forecast's contradicts and is set aside; catchments are in another system."""
    from catchflow import jobs
    from catchflow.functions import geometry as geo
    from catchflow.functions import projections as proj
    from catchflow.schemas import Grid
    from catchflow.sources import chunks
    cells = [(iy, ix) for iy in range(3) for ix in range(3)]
    values = [("20240501_02z_anl.zarr", "T", 0, iy, ix, 10.0) for iy, ix in cells] + [("20240501_02z_anl.zarr", "U", 0, iy, ix, 1.0 + ix) for iy, ix in cells]
    values += [("20240501_00z_fcst.zarr", v, 1, iy, ix, x) for v, x in (("T", 11.0), ("P", 4.0)) for iy, ix in cells]
    chunks.write_archive(spark.createDataFrame(values, "store string, variable string, t long, iy long, ix long, value double"), f"{tmp_dir}/runs", (3, 3),
                         {"anl": [0], "fcst": [1, 2, 3]}, lambda s: f"{s[:4]}-{s[4:6]}-{s[6:8]} {s[9:11]}:00:00")
    grid = Grid("g", -100.0, 40.0, 1.0, 1.0, 3, 3)
    box = geo.rectangle(F.lit(-99.5), F.lit(40.25), F.lit(-98.5), F.lit(41.25))
    d = spark.range(1).select(F.lit("b").alias("basin_id"), F.lit("c").alias("divide_id"), proj.move_rings(box, "EPSG:4326", "EPSG:5070").alias("rings"), F.lit("EPSG:5070").alias("crs"))
    out = jobs.forecast_job(spark, f"{tmp_dir}/runs", ["T", "U"], ["T", "P"], 1, d, grid, f"{tmp_dir}/out", cells="touch", required=["U", "P"])
    got = out.collect()
    assert len(got) == 1
    r = got[0]
    assert (r["T"], r["P"]) == (10.0, 4.0) and r["U"] == pytest.approx(1.5, abs=1e-6)
    aside = spark.read.parquet(f"{tmp_dir}/out/salvage")
    assert {(x["input"], x["variable"], x["value"]) for x in aside.collect()} == {(1, "T", 11.0)}
    status = spark.read.parquet(f"{tmp_dir}/out/status")
    assert {(x["variable"], x["time"].hour) for x in status.where("status = 'present'").collect()} == {("T", 2), ("U", 2), ("P", 2)}
    assert status.where("status = 'missing'").count() == 24 * 4 - 4 and spark.read.parquet(f"{tmp_dir}/out/skipped").count() == 0
    # nothing covered: nothing is opened, nothing is written for any basin
    far = d.withColumn("rings", proj.move_rings(geo.rectangle(F.lit(20.0), F.lit(40.25), F.lit(21.0), F.lit(41.25)), "EPSG:4326", "EPSG:5070"))
    assert jobs.forecast_job(spark, f"{tmp_dir}/runs", ["T"], ["P"], 1, far, grid, f"{tmp_dir}/none", cells="touch").count() == 0
