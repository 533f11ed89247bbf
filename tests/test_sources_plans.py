"""Chunk and container sources (S1-S4), plan shape checks, and the driver contract."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from catchflow.operators import coverage as cov
from catchflow.operators import forcing
from catchflow.plans import views
from catchflow.sources import chunks, containers

from small_tables import SF_SMALL


@pytest.mark.parametrize("codec", [None, {"id": "zlib"}, {"id": "gzip"}, {"id": "zstd"}, {"id": "lz4"}])
def test_codec_roundtrip(codec):
    raw = np.arange(100, dtype="<f4").tobytes()
    assert chunks.decompress(chunks.compress(raw, codec), codec) == raw


def test_unknown_codec_names_itself():
    with pytest.raises(ValueError, match="blosc"):
        chunks.decompress(b"x", {"id": "blosc"})


def test_chunk_scan_fill_scale_and_error_row(spark, tmp_dir):
    df = spark.createDataFrame([(t, y, x, float(t * 100 + y * 10 + x)) for t in range(3) for y in range(3) for x in range(4)
                                if not (t == 1 and y == 1 and x == 1)], "t long, iy long, ix long, v double")
    root = f"{tmp_dir}/store"
    chunks.write_store(df, root, ["v"], (3, 3, 4), (2, 2, 2), [0, 1, 2], "2000-01-01 00:00:00", {"id": "zlib"})
    out = chunks.scan_chunks(spark, root, ["v"])
    assert out.count() == 36                      # dense: edge chunks trimmed to the array shape
    assert out.filter(F.col("value").isNull()).count() == 1   # fill value -> NULL
    assert chunks.scan_chunks(spark, root, ["v"], drop_fill=True).count() == 35
    with open(f"{root}/v/0.0.0", "wb") as fh:
        fh.write(b"garbage")
    assert chunks.scan_chunks(spark, root, ["v"], tolerant=True).count() == 36 - 8
    with pytest.raises(Exception, match="ValueError"):  # by default a chunk that can't be read fails the scan
        chunks.scan_chunks(spark, root, ["v"]).count()
    assert chunks.chunk_errors(spark, root, ["v"]).count() == 1


def test_container_roundtrip_and_tolerance(spark, tmp_dir):
    d = views.divides(spark, SF_SMALL)
    root = f"{tmp_dir}/gpkg"
    containers.write_divides(d, root)
    with open(f"{root}/broken.gpkg", "wb") as fh:
        fh.write(b"nope")
    back = containers.scan_divides(spark, root, tolerant=True)
    assert sorted(back.select("divide_id").collect()) == sorted(d.select("divide_id").collect())
    assert containers.container_errors(spark, root).count() == 1
    with pytest.raises(Exception):
        containers.scan_divides(spark, root, tolerant=False).count()


def test_catchment_plan_shape(spark):
    r = views.raster(spark, SF_SMALL)
    c = cov.coverage(views.divides(spark, SF_SMALL), views.GRID, cells="touch")
    plan = forcing.catchment_mean(r, c, views.RASTER_VARS)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    from catchflow.operators.compare import in_range
    w = in_range(views.water(spark, SF_SMALL), "time", "1995-01-01", "1995-12-31").select("key")
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "o_totalprice" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_entry_and_oracle_on_smallest_tables(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["basin_id", "time", "qty", "disc"]
    con = duckdb.connect()
    for t in ("lineitem", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = sorted(tuple(r) for r in con.execute(E.oracle_sql()["basin_forcing"]).fetchall())
    got = sorted(tuple(r) for r in rows)
    assert got == want


def test_every_query_has_a_builder():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 78
    from catchflow.plans.registry import ORACLES, QUERIES
    assert set(ORACLES) == set(QUERIES)


def test_sample_is_deterministic(spark):
    from catchflow.operators.compare import sample_ids
    ids = views.basins(spark, SF_SMALL)
    a = sorted(sample_ids(ids, "basin_id", 15, 42).collect())
    b = sorted(sample_ids(ids, "basin_id", 15, 42).collect())
    assert a == b and len(a) == 15
    assert sorted(sample_ids(ids, "basin_id", 15, 7).collect()) != a


def test_wkb_multipolygon_with_hole_roundtrip():
    def sq(x0, y0, x1, y1, part, hole):
        pts = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        return {"part": part, "hole": hole, "pts": [{"x": float(x), "y": float(y)} for x, y in pts]}
    rings = [sq(0, 0, 4, 4, 0, False), sq(1, 1, 2, 2, 0, True), sq(6, 6, 7, 7, 1, False)]
    back = containers.decode_geometry(containers.encode_polygon(rings))
    assert [(r["part"], r["hole"], len(r["pts"])) for r in back] == [(0, False, 5), (0, True, 5), (1, False, 5)]
    assert back[2]["pts"][0] == {"x": 6.0, "y": 6.0}


def test_partial_aggregate_before_shuffle(spark):
    # skew safety: the catchment aggregate combines map-side before its exchange
    r = views.raster(spark, SF_SMALL)
    c = cov.coverage(views.divides(spark, SF_SMALL), views.GRID, cells="touch")
    plan = forcing.catchment_mean(r, c, views.RASTER_VARS)._jdf.queryExecution().executedPlan().toString()
    top = plan.split("BroadcastHashJoin")[0]
    assert "partial_sum" in top and "Exchange hashpartitioning(basin_id" in top


def test_sinks_layout(spark, tmp_dir):
    import datetime as dt
    from catchflow import sinks
    df = spark.createDataFrame([("g1", dt.datetime(1999, 9, 30, 23), 1.0), ("g1", dt.datetime(1999, 10, 1, 0), 2.0)],
                               "gage_id string, time timestamp_ntz, v double")
    sinks.write_water_years(df, f"{tmp_dir}/wy", by=["gage_id"], compression="gzip")
    dirs = sorted(os.listdir(f"{tmp_dir}/wy/gage_id=g1"))
    assert dirs == ["water_year=1999", "water_year=2000"]
    files = [f for f in os.listdir(f"{tmp_dir}/wy/gage_id=g1/water_year=2000") if f.endswith(".csv.gz")]
    import gzip
    body = gzip.open(f"{tmp_dir}/wy/gage_id=g1/water_year=2000/{files[0]}", "rt").read().splitlines()
    assert body[0] == "time,v"                      # partition columns leave the file body (K6)
    sinks.write_gage_series(df, f"{tmp_dir}/gage")
    part = [f for f in os.listdir(f"{tmp_dir}/gage/gage_id=g1") if f.endswith(".csv")]
    lines = open(f"{tmp_dir}/gage/gage_id=g1/{part[0]}").read().splitlines()
    assert lines[0] == "time,v" and lines[1].startswith("1999-09-30 23:00:00")   # K8: no index column, time order


def test_raster_table_prunes_partitions_and_pushes_extent(spark, tmp_dir):
    from catchflow import sinks
    from catchflow.sources import series as src
    r = views.raster(spark, SF_SMALL).select("time", "iy", "ix", "qty", "disc")
    sinks.write_raster(r, f"{tmp_dir}/raster", tile=5)
    df = src.scan_raster_table(spark, f"{tmp_dir}/raster", years=(1996, 1998), extent=(0, 4, 5, 9), tile=5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(ty" in plan and "(tx" in plan
    assert "PushedFilters: [IsNotNull(iy), IsNotNull(ix), GreaterThanOrEqual(iy,0)" in plan
    want = r.filter("year(time) in (1996, 1997) and iy <= 4 and ix >= 5")
    assert sorted(df.collect()) == sorted(want.collect())


def test_wkb_point_layer(spark, tmp_dir):
    import sqlite3
    blob = containers.encode_point(-97.5, 38.5)
    assert containers.decode_geometry(blob) == [{"part": 0, "hole": False, "pts": [{"x": -97.5, "y": 38.5}]}]
    con = sqlite3.connect(":memory:")
    con.execute('CREATE TABLE nexus (fid INTEGER PRIMARY KEY, id TEXT, geom BLOB)')
    con.execute("INSERT INTO nexus VALUES (1, 'nex-1', ?)", (blob,))
    con.commit()
    os.makedirs(f"{tmp_dir}/hf", exist_ok=True)
    with open(f"{tmp_dir}/hf/01.gpkg", "wb") as fh:
        fh.write(con.serialize())
    d = containers.scan_divides(spark, f"{tmp_dir}/hf", layer="nexus", id_col="id").collect()
    assert [(r.basin_id, r.divide_id, r.rings[0].pts[0].x) for r in d] == [("01", "nex-1", -97.5)]


def test_public_api_names():
    from catchflow import api
    planned = """scan_raster scan_chunks scan_divides scan_series file_catalog hourly_paths project set_crs total_bounds
    cells_in_extent coverage fill_nearest flatten_coverage cached_coverage catchment_mean basin_mean to_dense from_dense
    to_long to_wide date_spine align_forecast dedupe_last duplicates merge_fields merge_conflicts keep_promised
    completeness required_vars round_decimals round_sigfigs water_year clamp_to_water_year compile_gage pad_gage
    ensemble_wide ensemble_mean nse nse_table feature_index feature_stats top_feature first_nonzero join_three
    last_value map_table step_table rescale power_norm label_union in_span profile sample_ids pending record
    ingest_daily write_series write_water_years write_dense""".split()
    assert [n for n in planned if not callable(getattr(api, n, None))] == []


def test_chunk_scan_fails_loudly(spark, tmp_dir):
    import json
    import os

    from catchflow.sources import chunks
    rows = spark.range(4).selectExpr("id AS t", "0L AS iy", "0L AS ix", "CAST(id AS double) AS v")

    def store(name, **change):
        root = f"{tmp_dir}/{name}"
        chunks.write_store(rows, root, ["v"], (4, 1, 1), (4, 1, 1), [0, 1, 2, 3], "2000-01-01 00:00:00", None, unit=change.pop("unit", "hours"))
        meta = json.load(open(f"{root}/v/.zarray"))
        json.dump(meta | change, open(f"{root}/v/.zarray", "w"))
        return root

    for name, change, words in (("blosc", {"compressor": {"id": "blosc"}}, "unsupported chunk codec"), ("filter", {"filters": [{"id": "delta"}]}, "filters"),
                                ("unit", {"unit": "fortnights"}, "unknown time units")):
        root = store(name, **change)
        with pytest.raises(Exception, match=words):
            chunks.scan_chunks(spark, root, ["v"]).collect()
        assert chunks.scan_chunks(spark, root, ["v"], tolerant=True).count() == 0
        assert chunks.chunk_errors(spark, root, ["v"]).count() == 1
    days = chunks.scan_chunks(spark, store("days", unit="days"), ["v"]).orderBy("time").collect()
    assert [r.time.day for r in days] == [1, 2, 3, 4]
    os.remove(f"{tmp_dir}/days/v/.zarray")
    with pytest.raises(Exception, match="no array metadata"):
        chunks.scan_chunks(spark, f"{tmp_dir}/days", ["v"]).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        chunks.scan_chunks(spark, f"{tmp_dir}/never", ["v"]).collect()
    assert chunks.scan_chunks(spark, f"{tmp_dir}/never", ["v"], tolerant=True).count() == 0


def test_cache_is_keyed_by_the_polygons(spark, tmp_dir):
    from catchflow.operators import post
    from catchflow.plans import views
    sf = "/root/testdata/sf0.001"
    total = lambda d: round(post.cached_coverage(spark, tmp_dir, "n", d, views.GRID, cells="touch").groupBy().sum("coverage").first()[0], 6)
    rect, tri = views.divides(spark, sf), views.divides(spark, sf, "tri")
    assert total(rect) == 35.75 and total(tri) == 17.875 and total(rect) == 35.75


def test_several_gages_need_a_mapping(spark, tmp_dir):
    import os

    from catchflow import jobs
    for g in ("01", "02"):
        os.makedirs(f"{tmp_dir}/obs", exist_ok=True)
        with open(f"{tmp_dir}/obs/{g}-usgs-hourly.csv", "w") as fh:
            fh.write("date,QObs(mm/h)\n2000-01-01 00:00:00,1.0\n")
    os.makedirs(f"{tmp_dir}/sim/nex-1_output", exist_ok=True)
    with open(f"{tmp_dir}/sim/nex-1_output/a.csv", "w") as fh:
        fh.write("0,2000-01-01 00:00:00,1.0\n")
    with pytest.raises(ValueError, match="exactly one observed gage"):
        jobs.evaluation_job(spark, f"{tmp_dir}/sim", f"{tmp_dir}/obs")


def test_large_water_year_is_several_files(spark, tmp_dir):
    import glob

    from catchflow import sinks
    df = spark.range(20000).selectExpr("timestamp_ntz '2000-10-01 00:00:00' + make_dt_interval(0, CAST(id % 8000 AS int)) AS time", "CAST(id AS double) AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_water_years(df, f"{tmp_dir}/wy", by=[])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(f"{tmp_dir}/wy/water_year=2001/*.csv")) > 1
    assert spark.read.option("header", True).csv(f"{tmp_dir}/wy").count() == 20000


def test_nexus_files_are_one_a_nexus_and_replaced(spark, tmp_path):
    """Files, not folders; an overwrite replaces the nexuses it writes and keeps the others; odd ids and nulls come back."""
    import glob
    from pyspark.sql import functions as F
    from catchflow import sinks
    from catchflow.sources.series import scan_nexus
    path = f"file://{tmp_path}/nexus"

    def rows(ids, n, value):
        return spark.createDataFrame([(v, i, k, value + k if k else None) for v, i in ids for k in range(n)], "vpu string, id string, index long, value double").withColumn(
            "datetime", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    sinks.write_nexus_files(rows([("1", "7"), ("1", "8"), (None, "9"), ("2", None)], 5, 0.5), path, partition_by=["vpu"])
    sinks.write_nexus_files(rows([("1", "8")], 3, 100.25), path, partition_by=["vpu"])
    got = {}
    for r in scan_nexus(spark, path).collect():
        got.setdefault(r["nex_id"], []).append((r["index"], r["value"]))
    old = [(0, None), (1, 1.5), (2, 2.5), (3, 3.5), (4, 4.5)]
    assert {k: sorted(v) for k, v in got.items()} == {"7": old, "9": old, "": old, "8": [(0, None), (1, 101.25), (2, 102.25)]}
    assert all(f.endswith(".csv") for f in glob.glob(f"{tmp_path}/nexus/vpu=1/*")) and not glob.glob(f"{tmp_path}/nexus/*/.nex*")
    sinks.write_nexus_files(rows([("1", "7")], 2, 0.5).limit(0), f"file://{tmp_path}/none")
    assert scan_nexus(spark, f"file://{tmp_path}/none").count() == 0


def test_map_job_reads_the_files_once(spark, tmp_path):
    from pyspark.sql import functions as F
    from catchflow import jobs, sinks
    vals = spark.range(6).select(F.col("id").cast("string").alias("id"), F.lit("1").alias("vpu"), F.lit(1).cast("long").alias("index"),
                                 F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("datetime"), F.col("id").cast("double").alias("value"))
    sinks.write_nexus_files(vals, f"file://{tmp_path}/n", partition_by=["vpu"])
    m = jobs.nexus_map_job(spark, f"file://{tmp_path}/n", vals.select("vpu", F.concat(F.lit("nex-"), "id").alias("id")))
    assert "_output" not in " ".join(m.inputFiles()) and sorted(r["value"] for r in m.collect()) == [0, 1, 2, 3, 4, 5]


def test_nexus_files_are_listed_by_tasks_as_sparks_reader_reads_them(spark, tmp_path):
    """Odd names and lines give what Spark's reader gives, and no list of the files stays in the driver."""
    import gzip
    from catchflow.sources.series import scan_nexus, scan_nexus_values

    def put(name, data):
        f = tmp_path / "n" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(data)
    line = b"%d,2024-01-01 00:00:00,%d.5\n"
    put("vpu=a b%3Ac/nex-x y%3A[1]é_output-1.csv", b"\xef\xbb\xbf1,2024-01-01 00:00:00,2.5\r\n\n  \n2,2024-01-01 01:00:00,\r3,2024-01-01,\"7\"\n4,bad,NaN")
    put("vpu=1/nex-more_output.csv", b"5,2024-01-01 00:00:00\n6\n7,2024-01-01 00:00:00,1.0,7\n8,\"a,b\",2.0,\"c\"\n9,\"a \"\"q\"\" b\",3.0\n")
    put("vpu=1/deep/er/nex-folder_output/part.csv", line % (1, 1))
    put("vpu=1/deep/nex-zip_output.csv.gz", gzip.compress(line % (1, 1) + line % (2, 2)))
    put("vpu=1/nex-none_output.csv", b"")
    put("vpu=1/other.csv", line % (3, 3))
    for name in ("vpu=1/_nex-h_output.csv", "vpu=1/.nex-h_output.csv", "_hid/nex-h_output.csv", "vpu=1/nex-h_output.csv._COPYING_"):
        put(name, line % (9, 9))
    put("vpu=1/_a=nex-seen_output.csv", line % (4, 4))
    root = f"file://{tmp_path}/n"
    got = scan_nexus_values(spark, root)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, (tuple(r) for r in scan_nexus(spark, root).select("nex_id", "index", "value").collect())))
    assert not got.inputFiles() or not any("nex-" in f.rsplit("/", 1)[1] and "_output" in f for f in got.inputFiles())
    assert got.dtypes == scan_nexus(spark, root).select("nex_id", "index", "value").dtypes
    one = f"{root}/vpu=1/other.csv"
    assert scan_nexus_values(spark, one).collect() == scan_nexus(spark, one).select("nex_id", "index", "value").collect()
    put("bad/nex-1_output.csv", b"1,2024-01-01 00:00:00,x\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        scan_nexus_values(spark, f"{root}/bad").collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_nexus_values(spark, f"{root}/nothing").collect()


def test_map_job_leaves_the_list_of_files_to_tasks(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from catchflow import jobs, sinks
    from catchflow.sources import series
    vals = spark.range(40).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).cast("string").alias("vpu"), F.lit(1).cast("long").alias("index"),
                                  F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("datetime"), F.col("id").cast("double").alias("value"))
    sinks.write_nexus_files(vals, f"file://{tmp_path}/n", partition_by=["vpu"])
    monkeypatch.setattr(series, "scan_nexus", lambda *a: pytest.fail("Spark's reader lists all files in the driver"))
    m = jobs.nexus_map_job(spark, f"file://{tmp_path}/n", vals.select("vpu", F.concat(F.lit("nex-"), "id").alias("id")))
    assert sorted(r["value"] for r in m.collect()) == list(range(40))
