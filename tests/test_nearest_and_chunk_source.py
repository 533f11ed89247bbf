"""Packed-tree nearest search (J3, G2, W2) and the chunk data source."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual

from catchflow.functions import geometry as geo
from catchflow.operators import coverage as cov
from catchflow.operators import nearest
from catchflow.schemas import DIVIDES
from catchflow.session import written
from catchflow.sources import chunk_source as cs
from catchflow.sources import chunks


def square(x, y, w=1.0):
    pts = [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
    return [{"part": 0, "hole": False, "pts": [{"x": float(a), "y": float(b)} for a, b in pts]}]


def gap(a, b):
    dx = max(0, a[0] - b[0] - b[2], b[0] - a[0] - a[2])
    dy = max(0, a[1] - b[1] - b[2], b[1] - a[1] - a[2])
    return math.hypot(dx, dy)


def features(spark, boxes):
    return spark.createDataFrame([(b, i, None if s is None else [] if s == () else square(*s)) for b, i, s in boxes], DIVIDES)


def test_nearest_ends_with_shapeless_features_and_far_ones(spark):
    have = [("b", f"c{i}", (i % 12 * 2.0, i // 12 * 2.0, 1.0)) for i in range(144)]
    need = [("b", "near", (5.25, 1.25, 0.5)), ("b", "far", (1000.0, -2000.0, 0.5)), ("b", "farther", (-1e6, 1e6, 8.0)), ("b", "null", None), ("b", "empty", ())]
    got = nearest.nearest(features(spark, need), features(spark, have + [("b", "shapeless", None)]), leaf=4).collect()
    for r in got:
        me = dict((i, s) for _, i, s in need)[r.divide_id]
        best = min((gap(me, s), i) for _, i, s in have)
        assert (r.source_id, pytest.approx(best[0], abs=1e-9)) == (best[1], r.dist)
    assert sorted(r.divide_id for r in got) == ["far", "farther", "near"]
    names = [r.divide_id for r in cov.without_geometry(features(spark, need)).collect()]
    assert sorted(names) == ["empty", "null"]


def test_nearest_in_basins_that_share_features(spark):
    have = [("a", "s", (0.0, 0.0, 1.0)), ("b", "s", (0.0, 0.0, 1.0)), ("b", "t", (9.0, 0.0, 1.0))]
    need = [("a", "m", (3.0, 0.0, 1.0)), ("b", "m", (6.0, 0.0, 1.0)), (None, "m", (4.0, 0.0, 1.0))]
    got = nearest.nearest(features(spark, need), features(spark, have)).collect()
    assert {r.basin_id: (r.source_basin, r.source_id, r.dist) for r in got} == {"a": ("a", "s", 2.0), "b": ("b", "t", 2.0), None: ("a", "s", 3.0)}


def test_few_exact_distances_where_features_cluster_far_away(spark, monkeypatch):
    have = [("b", f"c{i}", (i % 50 * 1.5, i // 50 * 1.5, 1.0)) for i in range(2000)]
    need = [("b", f"m{i}", (3000.0 + i, 10.0 * i, 0.5)) for i in range(20)]
    pairs = []
    real = geo.with_polygon_distance

    def counted(df, *args):
        df = written(df, "counted")
        pairs.append(df.count())
        return real(df, *args)
    monkeypatch.setattr(geo, "with_polygon_distance", counted)
    got = {r.divide_id: r.dist for r in nearest.nearest(features(spark, need), features(spark, have)).collect()}
    assert {k: round(v, 6) for k, v in got.items()} == {i: round(min(gap(s, h) for _, _, h in have), 6) for _, i, s in need}
    assert sum(pairs) <= 20 * 2 * nearest.LEAF  # of 40,000 pairs


def test_one_exact_distance_a_shape_and_its_rivals(spark, monkeypatch):
    """Shapes that features share are searched once; only members with a box as near as the best are measured."""
    have = [(f"b{i % 3}", f"c{i:04}", (i % 16 * 1.5, i // 16 % 10 * 1.5, 1.0)) for i in range(1600)]
    need = [("b", f"m{i}", (-9.0 + i % 5 * 0.3, 4.1 + i % 5, 0.5)) for i in range(200)] + [("b", "m0", (40.0, 3.2, 0.5)), (None, "n", (-9.0, 4.1, 0.5))]
    pairs = []
    real = geo.with_polygon_distance

    def counted(df, *args):
        df = written(df, "counted")
        pairs.append(df.count())
        return real(df, *args)
    monkeypatch.setattr(geo, "with_polygon_distance", counted)
    got = {(r.basin_id, r.divide_id): (round(r.dist, 6), r.source_id, r.source_basin) for r in nearest.nearest(features(spark, need), features(spark, have)).collect()}
    want = {}
    for b, i, s in need:
        best = min((round(gap(s, h), 6), c, o) for o, c, h in have)
        want[b, i] = min(want.get((b, i), best), best)
    assert got == want
    assert sum(pairs) <= 6 * 4  # six shapes in need, of 320,000 pairs


# ---------------------------------------------------------------- chunk source

def reader(**options):
    return cs.ChunkReader({"variables": json.dumps(["v"]), **options})


def test_pushed_filters_become_ranges():
    r = reader()
    at = ("iy",), ("ix",), ("time",), ("variable",)
    filters = [GreaterThan(at[0], 3), LessThanOrEqual(at[0], 9), LessThan(at[0], 8), In(at[1], (4, 2, 7)), GreaterThanOrEqual(at[2], dt.datetime(1970, 1, 2)),
               EqualTo(at[3], "v"), In(at[3], ("v", "w")), EqualTo(("value",), 1.0), GreaterThan(at[1], 2.5)]
    assert list(r.pushFilters(filters)) == filters  # Spark checks all of them again
    assert r.ranges.low == {"iy": 4, "ix": 2, "time": 86_400_000_000} and r.ranges.high == {"iy": 7, "ix": 7} and r.ranges.names == {"variable": {"v"}}


def big_store(tmp_dir):
    """Metadata of a continental hourly year without a single chunk file."""
    root = f"{tmp_dir}/2020"
    chunks._put(f"{root}/v/.zarray", json.dumps({"shape": [8784, 4201, 8401], "chunks": [144, 128, 256], "dtype": "<f4", "compressor": None, "fill_value": "NaN"}).encode())
    chunks._put(f"{root}/time/.zarray", json.dumps({"shape": [8784], "chunks": [8784], "dtype": "<i8", "compressor": None, "fill_value": None}).encode())
    chunks._put(f"{root}/time/.zattrs", json.dumps({"units": "hours since 2020-01-01 00:00:00"}).encode())
    chunks._put(f"{root}/time/0", b"".join(i.to_bytes(8, "little") for i in range(8784)))
    return root


def test_planning_follows_the_extent(tmp_dir):
    root = big_store(tmp_dir)
    whole = reader(stores=json.dumps([root])).partitions()
    keys = sum(p.last - p.first for part in whole for p in part.pieces)
    assert keys == 61 * 33 * 33 and len(whole) <= cs.MAX_PARTITIONS + 1
    r = reader(stores=json.dumps([root]))
    list(r.pushFilters([GreaterThanOrEqual(("iy",), 100), LessThanOrEqual(("iy",), 130), EqualTo(("ix",), 5000),
                        LessThan(("time",), dt.datetime(2020, 1, 13))]))
    assert sorted(k for part in r.partitions() for p in part.pieces for k in p.keys()) == [(t, y, 19) for t in (0, 1) for y in (0, 1)]
    r = reader(stores=json.dumps([root]))
    list(r.pushFilters([GreaterThan(("iy",), 4201)]))
    assert r.partitions() == []


def test_scan_of_nothing_and_of_missing_files(spark, tmp_dir):
    root = big_store(tmp_dir)
    s = chunks.scan_chunks(spark, root, ["v"])
    assert s.where("iy = 3 and ix = 4").count() == 0  # chunk files that aren't there hold fill values only
    assert s.where("variable = 'other'").count() == 0
    with pytest.raises(Exception, match="absent does not exist"):
        chunks.scan_chunks(spark, root, ["absent"]).count()
    assert chunks.scan_chunks(spark, [root, f"{tmp_dir}/1999"], ["absent", "v"], tolerant=True).where("iy < 2").count() == 0


def test_rows_of_a_box_equal_the_filtered_whole(spark, tmp_dir):
    df = spark.range(7 * 11 * 13).select((F.col("id") % 7).alias("t"), (F.expr("id div 7") % 11).alias("iy"), F.expr("id div 77").alias("ix"), F.col("id").cast("double").alias("v"))
    chunks.write_store(df, f"{tmp_dir}/s", ["v"], (7, 11, 13), (3, 4, 5), [5, 6, 7, 8, 9, 10, 11], "2000-01-01 00:00:00", {"id": "zlib"})
    s = chunks.scan_chunks(spark, f"{tmp_dir}/s", ["v"])
    whole = [tuple(r) for r in s.collect()]
    assert len(whole) == 7 * 11 * 13
    lo, hi = dt.datetime(2000, 1, 1, 7), dt.datetime(2000, 1, 1, 9)
    cut = s.where(F.col("iy").between(3, 5) & F.col("ix").isin(2, 12) & F.col("time").between(lo, hi))
    assert sorted(map(tuple, cut.collect())) == sorted(r for r in whole if lo <= r[0] <= hi and 3 <= r[1] <= 5 and r[2] in (2, 12))


def test_forcing_job_opens_only_covered_chunks(spark, tmp_dir):
    """The job's covered range reaches the source: chunks elsewhere can't be decoded and are never opened."""
    import os

    from catchflow import jobs
    from catchflow.plans import q_sources, views
    from catchflow.sources import containers
    sf = "/root/testdata/sf0.001"
    years = q_sources.write_raster_stores(spark, sf, f"{tmp_dir}/stores", dtype="<f8")
    containers.write_divides(views.divides(spark, sf).where("divide_id = 'cat-0'"), f"{tmp_dir}/gpkg")
    for folder, _, names in os.walk(f"{tmp_dir}/stores"):
        for name in names:
            if name.count(".") == 2 and not name.startswith(".") and name != "0.0.0":
                with open(f"{folder}/{name}", "wb") as fh:
                    fh.write(b"elsewhere")
    out = jobs.forcing_job(spark, f"{tmp_dir}/stores/{{year}}", (years[0], years[0] + 1), ["qty", "disc"], f"{tmp_dir}/gpkg", views.GRID, f"{tmp_dir}/out", f"{tmp_dir}/ledger")
    assert out.count() > 0
