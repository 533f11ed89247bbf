"""Projections against published worked examples, and the split container scan."""

import os

import pytest
from pyspark.sql import functions as F

from catchflow.functions import projections as proj
from catchflow.schemas import DIVIDES
from catchflow.sources import container_source as src
from catchflow.sources import containers

CLARKE = proj.Ellipsoid(6378206.4, 0.00676866)


def at(spark, x, y, source, target):
    r = spark.range(1).select(proj.move_point(F.lit(x), F.lit(y), source, target).alias("p")).first()["p"]
    return r["x"], r["y"]


def test_worked_examples(spark):
    # Snyder 1987, numerical examples of the ellipsoidal conics: 35 N 75 W
    geographic = proj.System("geographic", CLARKE)
    albers = proj.System("albers", CLARKE, -96.0, 23.0, 29.5, 45.5)
    x, y = at(spark, -75.0, 35.0, geographic, albers)
    assert (x, y) == (pytest.approx(1885472.7, abs=0.06), pytest.approx(1535925.0, abs=0.06))
    lambert = proj.System("lambert", CLARKE, -96.0, 23.0, 33.0, 45.0)
    x, y = at(spark, -75.0, 35.0, geographic, lambert)
    assert (x, y) == (pytest.approx(1894410.9, abs=0.06), pytest.approx(1564649.5, abs=0.06))


@pytest.mark.parametrize("name", ["EPSG:5070", "EPSG:3338", "EPSG:3347", "lcc_forecast"])
def test_there_and_back(spark, name):
    s = proj.SYSTEMS[name]
    for dlon, lat in ((0.0, 40.0), (-30.0, 25.0), (25.0, 60.0), (3.5, 48.25)):
        lon = (s.lon0 + dlon + 180) % 360 - 180
        x, y = at(spark, lon, lat, "EPSG:4269", s)
        back = at(spark, x, y, s, "EPSG:4269")
        assert back == (pytest.approx(lon, abs=2e-9), pytest.approx(lat, abs=2e-9))


def test_southern_cone(spark):
    s = proj.System("albers", proj.GRS80, 132.0, 0.0, -18.0, -36.0)
    x, y = at(spark, 140.0, -25.0, "EPSG:4269", s)
    assert x > 0 > y and at(spark, x, y, s, "EPSG:4269") == (pytest.approx(140.0, abs=2e-9), pytest.approx(-25.0, abs=2e-9))


WKT = ('PROJCS["NAD83 / Conus Albers",GEOGCS["NAD83",DATUM["North_American_Datum_1983",SPHEROID["GRS 1980",6378137,298.257222101]]],'
       'PROJECTION["Albers_Conic_Equal_Area"],PARAMETER["latitude_of_center",23],PARAMETER["longitude_of_center",-96],'
       'PARAMETER["standard_parallel_1",29.5],PARAMETER["standard_parallel_2",45.5],PARAMETER["false_easting",0],PARAMETER["false_northing",0]]')


def test_wkt():
    assert proj.from_wkt(WKT) == proj.SYSTEMS["EPSG:5070"]
    assert proj.system("CUSTOM:1", WKT).kind == "albers"
    with pytest.raises(ValueError, match="unknown coordinate system"):
        proj.system("EPSG:99999")
    with pytest.raises(ValueError, match="unknown projection"):
        proj.from_wkt(WKT.replace("Albers_Conic_Equal_Area", "Mercator_1SP"))


def square(x, y):
    return [{"part": 0, "hole": False, "pts": [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y))]}]


def two_parts(x, y):
    hole = [{"part": 0, "hole": True, "pts": [{"x": x + 0.25 + a, "y": y + 0.25 + b} for a, b in ((0, 0), (0.5, 0), (0.5, 0.5), (0, 0))]}]
    return square(x, y) + hole + [dict(r, part=1) for r in square(x + 5, y)]


def test_rows_in_different_systems(spark):
    rows = spark.createDataFrame([("a", square(-96, 40), "EPSG:4269", None), ("b", square(-96, 40), "EPSG:4326", None), ("c", [], "EPSG:4326", None), ("d", None, "CUSTOM:7", WKT)],
                                 f"id string, rings {DIVIDES['rings'].dataType.simpleString()}, crs string, wkt string")
    out = {r["id"]: r for r in proj.to_system(rows, "EPSG:5070", wkt_col="wkt").collect()}
    first = out["a"]["rings"][0]["pts"][0]
    assert first["x"] == pytest.approx(0.0, abs=1e-6) and first["y"] > 1.8e6 and out["c"]["rings"] == [] and out["d"]["rings"] is None
    assert {r["crs"] for r in out.values()} == {"EPSG:5070"}
    with pytest.raises(ValueError, match="without a coordinate system"):
        proj.to_system(rows.withColumn("crs", F.lit(None).cast("string")), "EPSG:5070")
    assert proj.to_system(rows, "EPSG:4326", override="EPSG:4326").where("id = 'a'").first()["rings"][0]["pts"][0]["x"] == -96.0


@pytest.fixture
def big(spark, tmp_dir):
    rows = [("big", f"d{i}", two_parts(i % 40 * 2.0, i // 40 * 2.0) if i % 7 else square(i % 40 * 2.0, i // 40 * 2.0)) for i in range(3000)] + [("big", "none", None)]
    df = spark.createDataFrame(rows, DIVIDES)
    containers.write_divides(df, tmp_dir, srs="EPSG:5070", wkt=WKT, rtree=True)
    return tmp_dir, df


def test_one_container_read_by_several_tasks(spark, big):
    root, df = big
    size = os.path.getsize(f"{root}/big.gpkg")
    whole = containers.scan_divides(spark, root, with_crs=True)
    split = containers.scan_divides(spark, root, with_crs=True, split_bytes=size // 5)
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() in (5, 6)
    a, b = (sorted(map(str, x.collect())) for x in (whole, split))
    assert a == b and len(a) == 3001
    tasks = split.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 5 and max(r["count"] for r in tasks) < 1000
    back = {r["divide_id"]: r["rings"] for r in split.collect()}
    assert back["none"] == [] and all(back[r["divide_id"]] == r["rings"] for r in df.where("rings IS NOT NULL").collect())
    assert {(r["crs"], r["wkt"]) for r in split.select("crs", "wkt").distinct().collect()} == {("EPSG:5070", WKT)}


def test_batches_stay_small(big):
    root, _ = big
    reader = src.ContainerReader({"paths": f'["{root}"]'})
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    assert len(batches) >= 3 and max(b.num_rows for b in batches) <= src.BATCH_FEATURES and batches[0].schema == src.ARROW


def test_extent_reads_few_features(spark, big):
    root, _ = big
    got = sorted(r["divide_id"] for r in containers.scan_divides(spark, root, extent=(2.5, 3.0, 4.5, 4.0)).collect())
    reader = src.ContainerReader({"paths": f'["{root}"]'})
    from pyspark.sql.datasource import GreaterThanOrEqual, LessThanOrEqual
    list(reader.pushFilters([GreaterThanOrEqual(("xmax",), 2.5), LessThanOrEqual(("xmin",), 4.5), GreaterThanOrEqual(("ymax",), 3.0), LessThanOrEqual(("ymin",), 4.0)]))
    decoded = sorted(i for part in reader.partitions() for b in reader.read(part) for i in b.column("feature_id").to_pylist())
    assert got == decoded and 0 < len(got) < 30


def test_broken_and_missing_containers(spark, big):
    root, _ = big
    with open(f"{root}/broken.gpkg", "wb") as fh:
        fh.write(b"SQLite format 3\0 but nothing else" * 10_000)
    with pytest.raises(Exception, match="DatabaseError|file is not a database|malformed"):
        containers.scan_divides(spark, root).count()
    assert containers.scan_divides(spark, root, tolerant=True).count() == 3001
    assert containers.container_errors(spark, root, split_bytes=1000).count() == 1
    assert containers.scan_divides(spark, f"{root}/absent", tolerant=True).count() == 0


def test_forcing_job_reports_what_it_could_not_read(spark, tmp_dir):
    from catchflow import jobs
    from catchflow.plans import q_sources, views
    sf = "/root/testdata/sf0.001"
    years = q_sources.write_raster_stores(spark, sf, f"{tmp_dir}/stores", dtype="<f8")
    d = views.divides(spark, sf).where("basin_id = '1'")
    d = d.union(d.limit(1).withColumn("divide_id", F.lit("cat-none")).withColumn("rings", F.lit(None).cast(DIVIDES["rings"].dataType)))
    containers.write_divides(d, f"{tmp_dir}/gpkg")
    with open(f"{tmp_dir}/gpkg/9.gpkg", "wb") as fh:
        fh.write(b"broken")
    out = jobs.forcing_job(spark, f"{tmp_dir}/stores/{{year}}", (years[0], years[0] + 1), ["qty", "disc"], f"{tmp_dir}/gpkg", views.GRID, f"{tmp_dir}/out", f"{tmp_dir}/ledger", fill=True)
    assert out.count() > 0
    errors = spark.read.parquet(f"{tmp_dir}/out/errors").collect()
    assert sorted((r["basin_id"], r["divide_id"]) for r in errors) == [("1", "cat-none"), ("9", None)]


def test_sphere_equals_closed_form(spark):
    from catchflow.functions import geometry as geo
    x, y = geo.lcc_xy(F.lit(-90.0), F.lit(35.0), **geo.LCC_FORECAST)
    want = spark.range(1).select(x, y).first()
    assert at(spark, -90.0, 35.0, "EPSG:4326", "lcc_forecast") == (pytest.approx(want[0], abs=1e-6), pytest.approx(want[1], abs=1e-6))
