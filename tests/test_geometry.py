"""Clip, area, holes, distance, projection (G1-G6) and coverage."""

import math

import pytest
from pyspark.sql import functions as F

from catchflow.functions import geometry as geo
from catchflow.operators import coverage as cov
from catchflow.schemas import DIVIDES, Grid

UNIT = Grid("unit", 0.0, 0.0, 1.0, 1.0, 10, 10)


def ring(pts, hole=False, part=0):
    pts = list(pts) + [pts[0]]
    return {"part": part, "hole": hole, "pts": [{"x": float(x), "y": float(y)} for x, y in pts]}


def divides(spark, rows):
    return spark.createDataFrame([(b, d, r) for b, d, r in rows], DIVIDES)


def square(x0, y0, x1, y1, **kw):
    return ring([(x0, y0), (x1, y0), (x1, y1), (x0, y1)], **kw)


def test_clip_square_against_window(spark):
    # G1 clip: square (0,0)-(2,2) against x 0.5..1.25, y 1.5..3 -> area 0.375
    df = divides(spark, [("b", "d", [square(0, 0, 2, 2)])])
    c = geo.clip_rings(geo.clip_rings(F.col("rings"), "x", F.lit(0.5), F.lit(1.25)), "y", F.lit(1.5), F.lit(3.0))
    area = df.select(geo.polygon_area(c).alias("a")).first()["a"]
    assert area == pytest.approx(0.375, abs=1e-12)


def test_hole_subtracts(spark):
    # G1 hole: square (0,0)-(2,2) with hole (0.5,0.5)-(1.5,1.5); cell (0,0) covered 0.75
    df = divides(spark, [("b", "d", [square(0, 0, 2, 2), square(0.5, 0.5, 1.5, 1.5, hole=True)])])
    c = {(r.iy, r.ix): r.coverage for r in cov.coverage(df, UNIT, cells="touch").collect()}
    assert c[(0, 0)] == pytest.approx(0.75, abs=1e-12)
    assert sum(c.values()) == pytest.approx(3.0, abs=1e-12)


def test_concave_and_multipart(spark):
    # a U shape plus a second part; total coverage x cell area = polygon area
    u = ring([(0, 0), (3, 0), (3, 3), (2, 3), (2, 1), (1, 1), (1, 3), (0, 3)])
    extra = square(5.25, 5.25, 6.75, 6.5, part=1)
    df = divides(spark, [("b", "d", [u, extra])])
    total = cov.coverage(df, UNIT, cells="touch").agg(F.sum("coverage")).first()[0]
    assert total == pytest.approx(7.0 + 1.5 * 1.25, abs=1e-9)
    poly = df.select(geo.polygon_area(F.col("rings"))).first()[0]
    assert poly == pytest.approx(total, abs=1e-9)


def test_coverage_in_unit_interval_and_area_property(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(30):
        x0, y0 = rnd.uniform(0, 7), rnd.uniform(0, 7)
        # star-shaped about (x0, y0): angles 2*pi*k/7 plus jitter keep every gap < pi, so the ring is simple
        pts = [(x0 + rad * math.cos(a), y0 + rad * math.sin(a))
               for a, rad in ((2 * math.pi * k / 7 + rnd.uniform(-0.3, 0.3), rnd.uniform(0.3, 2.5)) for k in range(7))]
        rows.append(("b", f"d{i}", [ring(pts)]))
    df = divides(spark, rows)
    c = cov.coverage(df, Grid("g", -5.0, -5.0, 1.0, 1.0, 20, 20), cells="touch")
    assert c.filter((F.col("coverage") <= 0) | (F.col("coverage") > 1 + 1e-12)).count() == 0
    got = {r.divide_id: r.s for r in c.groupBy("divide_id").agg(F.sum("coverage").alias("s")).collect()}
    want = {r.divide_id: r.a for r in df.select("divide_id", geo.polygon_area(F.col("rings")).alias("a")).collect()}
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-9)


def test_centre_rule_drops_cells_outside_basin_bounds(spark):
    # Cells whose centre is outside the basin's bounds are dropped ('centre'), kept with 'touch'
    df = divides(spark, [("b", "d", [square(0.2, 0.2, 2.4, 2.4)])])
    touch = {(r.iy, r.ix) for r in cov.coverage(df, UNIT, cells="touch").collect()}
    centre = {(r.iy, r.ix) for r in cov.coverage(df, UNIT, cells="centre", auto_expand=False).collect()}
    assert (2, 2) in touch and (2, 2) not in centre
    assert centre == {(0, 0), (0, 1), (1, 0), (1, 1)}


def test_extent_auto_expand_thin_slice(spark):
    # A slice with fewer than two cells on an axis is widened by one cell
    b = spark.createDataFrame([("b", 3.2, 3.2, 3.8, 3.8)], "basin_id string, xmin double, ymin double, xmax double, ymax double")
    r = cov.cells_in_extent(b, UNIT).first()
    assert (r.iy_lo, r.iy_hi, r.ix_lo, r.ix_hi) == (2, 4, 2, 4)
    r0 = cov.cells_in_extent(b, UNIT, auto_expand=False).first()
    assert (r0.iy_lo, r0.iy_hi) == (3, 3)


def test_nearest_fill(spark):
    # Uncovered feature at distance 1 from A and 3 from B takes A's cells
    g = Grid("g", 0.0, 0.0, 1.0, 1.0, 4, 4)
    df = divides(spark, [("b", "A", [square(0, 0, 2, 2)]), ("b", "B", [square(2, 2, 4, 4)]),
                         ("b", "M", [square(-3, 0.5, -1, 1.5)])])
    c = cov.coverage(df, g, cells="touch")
    near = cov.nearest_sources(df, c).collect()
    assert [(r.divide_id, r.source_id) for r in near] == [("M", "A")]
    assert near[0].dist == pytest.approx(1.0)
    filled = cov.fill_nearest(c, df)
    assert filled.filter("divide_id = 'M'").count() == c.filter("divide_id = 'A'").count()


def test_polygon_distance_touch_and_gap(spark):
    df = divides(spark, [("b", "a", [square(0, 0, 1, 1)])]).crossJoin(
        divides(spark, [("b", "z", [square(4, 5, 6, 6)])]).select(F.col("rings").alias("r2")))
    d = df.select(geo.polygon_distance(F.col("rings"), F.col("r2"))).first()[0]
    assert d == pytest.approx(5.0)
    inside = divides(spark, [("b", "a", [square(0, 0, 5, 5)])]).crossJoin(
        divides(spark, [("b", "z", [square(1, 1, 2, 2)])]).select(F.col("rings").alias("r2")))
    assert inside.select(geo.polygon_distance(F.col("rings"), F.col("r2"))).first()[0] == 0.0


def test_lcc_closed_form(spark):
    # G3 fixture points (the closed form itself; no independent library here)
    df = spark.createDataFrame([(-97.5, 38.5), (-97.5, 39.5), (-90.0, 35.0)], "lon double, lat double")
    x, y = geo.lcc_xy(F.col("lon"), F.col("lat"), **geo.LCC_FORECAST)
    got = [(round(r[0], 3), round(r[1], 3)) for r in df.select(x, y).collect()]
    assert got[0] == (0.0, 0.0)
    assert got[1] == (0.0, 111204.589)
    assert got[2] == (683665.626, -361565.3)


def test_unravel_spark(spark):
    # Cell 23 with nx 10 -> row 2, column 3
    df = spark.createDataFrame([(23,)], "cell_id long")
    iy, ix = cov.unravel(F.col("cell_id"), 10)
    r = df.select(iy, ix).first()
    assert (r.iy, r.ix) == (2, 3)


def test_nearest_without_any_covered_feature(spark):
    g = Grid("g", 100.0, 100.0, 1.0, 1.0, 4, 4)  # the grid misses every polygon
    df = divides(spark, [("b", "A", [square(0, 0, 2, 2)]), ("b", "M", [square(-3, 0.5, -1, 1.5)])])
    c = cov.coverage(df, g, cells="touch")
    assert c.count() == 0
    assert cov.nearest_sources(df, c).count() == 0


def test_nearest_hundreds_of_tiles_away(spark):
    g = Grid("g", 0.0, 0.0, 1.0, 1.0, 4, 4)
    df = divides(spark, [("b", "A", [square(0, 0, 2, 2)]), ("b", "M", [square(400, 0.5, 401, 1.5)])])
    c = cov.coverage(df, g, cells="touch")
    r = cov.nearest_sources(df, c).collect()
    assert [(x.divide_id, x.source_id, round(x.dist, 9)) for x in r] == [("M", "A", 398.0)]
