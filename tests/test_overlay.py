"""The edge-wise overlay (J2, G1) cell by cell against plain clipping."""

import math
import random

import pytest
from pyspark.sql import functions as F

from catchflow.operators import coverage as cov
from catchflow.schemas import DIVIDES, Grid


def ring(pts, hole=False, part=0):
    return {"part": part, "hole": hole, "pts": [{"x": float(x), "y": float(y)} for x, y in list(pts) + [pts[0]]]}


def clip(pts, axis, bound, above):
    out = []
    for p, q in zip(pts, pts[1:] + pts[:1]):
        inside = [(v[axis] >= bound) if above else (v[axis] <= bound) for v in (p, q)]
        if inside[0]:
            out.append(p)
        if inside[0] != inside[1]:
            t = (bound - p[axis]) / (q[axis] - p[axis])
            out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
    return out


def plain_area(pts, x0, y0, x1, y1):
    for axis, bound, above in ((0, x0, True), (0, x1, False), (1, y0, True), (1, y1, False)):
        pts = clip(pts, axis, bound, above) if pts else pts
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(pts, pts[1:] + pts[:1]))) / 2


def plain_coverage(rings, grid):
    out = {}
    for iy in range(grid.ny):
        for ix in range(grid.nx):
            box = grid.x0 + ix * grid.dx, grid.y0 + iy * grid.dy, grid.x0 + (ix + 1) * grid.dx, grid.y0 + (iy + 1) * grid.dy
            a = sum((-1 if r["hole"] else 1) * plain_area([(p["x"], p["y"]) for p in r["pts"][:-1]], *box) for r in rings)
            if a / grid.cell_area > 1e-9:
                out[iy, ix] = a / grid.cell_area
    return out


def star(rnd, x, y, lo, hi, n):
    return [(x + r * math.cos(a), y + r * math.sin(a)) for a, r in ((2 * math.pi * (k + rnd.uniform(-0.3, 0.3)) / n, rnd.uniform(lo, hi)) for k in range(n))]


GRIDS = [Grid("g", 0.0, 0.0, 1.0, 1.0, 12, 9), Grid("g", -3.25, 1.5, 0.75, 0.4, 20, 25), Grid("g", 1e6, -2e6, 1000.0, 1000.0, 8, 8)]


@pytest.mark.parametrize("grid", GRIDS)
def test_overlay_equals_clipping(spark, grid):
    rnd = random.Random(3)
    w, h, rows = grid.nx * grid.dx, grid.ny * grid.dy, []
    for i in range(25):
        x, y, size = grid.x0 + rnd.uniform(-0.1, 1.1) * w, grid.y0 + rnd.uniform(-0.1, 1.1) * h, rnd.uniform(0.02, 0.6) * min(w, h)
        outer = star(rnd, x, y, 0.6 * size, size, rnd.randint(3, 12))
        rings = [ring(outer if rnd.random() < 0.5 else outer[::-1])]
        if rnd.random() < 0.6:
            inner = star(rnd, x, y, 0.05 * size, 0.2 * size, 5)
            rings.append(ring(inner if rnd.random() < 0.5 else inner[::-1], hole=True))
        if rnd.random() < 0.4:
            rings.append(ring(star(rnd, x + 3 * size, y, 0.2 * size, 0.4 * size, 6), part=1))
        rows.append(("b", f"d{i}", rings))
    # edges on grid lines, a polygon that is one cell, one that is the whole grid, and one larger than it
    for i, (a, b, c, d) in enumerate(((2, 3, 5, 6), (0, 0, 1, 1), (0, 0, grid.nx, grid.ny), (-2, -2, grid.nx + 2, grid.ny + 2), (1.5, 2, 1.5, 4))):
        rows.append(("b", f"line{i}", [ring([(grid.x0 + u * grid.dx, grid.y0 + v * grid.dy) for u, v in ((a, b), (c, b), (c, d), (a, d))])]))
    got = {}
    for r in cov.coverage(spark.createDataFrame(rows, DIVIDES), grid, cells="touch").collect():
        assert (r.divide_id, r.iy, r.ix) not in got and r.cell_id == r.iy * grid.nx + r.ix
        got[r.divide_id, r.iy, r.ix] = r.coverage
    want = {(d, *cell): a for _, d, rings in rows for cell, a in plain_coverage(rings, grid).items()}
    assert {k for k, v in got.items() if v > 1e-9} == set(want)
    assert all(got[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())


def test_shapeless_features_have_no_cells(spark):
    rows = [("b", "null", None), ("b", "empty", []), ("b", "point", [ring([(2.5, 2.5)])]), ("b", "flat", [ring([(1, 1), (3, 3), (5, 5)])]), ("b", "real", [ring([(1, 1), (2, 1), (2, 2)])])]
    for cells in ("touch", "centre"):
        got = cov.coverage(spark.createDataFrame(rows, DIVIDES), GRIDS[0], cells=cells)
        assert {r.divide_id for r in got.collect()} == {"real"}


def test_no_polygon_crosses_a_shuffle(spark):
    df = spark.createDataFrame([("b", "d", [ring([(1, 1), (2, 1), (2, 2)])])], DIVIDES)
    plan = cov.coverage(df, GRIDS[0], cells="touch")._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index("RepartitionByExpression")
    assert "rings" not in plan[:at] and "Array" not in plan[at:plan.index("Generate", at)]


def test_basin_extent_cuts_rows_and_columns(spark):
    big, small = ring([(-50, -50), (60, -50), (60, 60), (-50, 60)]), ring([(3.2, 3.2), (5.9, 3.2), (5.9, 5.9), (3.2, 5.9)])
    grid = GRIDS[0]
    b = spark.createDataFrame([("b", 3.2, 3.2, 5.9, 5.9)], "basin_id string, xmin double, ymin double, xmax double, ymax double")
    r = cov.cells_in_extent(b, grid).first()
    got = {(c.iy, c.ix): c.coverage for c in cov.coverage(spark.createDataFrame([("b", "small", [small])], DIVIDES), grid, cells="centre").collect()}
    want = {k: v for k, v in plain_coverage([small], grid).items() if r.iy_lo <= k[0] <= r.iy_hi and r.ix_lo <= k[1] <= r.ix_hi}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v, abs=1e-12) for k, v in want.items())
    whole = cov.coverage(spark.createDataFrame([("b", "big", [big])], DIVIDES), grid, cells="centre")
    assert whole.count() == grid.nx * grid.ny and whole.where(F.col("coverage") != 1.0).count() == 0
