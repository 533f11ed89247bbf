"""Polygon geometry as Catalyst expressions (no UDF).

A polygon is ``rings: array<struct<part:int, hole:boolean, pts:array<struct<x,y>>>>``; rings are
closed (first point repeated last) when they come from a source, but every function here treats a
ring cyclically, so open rings work too. Holes subtract.

Clipping is Sutherland-Hodgman against one axis-aligned half-plane per pass. Each pass is a
``flatten(transform(...))`` over the ring's points; divisions only happen in the branch where the
edge crosses the clip line, so ANSI mode never sees a division by zero.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .projections import to_system


def _pt(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _empty_like(pts: Column) -> Column:
    return F.filter(pts, lambda p: F.lit(False))


def _prev(pts: Column) -> Column:
    """The point array rotated right by one: element i is the cyclic predecessor of pts[i]."""
    n = F.size(pts)
    return F.when(n > 0, F.concat(F.slice(pts, n, 1), F.slice(pts, 1, n - 1))).otherwise(pts)


def _edges(pts: Column, fn) -> Column:
    """``fn(a, b)`` for every cyclic edge a->b; a and b are lambda variables (each read once per edge)."""
    return F.zip_with(_prev(pts), pts, fn)


def _clip_pass(pts: Column, axis: str, bound: Column, keep_ge: bool) -> Column:
    """One Sutherland-Hodgman pass of a cyclic point array against ``axis >= bound`` (or ``<=``)."""
    other = "y" if axis == "x" else "x"

    def inside(p: Column) -> Column:
        return p[axis] >= bound if keep_ge else p[axis] <= bound

    def cross(a: Column, b: Column) -> Column:
        t = (bound - a[axis]) / (b[axis] - a[axis])
        v = a[other] + t * (b[other] - a[other])
        return _pt(bound, v) if axis == "x" else _pt(v, bound)

    def emit(prev: Column, cur: Column) -> Column:
        ci, pi = inside(cur), inside(prev)
        return (F.when(ci & pi, F.array(cur))
                .when(ci, F.array(cross(prev, cur), cur))
                .when(pi, F.array(cross(prev, cur)))
                .otherwise(_empty_like(pts)))

    return F.flatten(_edges(pts, emit))


def clip_rings(rings: Column, axis: str, lo: Column, hi: Column) -> Column:
    """Clip every ring to ``lo <= axis <= hi``; rings that vanish are dropped."""
    def one(r: Column) -> Column:
        p1 = _clip_pass(r["pts"], axis, lo, True)
        return F.struct(r["part"].alias("part"), r["hole"].alias("hole"), p1.alias("pts"))

    def two(r: Column) -> Column:
        p2 = _clip_pass(r["pts"], axis, hi, False)
        return F.struct(r["part"].alias("part"), r["hole"].alias("hole"), p2.alias("pts"))

    # Two separate transforms keep each pass's input a lambda variable (no expression blow-up).
    return F.filter(F.transform(F.transform(rings, one), two), lambda r: F.size(r["pts"]) >= 3)


def ring_area(pts: Column) -> Column:
    """Unsigned shoelace area of a cyclic point array."""
    terms = _edges(pts, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    s = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    return F.when(F.size(pts) >= 3, F.abs(s) / 2.0).otherwise(F.lit(0.0))


def oriented_edges(rings: Column) -> Column:
    """Per ring: ``sign`` and its edges as flat structs ``ax, ay, bx, by``.

    With that sign, going up an edge takes the ring's inside from what lies right of it for an outer ring, whichever way
    the ring runs, and gives it for a hole: the signed heights of a row's edges add up to what is inside.
    """
    def one(r: Column) -> Column:
        e = _edges(r["pts"], lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"),
                                                   b["x"].alias("bx"), b["y"].alias("by")))
        return F.struct(r["hole"].alias("hole"), e.alias("e"), F.element_at(r["pts"], 1).alias("o"))

    def signed(r: Column) -> Column:
        o = r["o"]  # areas about a vertex: large coordinates don't cancel
        twice = F.aggregate(r["e"], F.lit(0.0), lambda s, e: s + (e["ax"] - o["x"]) * (e["by"] - o["y"]) - (e["bx"] - o["x"]) * (e["ay"] - o["y"]))
        return F.struct((F.signum(twice) * F.when(r["hole"], F.lit(1.0)).otherwise(F.lit(-1.0))).alias("sign"), r["e"].alias("e"))
    return F.transform(F.transform(F.filter(rings, lambda r: F.size(r["pts"]) >= 3), one), signed)


def polygon_area(rings: Column) -> Column:
    """Area of a (multi-part) polygon: outer rings minus holes."""
    return F.aggregate(
        rings, F.lit(0.0),
        lambda acc, r: acc + F.when(r["hole"], -ring_area(r["pts"])).otherwise(ring_area(r["pts"])))


def bbox(rings: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) over all vertices."""
    pts = F.flatten(F.transform(rings, lambda r: r["pts"]))
    xs = F.transform(pts, lambda p: p["x"])
    ys = F.transform(pts, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """One closed outer ring for an axis-aligned rectangle."""
    pts = F.array(_pt(x0, y0), _pt(x1, y0), _pt(x1, y1), _pt(x0, y1), _pt(x0, y0))
    return F.array(F.struct(F.lit(0).alias("part"), F.lit(False).alias("hole"), pts.alias("pts")))


def triangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed right triangle (x0,y0), (x1,y0), (x0,y1)."""
    pts = F.array(_pt(x0, y0), _pt(x1, y0), _pt(x0, y1), _pt(x0, y0))
    return F.array(F.struct(F.lit(0).alias("part"), F.lit(False).alias("hole"), pts.alias("pts")))


# ---------------------------------------------------------------- distance

def _segments(rings: Column) -> Column:
    """All edges of all rings as array<struct<a, b>> (cyclic, so open or closed rings both work)."""
    def ring_segs(r: Column) -> Column:
        return _edges(r["pts"], lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r["pts"]) >= 2), ring_segs))


def _point_seg_dist(p: Column, s: Column) -> Column:
    ax, ay, bx, by = s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]
    vx, vy = bx - ax, by - ay
    ll = vx * vx + vy * vy
    t = F.when(ll > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0),
                                                      ((p["x"] - ax) * vx + (p["y"] - ay) * vy) / ll))
               ).otherwise(F.lit(0.0))
    dx = p["x"] - (ax + t * vx)
    dy = p["y"] - (ay + t * vy)
    return F.sqrt(dx * dx + dy * dy)


def _orient(a: Column, b: Column, c: Column) -> Column:
    return F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))


def _segs_cross(s: Column, t: Column) -> Column:
    # Proper or touching crossing by orientation signs (collinear touching counts via distance 0 anyway).
    o1, o2 = _orient(s["a"], s["b"], t["a"]), _orient(s["a"], s["b"], t["b"])
    o3, o4 = _orient(t["a"], t["b"], s["a"]), _orient(t["a"], t["b"], s["b"])
    return (o1 * o2 < 0) & (o3 * o4 < 0)


def with_polygon_distance(df, a: str, b: str, out: str = "dist"):
    """Add ``out`` = :func:`polygon_distance` of two ring columns, with the edge and vertex arrays
    computed once as columns (keeps the generated code small)."""
    tmp = df.select("*", _segments(F.col(a)).alias("_sa"), _segments(F.col(b)).alias("_sb"),
                    F.flatten(F.transform(F.col(a), lambda r: r["pts"])).alias("_pa"),
                    F.flatten(F.transform(F.col(b), lambda r: r["pts"])).alias("_pb"))
    return tmp.withColumn(out, _distance(F.col("_sa"), F.col("_sb"), F.col("_pa"), F.col("_pb"))).drop(
        "_sa", "_sb", "_pa", "_pb")


def polygon_distance(a: Column, b: Column) -> Column:
    """Euclidean distance between two polygons; 0 when they touch, overlap or one contains the other."""
    pa = F.flatten(F.transform(a, lambda r: r["pts"]))
    pb = F.flatten(F.transform(b, lambda r: r["pts"]))
    return _distance(_segments(a), _segments(b), pa, pb)


def _point_in_segs(p: Column, segs: Column) -> Column:
    def crosses(s: Column) -> Column:
        ay, by = s["a"]["y"], s["b"]["y"]
        straddle = (ay > p["y"]) != (by > p["y"])
        xint = s["a"]["x"] + (p["y"] - ay) * (s["b"]["x"] - s["a"]["x"]) / (by - ay)
        return F.when(straddle, p["x"] < xint).otherwise(F.lit(False))
    return (F.size(F.filter(segs, crosses)) % 2) == 1


def _distance(sa: Column, sb: Column, pa: Column, pb: Column) -> Column:
    def min_pt_to(pts: Column, segs: Column) -> Column:
        return F.array_min(F.transform(pts, lambda p: F.array_min(F.transform(segs, lambda s: _point_seg_dist(p, s)))))

    d = F.least(min_pt_to(pa, sb), min_pt_to(pb, sa))
    touching = (F.exists(sa, lambda s: F.exists(sb, lambda t: _segs_cross(s, t)))
                | _point_in_segs(F.element_at(pa, 1), sb) | _point_in_segs(F.element_at(pb, 1), sa))
    return F.when(touching, F.lit(0.0)).otherwise(d)


# ---------------------------------------------------------------- projection

# Spherical Lambert conformal conic of the forecast grid.
LCC_FORECAST = dict(lon0=262.5, lat0=38.5, lat1=38.5, lat2=38.5, radius=6371229.0)


def lcc_xy(lon: Column, lat: Column, lon0: float, lat0: float, lat1: float, lat2: float, radius: float):
    """Closed-form spherical Lambert conformal conic (Snyder 1987, eqs. 15-1..15-3, 14-4)."""
    r = math.radians
    p1, p2, p0 = r(lat1), r(lat2), r(lat0)
    if abs(lat1 - lat2) < 1e-12:
        n = math.sin(p1)
    else:
        n = math.log(math.cos(p1) / math.cos(p2)) / math.log(
            math.tan(math.pi / 4 + p2 / 2) / math.tan(math.pi / 4 + p1 / 2))
    f = math.cos(p1) * math.tan(math.pi / 4 + p1 / 2) ** n / n
    rho0 = radius * f / math.tan(math.pi / 4 + p0 / 2) ** n
    dlon = lon - F.lit(lon0)
    # wrap the longitude difference into [-180, 180)
    dlon = F.pmod(dlon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
    theta = F.lit(n) * F.radians(dlon)
    rho = F.lit(radius * f) / F.pow(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2), F.lit(n))
    return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)


def project_rings(rings: Column, lon0: float, lat0: float, lat1: float, lat2: float, radius: float) -> Column:
    """Reproject every vertex of lon/lat rings with :func:`lcc_xy`."""
    def pt(p: Column) -> Column:
        x, y = lcc_xy(p["x"], p["y"], lon0, lat0, lat1, lat2, radius)
        return _pt(x, y)
    return F.transform(rings, lambda r: F.struct(r["part"].alias("part"), r["hole"].alias("hole"),
                                                 F.transform(r["pts"], pt).alias("pts")))


def reproject(df, target, rings_col: str = "rings", source: str = "EPSG:4326"):
    """Reproject rings from ``source`` to ``target`` (see :mod:`projections`); the same system is the identity."""
    return to_system(df, target, rings_col, override=source)


def set_crs(df, crs: str):
    """Relabel the coordinate system without moving any vertex."""
    return df.withColumn("crs", F.lit(crs))
