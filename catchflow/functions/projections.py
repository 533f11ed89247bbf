"""Map projections as column expressions (G3, G4): geographic, Albers equal area, Lambert conformal conic.

Formulas follow Snyder, "Map Projections: A Working Manual" (1987): Albers 14-1 to 14-21 with the authalic latitude
series 3-18 and one step of 3-16 (the series alone is off by a millimetre), Lambert 15-1 to 15-11 with the conformal
latitude series 3-5. An eccentricity of 0 gives the sphere. A
point goes from its system to longitude and latitude and on to the other system; both are degrees on their own
ellipsoid, without a datum shift (NAD83 and WGS84 count as one, as is usual for maps at this scale).

Rings move vertex by vertex in stages (a ``transform`` for each), so every intermediate figure is a lambda variable that
is computed once; there is no UDF. Systems are found by name, or built from the WKT that a container carries.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ellipsoid:
    a: float
    e2: float

    @property
    def e(self) -> float:
        return math.sqrt(self.e2)


def flattened(a: float, inverse_flattening: float) -> Ellipsoid:
    f = 1 / inverse_flattening if inverse_flattening else 0.0
    return Ellipsoid(a, f * (2 - f))


# The ellipsoids and systems of the public registries.
GRS80 = flattened(6378137.0, 298.257222101)
WGS84 = flattened(6378137.0, 298.257223563)


@dataclass(frozen=True)
class System:
    """A coordinate system. ``kind``: geographic (degrees), albers or lambert (metres); angles in degrees."""
    kind: str
    ellipsoid: Ellipsoid = WGS84
    lon0: float = 0.0
    lat0: float = 0.0
    lat1: float = 0.0
    lat2: float = 0.0
    x0: float = 0.0
    y0: float = 0.0


# Fixed values.
SYSTEMS = {
    "EPSG:4326": System("geographic", WGS84),
    "EPSG:4269": System("geographic", GRS80),
    "OGC:CRS84": System("geographic", WGS84),
    "EPSG:5070": System("albers", GRS80, lon0=-96.0, lat0=23.0, lat1=29.5, lat2=45.5),
    "EPSG:3338": System("albers", GRS80, lon0=-154.0, lat0=50.0, lat1=55.0, lat2=65.0),
    "EPSG:3347": System("lambert", GRS80, lon0=-91.866666666666667, lat0=63.390675, lat1=49.0, lat2=77.0, x0=6200000.0, y0=3000000.0),
    "lcc_forecast": System("lambert", Ellipsoid(6371229.0, 0.0), lon0=262.5, lat0=38.5, lat1=38.5, lat2=38.5),
}


def system(name: str | System, wkt: str | None = None) -> System:
    """A system by name, else from its WKT; an unknown one is an error that names it."""
    if isinstance(name, System):
        return name
    if name in SYSTEMS:
        return SYSTEMS[name]
    if wkt:
        return from_wkt(wkt)
    raise ValueError(f"unknown coordinate system {name!r}")


def from_wkt(wkt: str) -> System:
    """WKT 1 of a geographic, Albers or two-parallel Lambert system in degrees and metres."""
    ball = re.search(r'SPHEROID\s*\[\s*"[^"]*"\s*,\s*([-\d.eE+]+)\s*,\s*([-\d.eE+]+)', wkt)
    if not ball:
        raise ValueError(f"no ellipsoid in the system's definition: {wkt[:80]!r}")
    ellipsoid = flattened(float(ball[1]), float(ball[2]))
    how = re.search(r'PROJECTION\s*\[\s*"([^"]*)"', wkt)
    if not how:
        return System("geographic", ellipsoid)
    given = {k.lower(): float(v) for k, v in re.findall(r'PARAMETER\s*\[\s*"([^"]*)"\s*,\s*([-\d.eE+]+)', wkt)}
    kinds = {"albers_conic_equal_area": "albers", "albers": "albers", "lambert_conformal_conic_2sp": "lambert", "lambert_conformal_conic": "lambert",
             "lambert_conformal_conic_1sp": "lambert"}
    kind = kinds.get(how[1].lower())
    if kind is None:
        raise ValueError(f"unknown projection {how[1]!r}")

    def first(*names: str) -> float:
        return next((given[n] for n in names if n in given), 0.0)
    lat0 = first("latitude_of_center", "latitude_of_origin")
    lat1 = given.get("standard_parallel_1", lat0)
    return System(kind, ellipsoid, first("longitude_of_center", "central_meridian"), lat0, lat1, given.get("standard_parallel_2", lat1),
                  first("false_easting"), first("false_northing"))


# ---------------------------------------------------------------- constants of a system (plain numbers)

def _m(s: System, phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - s.ellipsoid.e2 * math.sin(phi) ** 2)


def _q(s: System, phi: float) -> float:
    e, sin = s.ellipsoid.e, math.sin(phi)
    if e == 0:
        return 2 * sin
    return (1 - e * e) * (sin / (1 - e * e * sin * sin) - math.log((1 - e * sin) / (1 + e * sin)) / (2 * e))


def _t(s: System, phi: float) -> float:
    e, sin = s.ellipsoid.e, math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - e * sin) / (1 + e * sin)) ** (e / 2)


def _cone(s: System) -> tuple[float, float, float]:
    """(n, C or F, rho0) of a conic system."""
    p0, p1, p2 = (math.radians(v) for v in (s.lat0, s.lat1, s.lat2))
    m1, m2 = _m(s, p1), _m(s, p2)
    if s.kind == "albers":
        n = math.sin(p1) if abs(p1 - p2) < 1e-12 else (m1 ** 2 - m2 ** 2) / (_q(s, p2) - _q(s, p1))
        c = m1 ** 2 + n * _q(s, p1)
        return n, c, s.ellipsoid.a * math.sqrt(c - n * _q(s, p0)) / n
    n = math.sin(p1) if abs(p1 - p2) < 1e-12 else math.log(m1 / m2) / math.log(_t(s, p1) / _t(s, p2))
    f = m1 / (n * _t(s, p1) ** n)
    return n, f, s.ellipsoid.a * f * _t(s, p0) ** n


# ---------------------------------------------------------------- stages: struct -> struct

def _lit(v: float) -> Column:
    return F.lit(float(v))


def _forward(s: System) -> list:
    """Stages from struct(x=longitude, y=latitude) in degrees to the system's struct(x, y)."""
    if s.kind == "geographic":
        return []
    n, k, rho0 = _cone(s)
    e, a = s.ellipsoid.e, s.ellipsoid.a

    def polar(p: Column) -> Column:
        turn = F.pmod(p["x"] - _lit(s.lon0) + _lit(180.0), _lit(360.0)) - _lit(180.0)  # within [-180, 180)
        return F.struct((_lit(n) * F.radians(turn)).alias("theta"), F.sin(F.radians(p["y"])).alias("sin"), F.radians(p["y"]).alias("phi"))

    def radius(p: Column) -> Column:
        sin = p["sin"]
        if s.kind == "albers":
            q = 2 * sin if e == 0 else _lit(1 - e * e) * (sin / (1 - _lit(e * e) * sin * sin) - F.ln((1 - _lit(e) * sin) / (1 + _lit(e) * sin)) / _lit(2 * e))
            rho = _lit(a) * F.sqrt(_lit(k) - _lit(n) * q) / _lit(n)
        else:
            t = F.tan(_lit(math.pi / 4) - p["phi"] / 2) / F.pow((1 - _lit(e) * sin) / (1 + _lit(e) * sin), _lit(e / 2))
            rho = _lit(a * k) * F.pow(t, _lit(n))
        return F.struct(rho.alias("rho"), p["theta"].alias("theta"))

    def place(p: Column) -> Column:
        return F.struct((p["rho"] * F.sin(p["theta"]) + _lit(s.x0)).alias("x"), (_lit(rho0 + s.y0) - p["rho"] * F.cos(p["theta"])).alias("y"))
    return [polar, radius, place]


def _inverse(s: System) -> list:
    """Stages from the system's struct(x, y) to struct(x=longitude, y=latitude) in degrees."""
    if s.kind == "geographic":
        return []
    n, k, rho0 = _cone(s)
    e2, a = s.ellipsoid.e2, s.ellipsoid.a
    sign = 1.0 if n > 0 else -1.0

    def polar(p: Column) -> Column:
        dx, dy = (p["x"] - _lit(s.x0)) * _lit(sign), (_lit(rho0 + s.y0) - p["y"]) * _lit(sign)
        return F.struct(F.sqrt(dx * dx + dy * dy).alias("rho"), F.atan2(dx, dy).alias("theta"))

    def auxiliary(p: Column) -> Column:
        if s.kind == "albers":
            ratio = p["rho"] * _lit(n / a)
            q = (_lit(k) - ratio * ratio) / _lit(n)
            part = F.asin(F.greatest(_lit(-1.0), F.least(_lit(1.0), q / _lit(_q(s, math.pi / 2)))))
        else:
            q = _lit(0.0)
            part = _lit(math.pi / 2) - 2 * F.atan(F.pow(p["rho"] / _lit(sign * a * k), _lit(1 / n)))
        return F.struct(part.alias("part"), q.alias("q"), p["theta"].alias("theta"))

    e4, e6, e8 = e2 ** 2, e2 ** 3, e2 ** 4
    if s.kind == "albers":  # from the authalic latitude
        series = [e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040, 23 * e4 / 360 + 251 * e6 / 3780, 761 * e6 / 45360]
    else:  # from the conformal latitude
        series = [e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360, 7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520, 7 * e6 / 120 + 81 * e8 / 1120, 4279 * e8 / 161280]

    def latitude(p: Column) -> Column:
        phi = p["part"]
        for i, c in enumerate(series):
            if c:
                phi = phi + _lit(c) * F.sin(p["part"] * (2 * i + 2))
        return F.struct(phi.alias("phi"), F.sin(phi).alias("sin"), p["q"].alias("q"), p["theta"].alias("theta"))

    def closer(p: Column) -> Column:
        e, sin = math.sqrt(e2), p["sin"]
        one = 1 - _lit(e2) * sin * sin
        left = p["q"] / _lit(1 - e2) - sin / one + F.ln((1 - _lit(e) * sin) / (1 + _lit(e) * sin)) / _lit(2 * e)
        step = F.when(F.abs(sin) < 0.999999, one * one / (2 * F.cos(p["phi"])) * left).otherwise(_lit(0.0))
        return F.struct((p["phi"] + step).alias("phi"), p["theta"].alias("theta"))

    def place(p: Column) -> Column:
        lon = _lit(s.lon0) + F.degrees(p["theta"] / _lit(n))
        lon = F.pmod(lon + _lit(180.0), _lit(360.0)) - _lit(180.0)
        return F.struct(lon.alias("x"), F.degrees(p["phi"]).alias("y"))
    return [polar, auxiliary, latitude, *([closer] if s.kind == "albers" and e2 else []), place]


def stages(source: System, target: System) -> list:
    return [] if source == target else _inverse(source) + _forward(target)


# ---------------------------------------------------------------- points, rings, tables

def move_point(x: Column, y: Column, source: str | System, target: str | System) -> Column:
    """struct(x, y) of a point of ``source`` in ``target``."""
    one = F.array(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    for stage in stages(system(source), system(target)):
        one = F.transform(one, stage)
    return F.element_at(one, 1)


def move_rings(rings: Column, source: str | System, target: str | System, wkt: str | None = None) -> Column:
    """Rings of ``source`` in ``target``, vertex by vertex; equal systems leave them untouched."""
    steps = stages(system(source, wkt), system(target))
    if not steps:
        return rings

    def moved(ring: Column) -> Column:
        pts = ring["pts"]
        for stage in steps:
            pts = F.transform(pts, stage)
        return F.struct(ring["part"].alias("part"), ring["hole"].alias("hole"), pts.alias("pts"))
    return F.transform(rings, moved)


def to_system(df: DataFrame, target: str | System, rings_col: str = "rings", crs_col: str = "crs", wkt_col: str | None = None,
              override: str | None = None) -> DataFrame:
    """Every row's rings from its own system (``crs_col``) to ``target``.

    ``override`` is the system of all rows, whatever they say. The distinct systems (a handful) are read once; a row
    without one, and a system that is neither known nor defined by its WKT, are errors.
    """
    name = target if isinstance(target, str) else "custom"
    if override is not None:
        return df.withColumn(rings_col, move_rings(F.col(rings_col), override, target)).withColumn(crs_col, F.lit(name))
    wkt = F.col(wkt_col) if wkt_col else F.lit(None).cast("string")
    shaped = F.coalesce(F.size(rings_col), F.lit(0)) > 0  # what has no shape needs no system
    found = df.where(shaped).groupBy(F.col(crs_col).alias("crs")).agg(F.max(wkt).alias("wkt")).collect()
    out = F.col(rings_col)
    for r in found:
        if r["crs"] is None:
            raise ValueError("features without a coordinate system: name one")
        out = F.when(F.col(crs_col) == r["crs"], move_rings(F.col(rings_col), r["crs"], target, r["wkt"])).otherwise(out)
    return df.withColumn(rings_col, out).withColumn(crs_col, F.lit(name))
