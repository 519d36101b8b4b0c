"""Metres on the WGS84 spheroid and closed-form reprojection, as column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from velomesh.functions import geometry as g

# WGS84 and the universal transverse Mercator grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
ECC2 = FLATTENING * (2 - FLATTENING)
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
ZONE_31_MERIDIAN = 3.0
# Degrees up to which the flat formula serves, and the latitude from which it does not.
SHORT, POLAR = 0.2, 80.0


def radii(lat_deg: Column) -> tuple[Column, Column]:
    """Metres per radian along the meridian and along the parallel at a latitude."""
    phi = F.radians(lat_deg)
    w = 1 - ECC2 * F.pow(F.sin(phi), F.lit(2.0))
    meridian = SEMI_MAJOR * (1 - ECC2) / (w * F.sqrt(w))
    parallel = SEMI_MAJOR / F.sqrt(w) * F.cos(phi)
    return meridian, parallel


def long_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Spheroid distance by Lambert's formula: within about ten metres over thousands of kilometres.

    The angle between the points on the auxiliary sphere, corrected to first order in the flattening.
    """
    u, v = (F.atan((1 - FLATTENING) * F.tan(F.radians(lat))) for lat in (ay, by))
    turn = F.radians(bx - ax)
    half = F.pow(F.sin((v - u) / 2), F.lit(2.0)) + F.cos(u) * F.cos(v) * F.pow(F.sin(turn / 2), F.lit(2.0))
    half = F.least(F.lit(1.0), half)
    angle = 2 * F.asin(F.sqrt(half))
    mean, gap = F.pow(F.sin((u + v) / 2), F.lit(2.0)), F.pow(F.sin((v - u) / 2), F.lit(2.0))
    x = (angle - F.sin(angle)) * F.try_divide(mean * (1 - gap), 1 - half)
    y = (angle + F.sin(angle)) * F.try_divide((1 - mean) * gap, half)
    return SEMI_MAJOR * (angle - FLATTENING / 2 * (F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0))))


def near_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Mid-latitude spheroid distance; relative error below 2e-7 up to about 11 km, away from the poles."""
    meridian, parallel = radii((ay + by) / 2)
    return F.hypot(parallel * F.radians(bx - ax), meridian * F.radians(by - ay))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Spheroid distance. Up to ``SHORT`` degrees the mid-latitude formula, whose relative error stays below
    1e-6 there away from the poles; beyond, and near the poles, Lambert's formula."""
    short = (F.abs(bx - ax) <= SHORT) & (F.abs(by - ay) <= SHORT) & (F.greatest(F.abs(ay), F.abs(by)) < POLAR)
    return F.when(short, near_distance(ax, ay, bx, by)).otherwise(long_distance(ax, ay, bx, by))


def point_distance(p: Column, q: Column) -> Column:
    return distance(p["x"], p["y"], q["x"], q["y"])


def edge_length(e: Column) -> Column:
    return distance(e["ax"], e["ay"], e["bx"], e["by"])


def line_length_m(line: Column) -> Column:
    return F.aggregate(g.line_edges(line), F.lit(0.0), lambda acc, e: acc + edge_length(e))


def point_edge_distance(x: Column, y: Column, e: Column) -> Column:
    """Metres from a point to an edge within a few kilometres: foot point on the local tangent plane, then the flat formula."""
    meridian, parallel = radii(y)
    dx, dy = (e["bx"] - e["ax"]) * parallel, (e["by"] - e["ay"]) * meridian
    along = (x - e["ax"]) * parallel * dx + (y - e["ay"]) * meridian * dy
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(
        F.try_divide(along, dx * dx + dy * dy), F.lit(0.0))))
    return near_distance(x, y, e["ax"] + t * (e["bx"] - e["ax"]), e["ay"] + t * (e["by"] - e["ay"]))


def degree_floor_m(lat: Column, reach_deg: float) -> Column:
    """Fewest metres one coordinate degree can span within ``reach_deg`` of a latitude."""
    widest = F.least(F.abs(lat) + reach_deg, F.lit(90.0))
    meridian, _ = radii(F.greatest(F.abs(lat) - reach_deg, F.lit(0.0)))
    _, parallel = radii(widest)
    return F.least(meridian, parallel) * math.radians(1.0)


def degree_floors_m(lat: Column, reach_deg: float) -> tuple[Column, Column]:
    """Fewest metres a degree of longitude, and one of latitude, can span within ``reach_deg`` of a latitude."""
    meridian, _ = radii(F.greatest(F.abs(lat) - reach_deg, F.lit(0.0)))
    _, parallel = radii(F.least(F.abs(lat) + reach_deg, F.lit(90.0)))
    return parallel * math.radians(1.0), meridian * math.radians(1.0)


# Most metres one coordinate degree spans anywhere (the meridian at the pole, rounded up).
METRES_PER_DEGREE_CEILING = math.radians(1.0) * SEMI_MAJOR / math.sqrt(1 - ECC2)


# Series coefficients of the transverse Mercator projection in the third flattening (order 4).
_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = SEMI_MAJOR / (1 + _N) * (1 + _N ** 2 / 4 + _N ** 4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N ** 2 / 3 + 5 * _N ** 3 / 16 + 41 * _N ** 4 / 180,
    13 * _N ** 2 / 48 - 3 * _N ** 3 / 5 + 557 * _N ** 4 / 1440,
    61 * _N ** 3 / 240 - 103 * _N ** 4 / 140,
    49561 * _N ** 4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N ** 2 / 3 + 37 * _N ** 3 / 96 - _N ** 4 / 360,
    _N ** 2 / 48 + _N ** 3 / 15 - 437 * _N ** 4 / 1440,
    17 * _N ** 3 / 480 - 37 * _N ** 4 / 840,
    4397 * _N ** 4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N ** 2 / 3 - 2 * _N ** 3 + 116 * _N ** 4 / 45,
    7 * _N ** 2 / 3 - 8 * _N ** 3 / 5 - 227 * _N ** 4 / 45,
    56 * _N ** 3 / 15 - 136 * _N ** 4 / 35,
    4279 * _N ** 4 / 630,
)


def utm_from_lonlat(p: Column, central_meridian: float = ZONE_31_MERIDIAN) -> Column:
    """Longitude/latitude to northern-hemisphere UTM metres."""
    e = math.sqrt(ECC2)
    scale = UTM_SCALE * _RECTIFYING

    def conformal(sin_lat):
        return F.sinh(F.atanh(sin_lat) - e * F.atanh(e * sin_lat))

    def sphere(q):
        return F.struct(F.atan2(q["t"], F.cos(q["lam"])).alias("xi"),
                        F.atanh(F.sin(q["lam"]) / F.sqrt(1 + q["t"] * q["t"])).alias("eta"))

    def series(q):
        north, east = q["xi"], q["eta"]
        for k, a in enumerate(_ALPHA, start=1):
            north = north + a * F.sin(2 * k * q["xi"]) * F.cosh(2 * k * q["eta"])
            east = east + a * F.cos(2 * k * q["xi"]) * F.sinh(2 * k * q["eta"])
        return g.point(UTM_FALSE_EASTING + scale * east, scale * north)

    start = F.struct(g.bind(F.sin(F.radians(p["y"])), conformal).alias("t"),
                     F.radians(p["x"] - central_meridian).alias("lam"))
    return g.bind(g.bind(start, sphere), series)


def lonlat_from_utm(p: Column, central_meridian: float = ZONE_31_MERIDIAN) -> Column:
    scale = UTM_SCALE * _RECTIFYING

    def sphere(q):
        xi, eta = q["xi"], q["eta"]
        for k, b in enumerate(_BETA, start=1):
            xi = xi - b * F.sin(2 * k * q["xi"]) * F.cosh(2 * k * q["eta"])
            eta = eta - b * F.cos(2 * k * q["xi"]) * F.sinh(2 * k * q["eta"])
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def angles(q):
        return F.struct(F.asin(F.sin(q["xi"]) / F.cosh(q["eta"])).alias("chi"),
                        F.atan2(F.sinh(q["eta"]), F.cos(q["xi"])).alias("lon"))

    def latitude(q):
        lat = q["chi"]
        for k, d in enumerate(_DELTA, start=1):
            lat = lat + d * F.sin(2 * k * q["chi"])
        return g.point(F.degrees(q["lon"]) + central_meridian, F.degrees(lat))

    start = F.struct((p["y"] / scale).alias("xi"), ((p["x"] - UTM_FALSE_EASTING) / scale).alias("eta"))
    return g.bind(g.bind(g.bind(start, sphere), angles), latitude)


def web_mercator_from_lonlat(p: Column) -> Column:
    y = F.log(F.tan(math.pi / 4 + F.radians(p["y"]) / 2))
    return g.point(SEMI_MAJOR * F.radians(p["x"]), SEMI_MAJOR * y)


def lonlat_from_web_mercator(p: Column) -> Column:
    lat = 2 * F.atan(F.exp(p["y"] / SEMI_MAJOR)) - math.pi / 2
    return g.point(F.degrees(p["x"] / SEMI_MAJOR), F.degrees(lat))


# Coordinate systems the layers come in (ETRS89 and WGS84 UTM 31N agree to the
# centimetre and share one formula).
WGS84, WEB_MERCATOR, UTM31_WGS84, UTM31_ETRS89 = 4326, 3857, 32631, 25831
_INTO = {UTM31_WGS84: utm_from_lonlat, UTM31_ETRS89: utm_from_lonlat,
         WEB_MERCATOR: web_mercator_from_lonlat}
_OUT_OF = {UTM31_WGS84: lonlat_from_utm, UTM31_ETRS89: lonlat_from_utm,
           WEB_MERCATOR: lonlat_from_web_mercator}


def reproject(p: Column, source: int, target: int) -> Column:
    if source == target:
        return p
    lonlat = p if source == WGS84 else _OUT_OF[source](p)
    return lonlat if target == WGS84 else _INTO[target](lonlat)


def reproject_line(line: Column, source: int, target: int) -> Column:
    return line if source == target else F.transform(line, lambda p: reproject(p, source, target))


def reproject_polygon(polygon: Column, source: int, target: int) -> Column:
    if source == target:
        return polygon
    return F.transform(polygon, lambda ring: reproject_line(ring, source, target))


def utm_line(line: Column) -> Column:
    return reproject_line(line, WGS84, UTM31_WGS84)


def flat_sinuosity(flat: Column) -> Column:
    """Length over straight distance of a projected line; 1 for closed or single-vertex lines."""
    a, b = g.start_point(flat), g.end_point(flat)
    straight = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
    return F.when(F.size(flat) < 2, F.lit(1.0)).otherwise(
        F.coalesce(F.try_divide(g.line_length(flat), straight), F.lit(1.0)))


def sinuosity(line: Column) -> Column:
    return g.bind(utm_line(line), flat_sinuosity)


# Fixed value: the reference point distances to the centre are taken from.
CITY_CENTRE = (2.17, 41.387)


def flat_distance_to_centre(flat: Column, centre: tuple[float, float] = CITY_CENTRE) -> Column:
    """Metres from the centroid of a projected line to a fixed centre."""
    ends = F.struct(g.line_centroid(flat).alias("c"),
                    utm_from_lonlat(g.point(F.lit(centre[0]), F.lit(centre[1]))).alias("q"))
    return g.bind(ends, lambda s: F.hypot(s["c"]["x"] - s["q"]["x"], s["c"]["y"] - s["q"]["y"]))


def distance_to_centre(line: Column, centre: tuple[float, float] = CITY_CENTRE) -> Column:
    return g.bind(utm_line(line), lambda flat: flat_distance_to_centre(flat, centre))
