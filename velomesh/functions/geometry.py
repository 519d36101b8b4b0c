"""Planar geometry on native columns.

point    struct<x: double, y: double>            x = longitude, y = latitude
line     array<point>
polygon  array<array<point>>                     ring 0 = shell, others = holes, rings closed
edge     struct<ax, ay, bx, by>                  one straight piece of a line or ring

Predicates use the sign of one shared orientation product, without a tolerance, so two callers
never disagree about the same triple of points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Degrees; about a micrometre. Only used to call the midpoint of a clipped piece "on the border".
BORDER_TOLERANCE = 1e-11


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, however often that refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def make_line(*points: Column) -> Column:
    return F.array(*points)


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    ring = F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax),
                   point(xmin, ymax), point(xmin, ymin))
    return F.array(ring)


def edge(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.struct(ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"))


def line_edges(line: Column) -> Column:
    n = F.greatest(F.size(line) - 1, F.lit(0))
    return F.zip_with(F.slice(line, F.lit(1), n), F.slice(line, F.lit(2), n),
                      lambda p, q: edge(p["x"], p["y"], q["x"], q["y"]))


def polygon_edges(polygon: Column) -> Column:
    return F.flatten(F.transform(polygon, line_edges))


def start_point(line: Column) -> Column:
    return F.get(line, F.lit(0))


def end_point(line: Column) -> Column:
    return F.get(line, F.size(line) - 1)


def vertex_count(line: Column) -> Column:
    return F.size(line)


def line_bounds(line: Column) -> Column:
    """struct<xmin, ymin, xmax, ymax> of a line or ring."""
    # Reading a field of an array of structs gives the array of that field.
    xs, ys = line["x"], line["y"]
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def polygon_bounds(polygon: Column) -> Column:
    return line_bounds(F.flatten(polygon))


def straightened(line: Column) -> Column:
    """The line without the vertices that lie on the straight way between their neighbours."""
    def turns(p: Column, i: Column) -> Column:
        a, b = F.get(line, i - 1), F.get(line, i + 1)
        ux, uy, vx, vy = p["x"] - a["x"], p["y"] - a["y"], b["x"] - p["x"], b["y"] - p["y"]
        ahead = ux * vx + uy * vy
        return F.coalesce((F.abs(ux * vy - uy * vx) > 1e-9 * F.abs(ahead)) | (ahead < 0), F.lit(True))
    return F.filter(line, turns)


def canonical_line(line: Column) -> Column:
    """Same value for a line, its reverse, and the line with further vertices on its straight pieces."""
    plain = straightened(line)
    return F.least(plain, F.reverse(plain))


def same_line(a: Column, b: Column) -> Column:
    return canonical_line(a) == canonical_line(b)


def orientation(ax, ay, bx, by, cx, cy) -> Column:
    """Positive when a→b→c turns left, zero when the three points are in line."""
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def edges_meet(e: Column, f: Column) -> Column:
    """Closed intersection of two edges; touching counts."""
    ax, ay, bx, by = (e[k] for k in ("ax", "ay", "bx", "by"))
    cx, cy, dx, dy = (f[k] for k in ("ax", "ay", "bx", "by"))
    boxes = ((F.least(ax, bx) <= F.greatest(cx, dx)) & (F.least(cx, dx) <= F.greatest(ax, bx))
             & (F.least(ay, by) <= F.greatest(cy, dy)) & (F.least(cy, dy) <= F.greatest(ay, by)))
    across_e = (F.signum(orientation(ax, ay, bx, by, cx, cy))
                * F.signum(orientation(ax, ay, bx, by, dx, dy))) <= 0
    across_f = (F.signum(orientation(cx, cy, dx, dy, ax, ay))
                * F.signum(orientation(cx, cy, dx, dy, bx, by))) <= 0
    return boxes & across_e & across_f


def edge_meets_box(e: Column, xmin, ymin, xmax, ymax) -> Column:
    """Closed intersection of an edge with an axis-aligned box."""
    ax, ay, bx, by = (e[k] for k in ("ax", "ay", "bx", "by"))
    overlap = ((F.least(ax, bx) <= xmax) & (F.greatest(ax, bx) >= xmin)
               & (F.least(ay, by) <= ymax) & (F.greatest(ay, by) >= ymin))
    corners = [orientation(ax, ay, bx, by, x, y)
               for x, y in ((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax))]
    one_side = (F.least(*corners) > 0) | (F.greatest(*corners) < 0)
    return overlap & ~one_side


def on_edge(e: Column, x: Column, y: Column, tolerance: float = 0.0) -> Column:
    ax, ay, bx, by = (e[k] for k in ("ax", "ay", "bx", "by"))
    side = F.abs(orientation(ax, ay, bx, by, x, y))
    reach = F.greatest(F.abs(bx - ax), F.abs(by - ay)) * tolerance
    return ((side <= reach)
            & (x >= F.least(ax, bx) - tolerance) & (x <= F.greatest(ax, bx) + tolerance)
            & (y >= F.least(ay, by) - tolerance) & (y <= F.greatest(ay, by) + tolerance))


def _ray_crossings(edges: Column, x: Column, y: Column) -> Column:
    def crosses(e):
        return ((e["ay"] > y) != (e["by"] > y)) & (
            x < (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"])
    return F.size(F.filter(edges, crosses))


def edges_contain(edges: Column, x: Column, y: Column) -> Column:
    """Strict interior test against all ring edges; holes fall out of the even-odd rule."""
    return ~F.exists(edges, lambda e: on_edge(e, x, y)) & (_ray_crossings(edges, x, y) % 2 == 1)


def edges_cover(edges: Column, x: Column, y: Column) -> Column:
    """Closed test: interior or border."""
    return ((_ray_crossings(edges, x, y) % 2 == 1)
            | F.exists(edges, lambda e: on_edge(e, x, y, BORDER_TOLERANCE)))


def between_crossings(edges: Column, x: Column, y: Column, mx: Column, my: Column) -> Column:
    """Edges passed on the way from (mx, my) up or down to height y and then along it to x."""
    def across(e):
        return ((e["ay"] > y) != (e["by"] > y)) & (lambda at: (x < at) != (mx < at))(
            (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"])

    def along(e):
        return ((e["ax"] > mx) != (e["bx"] > mx)) & (lambda at: (y < at) != (my < at))(
            (e["by"] - e["ay"]) * (mx - e["ax"]) / (e["bx"] - e["ax"]) + e["ay"])
    return F.size(F.filter(edges, across)) + F.size(F.filter(edges, along))


def near_edges_contain(edges: Column, x: Column, y: Column, mx: Column, my: Column, middle: Column) -> Column:
    """Strict interior test in a box, from the edges that touch the box and whether its point (mx, my) is inside."""
    odd = between_crossings(edges, x, y, mx, my) % 2 == 1
    return ~F.exists(edges, lambda e: on_edge(e, x, y)) & (odd != middle)


def near_edges_cover(edges: Column, x: Column, y: Column, mx: Column, my: Column, middle: Column) -> Column:
    """Closed test in a box: interior or border."""
    return (((between_crossings(edges, x, y, mx, my) % 2 == 1) != middle)
            | F.exists(edges, lambda e: on_edge(e, x, y, BORDER_TOLERANCE)))


def contains(polygon: Column, p: Column) -> Column:
    return edges_contain(polygon_edges(polygon), p["x"], p["y"])


def planar_point_edge(x, y, e: Column) -> Column:
    """Distance in coordinate units from a point to an edge."""
    dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
    along = (x - e["ax"]) * dx + (y - e["ay"]) * dy
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(
        F.try_divide(along, dx * dx + dy * dy), F.lit(0.0))))
    return F.sqrt(F.pow(x - (e["ax"] + t * dx), F.lit(2.0)) + F.pow(y - (e["ay"] + t * dy), F.lit(2.0)))


def line_length(line: Column) -> Column:
    """Planar length in coordinate units."""
    return F.aggregate(line_edges(line), F.lit(0.0),
                       lambda acc, e: acc + F.hypot(e["bx"] - e["ax"], e["by"] - e["ay"]))


def line_centroid(line: Column) -> Column:
    """Length-weighted centroid; a line without length falls back to its first vertex."""
    def add(acc, e):
        w = F.hypot(e["bx"] - e["ax"], e["by"] - e["ay"])
        return F.struct((acc["w"] + w).alias("w"),
                        (acc["sx"] + w * (e["ax"] + e["bx"]) / 2).alias("sx"),
                        (acc["sy"] + w * (e["ay"] + e["by"]) / 2).alias("sy"))
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))
    first = start_point(line)
    return F.aggregate(line_edges(line), zero, add, lambda a: point(
        F.coalesce(F.try_divide(a["sx"], a["w"]), first["x"]),
        F.coalesce(F.try_divide(a["sy"], a["w"]), first["y"])))


def _ring_moments(ring: Column) -> Column:
    """Twice the area and the two first moments, taken about the ring's first vertex."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def about(o):
        def add(acc, e):
            return bind(F.struct((e["ax"] - o["x"]).alias("ax"), (e["ay"] - o["y"]).alias("ay"),
                                 (e["bx"] - o["x"]).alias("bx"), (e["by"] - o["y"]).alias("by")),
                        lambda r: bind(r["ax"] * r["by"] - r["bx"] * r["ay"], lambda cross: F.struct(
                            (acc["a"] + cross).alias("a"), (acc["mx"] + (r["ax"] + r["bx"]) * cross).alias("mx"),
                            (acc["my"] + (r["ay"] + r["by"]) * cross).alias("my"))))
        # Shells and holes may be wound either way, so each ring is made positive.
        return F.aggregate(line_edges(ring), zero, add, lambda m: F.struct(
            F.abs(m["a"]).alias("a"), o["x"].alias("ox"), o["y"].alias("oy"),
            (m["mx"] * F.signum(m["a"])).alias("mx"), (m["my"] * F.signum(m["a"])).alias("my")))
    return bind(F.get(ring, F.lit(0)), about)


def _signed(i: Column, value: Column) -> Column:
    return F.when(i == 0, value).otherwise(-value)


def polygon_area(polygon: Column) -> Column:
    """Planar area in square coordinate units, holes taken off."""
    parts = F.transform(polygon, lambda ring, i: _signed(i, _ring_moments(ring)["a"] / 2))
    return F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)


def polygon_centroid(polygon: Column) -> Column:
    """Area-weighted centroid of shell minus holes."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def about(base):
        def weigh(ring, i):
            # moment about the polygon's first vertex = own moment + 3 * area2 * offset
            return bind(_ring_moments(ring), lambda m: F.struct(
                _signed(i, m["a"]).alias("a"),
                _signed(i, m["mx"] + 3 * m["a"] * (m["ox"] - base["x"])).alias("mx"),
                _signed(i, m["my"] + 3 * m["a"] * (m["oy"] - base["y"])).alias("my")))

        def add(acc, m):
            return F.struct((acc["a"] + m["a"]).alias("a"), (acc["mx"] + m["mx"]).alias("mx"),
                            (acc["my"] + m["my"]).alias("my"))
        return F.aggregate(F.transform(polygon, weigh), zero, add, lambda t: point(
            base["x"] + F.coalesce(F.try_divide(t["mx"], 3 * t["a"]), F.lit(0.0)),
            base["y"] + F.coalesce(F.try_divide(t["my"], 3 * t["a"]), F.lit(0.0))))
    return bind(F.get(F.get(polygon, F.lit(0)), F.lit(0)), about)


def bearing(line: Column) -> Column:
    """Direction from first to last vertex in coordinate degrees: 0 north, 90 east."""
    a, b = start_point(line), end_point(line)
    turn = F.degrees(F.atan2(b["x"] - a["x"], b["y"] - a["y"]))
    return F.when(F.size(line) >= 2, F.pmod(turn + 360.0, F.lit(360.0)))


# The eight sectors in clockwise order.
SECTORS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


def cardinal(bearing_deg: Column) -> Column:
    """Sector by half-even rounding of the bearing over 45 degrees."""
    step = F.bround(bearing_deg / 45.0, 0).cast("int") % len(SECTORS)
    return F.get(F.array(*[F.lit(s) for s in SECTORS]), step)
