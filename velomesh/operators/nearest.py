"""Nearest line for each (point, group) without comparing every point with every line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomesh.functions import geodesy, geometry as g
from velomesh.operators import grid
from velomesh.operators.skew import spread_join, unbroadcast
from velomesh.operators.spatial import line_shapes
from velomesh.session import checkpointed

# A cell with more edge pieces than this is cut into FAN x FAN cells, down to DEEPEST levels below the radius.
LEAF, FAN, DEEPEST = 128, 4, 8
# By how much the metres to an edge's foot point may exceed those to another spot on it.
SLACK = 1.0001


def nearest_line(points: DataFrame, lines: DataFrame, point_id: str, by: str, line_id: str,
                 radius_deg: float = 0.1, order: str = "geodesic",
                 point: str = "geometry", geom: str = "geometry") -> DataFrame:
    """(point_id, by, line_id, metres): nearest line of the point's own ``by`` group.

    Only lines within ``radius_deg`` planar degrees count; without any, line_id and metres are NULL.
    ``order`` picks the winner by spheroid metres or by planar degrees (``"planar"``); metres are
    those of the winner either way. ``points`` has one row per (point_id, by).

    Lines lie in a pyramid of cells, cut finer only where they are dense. Every point starts at the
    cells of one radius around it and goes down level by level. Each cell names one spot on a line,
    so the nearest spot bounds the distance; a cell that cannot beat the bound is not opened. A point
    thus meets a few cells of few edges, however crowded its surroundings are.
    """
    if order not in ("geodesic", "planar"):
        raise ValueError(f"unknown order {order!r}")
    shapes = checkpointed(line_shapes(lines, [by], line_id, geom))
    nodes, leaves = pyramid(grid.explode_edges(shapes, "geometry", [by, "shape_id"]), by, radius_deg)
    start = points.select(point_id, by, F.col(f"{point}.x").alias("px"), F.col(f"{point}.y").alias("py"))
    cells = _leaves_in_reach(start, nodes, point_id, by, radius_deg, order)
    px, py = F.col("px"), F.col("py")
    met = spread_join(cells, leaves, [by, "level", "cx", "cy"], [point_id])
    per_line = met.groupBy(point_id, by, "shape_id").agg(
        F.min(g.planar_point_edge(px, py, F.col("edge"))).alias("flat"),
        F.min(geodesy.point_edge_distance(px, py, F.col("edge"))).alias("m"))
    # A line counts with all its edges: the winners' metres, and whether one near in metres is within the radius, are
    # settled on the whole line. Edges left in closed cells could not win themselves.
    near, mine = F.col("flat") <= radius_deg, Window.partitionBy(point_id, by)
    first = "m" if order == "geodesic" else "flat"
    tied = (per_line.withColumn("_least", F.min(F.when(near, F.col(first))).over(mine)).where(F.col(first) <= F.col("_least"))
            .join(unbroadcast(start), [point_id, by])
            .join(unbroadcast(shapes.select(by, "shape_id", g.line_edges(F.col("geometry")).alias("edges"))), [by, "shape_id"]))
    rest, measure = ("flat", g.planar_point_edge) if order == "geodesic" else ("m", geodesy.point_edge_distance)
    best = (tied.withColumn(rest, F.array_min(F.transform("edges", lambda e: measure(px, py, e)))).where(near)
            .groupBy(point_id, by).agg(F.min(F.struct(first, rest, "shape_id")).alias("best")))
    return start.join(unbroadcast(best), [point_id, by], "left").select(
        point_id, by, F.col("best.shape_id").alias(line_id), F.col("best.m").alias("metres"))


def _pieces(edges: DataFrame, by: str, size: float, inside: bool) -> DataFrame:
    """Each edge's pieces in cells of a width: (by, shape_id, edge, piece, cx, cy), kept ``inside`` the cell they came from."""
    piece = F.col("piece")
    cut = edges.select("*", F.explode(grid.edge_pieces(piece, size)).alias("part"))

    def at(t: Column, axis: str) -> Column:
        return piece[f"a{axis}"] + t * (piece[f"b{axis}"] - piece[f"a{axis}"])

    def cell(c: str) -> Column:
        # rounding at a border never moves a piece out of the cell above
        low = F.col(c) * FAN
        return F.greatest(low, F.least(F.col(f"part.{c}"), low + (FAN - 1))) if inside else F.col(f"part.{c}")
    t0, t1 = F.col("part.t0"), F.col("part.t1")
    return cut.select(by, "shape_id", "edge", F.struct(
        at(t0, "x").alias("ax"), at(t0, "y").alias("ay"), at(t1, "x").alias("bx"), at(t1, "y").alias("by")).alias("piece"),
        cell("cx").alias("cx"), cell("cy").alias("cy"))


def pyramid(edges: DataFrame, by: str, top: float) -> tuple[DataFrame, DataFrame]:
    """Nodes (by, level, cx, cy, is_leaf, spot) and the edges of leaves (by, level, cx, cy, shape_id, edge).

    Level 0 has cells as wide as ``top``, each level below is ``FAN`` times finer. Only cells of more than ``LEAF`` pieces go
    on; an edge goes on by its piece in the cell, so a long one is never cut twice at one place.
    """
    key = [by, "cx", "cy"]
    here = _pieces(edges.select(by, "shape_id", "edge", F.col("edge").alias("piece")), by, top, False)
    nodes = leaves = None
    for level in range(DEEPEST + 1):
        here = checkpointed(here)
        piece = F.col("piece")
        spot = F.struct(((piece["ax"] + piece["bx"]) / 2).alias("x"), ((piece["ay"] + piece["by"]) / 2).alias("y"))
        found = here.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(spot).alias("spot"))
        is_leaf = (F.col("n") <= LEAF) | F.lit(level == DEEPEST)
        found = checkpointed(found.select(by, F.lit(level).alias("level"), "cx", "cy", is_leaf.alias("is_leaf"), "spot"))
        nodes = found if nodes is None else nodes.unionByName(found)
        ends = here.join(unbroadcast(found.where("is_leaf").select(*key)), key, "left_semi")
        ends = ends.select(by, F.lit(level).alias("level"), "cx", "cy", "shape_id", "edge").distinct()
        leaves = ends if leaves is None else leaves.unionByName(ends)
        more = found.where("not is_leaf")
        if more.isEmpty():
            break
        here = _pieces(here.join(unbroadcast(more.select(*key)), key, "left_semi"), by, top / FAN ** (level + 1), True)
    return nodes, leaves


def _leaves_in_reach(points: DataFrame, nodes: DataFrame, point_id: str, by: str, radius_deg: float,
                     order: str = "geodesic") -> DataFrame:
    """(point_id, by, px, py, level, cx, cy): the leaves that can hold a point's nearest line in the given order."""
    px, py = F.col("px"), F.col("py")
    mine = Window.partitionBy(point_id, by)
    # Degrees of longitude and latitude weigh what they span here at the least; in planar order they weigh the same.
    wide, high = geodesy.degree_floors_m(py, 2 * radius_deg) if order == "geodesic" else (F.lit(1.0), F.lit(1.0))
    slack, pad = (SLACK, 1e-3) if order == "geodesic" else (1.0, grid.COVER_PAD)
    reached = (F.col("flat") <= radius_deg + grid.COVER_PAD) & (F.col("low") <= F.col("bound") * slack + pad)
    key = [by, "cx", "cy"]
    around = F.explode(grid.box_cells(px - radius_deg, py - radius_deg, px + radius_deg, py + radius_deg, radius_deg)).alias("c")
    asking = points.select("*", F.lit(float("inf")).alias("bound"), around).select(
        point_id, by, "px", "py", "bound", "c.cx", "c.cy")
    out = None
    for level in range(nodes.agg(F.coalesce(F.max("level"), F.lit(0))).first()[0] + 1):
        size = radius_deg / FAN ** level

        def outside(p: Column, cell: str) -> Column:
            return F.greatest(F.col(cell) * size - p, p - (F.col(cell) + 1) * size, F.lit(0.0))
        # a node is one row: Spark can split the points of a hot cell without copying anything
        met = asking.join(unbroadcast(nodes.where(F.col("level") == level)), key)
        ox, oy, sx, sy = outside(px, "cx"), outside(py, "cy"), F.col("spot.x"), F.col("spot.y")
        away = F.hypot(px - sx, py - sy)
        known = geodesy.near_distance(px, py, sx, sy) if order == "geodesic" else away
        # what lies beyond the radius bounds nothing
        met = met.select(point_id, by, "px", "py", "level", "cx", "cy", "is_leaf", F.hypot(ox, oy).alias("flat"),
                         F.hypot(ox * wide, oy * high).alias("low"),
                         F.least("bound", F.when(away <= radius_deg, known)).alias("bound")).where(
                             F.col("flat") <= radius_deg + grid.COVER_PAD)
        # one window row per cell still in reach
        met = met.withColumn("bound", F.min("bound").over(mine))
        met = checkpointed(met.where(reached))
        ends = met.where("is_leaf").drop("is_leaf")
        out = ends if out is None else out.unionByName(ends)
        step = F.explode(F.sequence(F.lit(0), F.lit(FAN * FAN - 1))).alias("step")
        asking = met.where("not is_leaf").select(point_id, by, "px", "py", "bound", "cx", "cy", step).select(
            point_id, by, "px", "py", "bound", (F.col("cx") * FAN + F.col("step") % FAN).alias("cx"),
            (F.col("cy") * FAN + F.floor(F.col("step") / FAN)).cast("long").alias("cy"))
    return out.withColumn("bound", F.min("bound").over(mine)).where(reached).drop("flat", "low", "bound")
