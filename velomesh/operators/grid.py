"""Square grid cells as join keys: what a spatial index does, as columns for equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomesh.functions import geometry as g

# Default cell width in degrees, about the size of one census tract.
CELL = 0.005
# Widening of closed covers, far below a millimetre: shapes that touch on a cell border share a cell.
COVER_PAD = 1e-9
# Edges from which a cell counts as crowded.
CROWD = 2000


def cell_of(v: Column, size: float | Column, origin: float | Column = 0.0) -> Column:
    size = F.lit(size) if isinstance(size, (int, float)) else size
    origin = F.lit(origin) if isinstance(origin, (int, float)) else origin
    return F.floor((v - origin) / size).cast("long")


def with_cell(df: DataFrame, x: Column, y: Column, size: float = CELL) -> DataFrame:
    return df.withColumn("cx", cell_of(x, size)).withColumn("cy", cell_of(y, size))


def _axis_cells(low: Column, high: Column, size, origin=0.0) -> Column:
    return F.sequence(cell_of(low, size, origin), cell_of(high, size, origin))


def box_cells(xmin, ymin, xmax, ymax, size, origin_x=0.0, origin_y=0.0) -> Column:
    """All cells a closed box touches, as array<struct<cx, cy>>."""
    xs, ys = _axis_cells(xmin, xmax, size, origin_x), _axis_cells(ymin, ymax, size, origin_y)
    return F.flatten(F.transform(xs, lambda cx: F.transform(
        ys, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def with_box_cells(df: DataFrame, bounds: Column, size: float = CELL) -> DataFrame:
    cells = box_cells(bounds["xmin"], bounds["ymin"], bounds["xmax"], bounds["ymax"], size)
    return (df.withColumn("_cell", F.explode(cells))
            .withColumn("cx", F.col("_cell.cx")).withColumn("cy", F.col("_cell.cy")).drop("_cell"))


def _grid_crossings(a: Column, b: Column, size: float | Column) -> Column:
    """Parameters in (0, 1) at which a→b passes a grid line of one axis."""
    first, last = cell_of(F.least(a, b), size) + 1, cell_of(F.greatest(a, b), size)
    lines = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    at = F.transform(lines, lambda k: (k * (F.lit(size) if isinstance(size, (int, float)) else size) - a) / (b - a))
    return F.filter(at, lambda t: (t > 0) & (t < 1))


def consecutive(cuts: Column) -> Column:
    """Neighbouring parameters of a sorted array as array<struct<t0, t1>>, empty spans left out."""
    def spans(c):
        n = F.size(c) - 1
        return F.filter(F.zip_with(F.slice(c, F.lit(1), n), F.slice(c, F.lit(2), n),
                                   lambda s, t: F.struct(s.alias("t0"), t.alias("t1"))),
                        lambda s: s["t1"] > s["t0"])
    return g.bind(cuts, spans)


def edge_pieces(e: Column, size: float | Column) -> Column:
    """An edge cut at every grid line: array<struct<cx, cy, t0, t1>>, disjoint and complete."""
    ax, ay, bx, by = (e[k] for k in ("ax", "ay", "bx", "by"))
    inner = F.concat(_grid_crossings(ax, bx, size), _grid_crossings(ay, by, size))
    cuts = F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), inner))

    def place(s):
        m = (s["t0"] + s["t1"]) / 2
        return F.struct(cell_of(ax + m * (bx - ax), size).alias("cx"),
                        cell_of(ay + m * (by - ay), size).alias("cy"),
                        s["t0"].alias("t0"), s["t1"].alias("t1"))
    return F.transform(consecutive(cuts), place)


def edge_cells(e: Column, size: float | Column) -> Column:
    """Every cell a closed edge touches, slightly widened; grows with length, not with its box."""
    ax, ay, bx, by = (e[k] for k in ("ax", "ay", "bx", "by"))

    def around(p):
        x0, x1 = ax + p["t0"] * (bx - ax), ax + p["t1"] * (bx - ax)
        y0, y1 = ay + p["t0"] * (by - ay), ay + p["t1"] * (by - ay)
        return box_cells(F.least(x0, x1) - COVER_PAD, F.least(y0, y1) - COVER_PAD,
                         F.greatest(x0, x1) + COVER_PAD, F.greatest(y0, y1) + COVER_PAD, size)
    return F.array_distinct(F.flatten(F.transform(edge_pieces(e, size), around)))


def with_edge_cells(df: DataFrame, size: float, e: str = "edge") -> DataFrame:
    return (df.withColumn("_cell", F.explode(edge_cells(F.col(e), size)))
            .withColumn("cx", F.col("_cell.cx")).withColumn("cy", F.col("_cell.cy")).drop("_cell"))


def explode_edges(df: DataFrame, geom: str, keep: Sequence[str], kind: str = "line") -> DataFrame:
    """One row per straight edge, with its position along the geometry."""
    edges = g.line_edges(F.col(geom)) if kind == "line" else g.polygon_edges(F.col(geom))
    return df.select(*keep, F.posexplode(edges).alias("edge_no", "edge"))


def crowded_cells(edges: DataFrame, by: Sequence[str], limit: int | None = None) -> DataFrame:
    """(by, cx, cy, _factor): cells with more than ``limit`` edges and the sub-cells per axis to cut each into.

    The more crowded, the finer: evenly spread edges leave about ``limit / 4`` in a sub-cell.
    """
    n, limit = F.count(F.lit(1)), limit or CROWD
    finer = F.ceil(F.log2(F.sqrt(F.col("_n") / limit))) + 1
    return (edges.groupBy(*by, "cx", "cy").agg(n.alias("_n")).where(F.col("_n") > limit)
            .select(*by, "cx", "cy", F.pow(F.lit(2.0), F.least(finer, F.lit(10))).cast("long").alias("_factor")))


def refine_hot_cells(edges: DataFrame, by: Sequence[str], size: float, limit: int | None = None) -> DataFrame:
    """Add sub-cell columns (sx, sy) inside cells that hold more than ``limit`` edges.

    Joining edges on (by, cx, cy, sx, sy) then compares an edge with its near neighbours only,
    however crowded one cell is. ``edges`` carries cx, cy from ``with_edge_cells``.
    """
    factor = F.col("_factor")
    whole = F.array(F.struct(F.lit(-1).cast("long").alias("cx"), F.lit(-1).cast("long").alias("cy")))
    parent = F.filter(edge_cells(F.col("edge"), size / factor), lambda c: (
        c["cx"].between(F.col("cx") * factor - 1, F.col("cx") * factor + factor)
        & c["cy"].between(F.col("cy") * factor - 1, F.col("cy") * factor + factor)))
    return (edges.join(crowded_cells(edges, by, limit), [*by, "cx", "cy"], "left")
            .withColumn("_sub", F.explode(F.when(factor.isNull(), whole).otherwise(parent)))
            .withColumn("sx", F.col("_sub.cx")).withColumn("sy", F.col("_sub.cy")).drop("_sub", "_factor"))
