"""Polygons laid over nested square cells: a region quadtree as rows for equi-joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomesh.functions import geometry as g
from velomesh.operators import grid
from velomesh.session import checkpointed

# Cells of one level per axis of a cell of the next; edges up to which a cell at a polygon's rim is left as it is.
FAN, FEW_EDGES = 4, 8
# The point of a cell whose side of the polygon is known, as shares of its width; off the middle, where drawn borders rarely lie.
MARK_X, MARK_Y = 0.4877, 0.5131
# Pairs of a cell and an edge that are looked at together.
PAIRS = 1_000_000

CELL_KEYS = ("_lvl", "cx", "cy")
_ENDS = ("ax", "ay", "bx", "by")


def cell_mark(size: float = grid.CELL) -> tuple[Column, Column]:
    """The mark of a cover's cell, from its ``_lvl``, ``cx`` and ``cy``."""
    width = F.lit(size) * F.pow(F.lit(float(FAN)), F.col("_lvl"))
    return (F.col("cx") + MARK_X) * width, (F.col("cy") + MARK_Y) * width


def _meets_box(e: dict[str, np.ndarray], x0, y0, x1, y1) -> np.ndarray:
    """Closed intersection of edges with boxes."""
    ax, ay, bx, by = (e[k] for k in _ENDS)
    sides = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
    one_side = (np.minimum.reduce(sides) > 0) | (np.maximum.reduce(sides) < 0)
    return ((np.minimum(ax, bx) <= x1) & (np.maximum(ax, bx) >= x0) & (np.minimum(ay, by) <= y1)
            & (np.maximum(ay, by) >= y0) & ~one_side)


def _crosses(e: dict[str, np.ndarray], x, y, mx, my) -> np.ndarray:
    """Whether an edge is passed an odd number of times on the way from (mx, my) up or down to y and then along to x."""
    ax, ay, bx, by = (e[k] for k in _ENDS)
    with np.errstate(divide="ignore", invalid="ignore"):
        across = ((ay > y) != (by > y)) & (lambda at: (x < at) != (mx < at))((bx - ax) * (y - ay) / (by - ay) + ax)
        along = ((ax > mx) != (bx > mx)) & (lambda at: (y < at) != (my < at))((by - ay) * (mx - ax) / (bx - ax) + ay)
    return across != along


class _Cells:
    """Cells of one level: whose they are, where, the edges they have to look at, and the side of a known point."""

    def __init__(self, owner, cx, cy, start, count, known_x, known_y, known):
        self.owner, self.cx, self.cy, self.start, self.count = owner, cx, cy, start, count
        self.known_x, self.known_y, self.known = known_x, known_y, known

    def parts(self) -> Iterator[slice]:
        """Stretches of cells with about PAIRS edges to look at."""
        at = 0
        while at < len(self.owner):
            stop = at + max(1, int(np.searchsorted(np.cumsum(self.count[at:]), PAIRS, "right")))
            yield slice(at, stop)
            at = stop


def _spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every stretch, one stretch after the other."""
    before = np.cumsum(count) - count
    return np.arange(count.sum()) + np.repeat(start - before, count)


def _starts(box: dict[str, np.ndarray], tops: np.ndarray, level: int, offsets: np.ndarray, size: float) -> _Cells:
    """The cells of this level over the boxes of the polygons that begin on it; outside a box is outside the polygon."""
    own = np.flatnonzero(tops == level)
    low = {v: np.floor(np.floor(box[f"{v}min"][own] / size) / FAN ** level).astype(np.int64) for v in "xy"}
    high = {v: np.floor(np.floor(box[f"{v}max"][own] / size) / FAN ** level).astype(np.int64) for v in "xy"}
    wide, tall = high["x"] - low["x"] + 1, high["y"] - low["y"] + 1
    each = wide * tall
    at = _spans(np.zeros(len(own), np.int64), each)
    owner = np.repeat(own, each)
    tall = np.repeat(tall, each)
    return _Cells(owner, np.repeat(low["x"], each) + at // tall, np.repeat(low["y"], each) + at % tall,
                  offsets[owner], offsets[owner + 1] - offsets[owner],
                  box["xmin"][owner] - 1.0, box["ymin"][owner] - 1.0, np.zeros(len(owner), bool))


def _rows_of(edges: dict[str, np.ndarray], offsets: np.ndarray, box: dict[str, np.ndarray], size: float):
    """(owner, level, cx, cy, middle, counts, edge numbers) of settled cells, in parts."""
    reach = np.maximum(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"]) / (FAN * size)
    tops = np.ceil(np.log(np.maximum(reach, 1.0)) / np.log(FAN)).astype(int)
    waiting, pool = None, np.arange(offsets[-1])
    for level in range(int(tops.max()), -1, -1):
        width, split = size * FAN ** level, []
        held = [(_starts(box, tops, level, offsets, size), np.arange(offsets[-1]))] + ([(waiting, pool)] if waiting else [])
        for cells, numbers in held:
            for part in cells.parts():
                owner, cx, cy, count = cells.owner[part], cells.cx[part], cells.cy[part], cells.count[part]
                of = np.repeat(np.arange(len(owner)), count)
                number = numbers[_spans(cells.start[part], count)]
                e = {k: edges[k][number] for k in _ENDS}
                pad = grid.COVER_PAD
                x0, y0 = (cx * width)[of], (cy * width)[of]
                near = _meets_box(e, x0 - pad, y0 - pad, x0 + width + pad, y0 + width + pad)
                mx, my = (cx + MARK_X) * width, (cy + MARK_Y) * width
                odd = _crosses(e, mx[of], my[of], cells.known_x[part][of], cells.known_y[part][of])
                middle = (np.bincount(of, odd, len(owner)).astype(np.int64) % 2 == 1) != cells.known[part]
                few = np.bincount(of[near], minlength=len(owner))
                number = number[near]
                begin = np.cumsum(few) - few
                settled = ((few > 0) & ((few <= FEW_EDGES) | (level == 0))) | ((few == 0) & middle)
                pick = np.flatnonzero(settled)
                yield owner[pick], level, cx[pick], cy[pick], middle[pick], few[pick], number[_spans(begin[pick], few[pick])]
                open_ = np.flatnonzero((few > 0) & ~settled)
                if len(open_):
                    split.append((owner[open_], cx[open_], cy[open_], few[open_], number[_spans(begin[open_], few[open_])],
                                  mx[open_], my[open_], middle[open_]))
        waiting = None
        if split:
            owner, cx, cy, few, pool, mx, my, middle = (np.concatenate(c) for c in zip(*split))
            step = np.arange(FAN * FAN)
            again = np.repeat(np.arange(len(owner)), FAN * FAN)
            kx, ky = np.tile(step // FAN, len(owner)), np.tile(step % FAN, len(owner))
            waiting = _Cells(owner[again], cx[again] * FAN + kx, cy[again] * FAN + ky, (np.cumsum(few) - few)[again], few[again],
                             mx[again], my[again], middle[again])


def _lay_out(size: float):
    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, boxes = batch.column("edges"), batch.column("box")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            offsets = offsets - offsets[0]
            edges = {k: flat.field(k).to_numpy(zero_copy_only=False) for k in _ENDS}
            box = {k: boxes.field(k).to_numpy(zero_copy_only=False) for k in ("xmin", "ymin", "xmax", "ymax")}
            row = batch.column("row")
            for owner, level, cx, cy, middle, few, number in _rows_of(edges, offsets, box, size):
                own = pa.array(owner)
                kept = pa.StructArray.from_arrays([pa.array(edges[k][number]) for k in _ENDS], names=list(_ENDS))
                ends = pa.array(np.concatenate(([0], np.cumsum(few))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [row.take(own), boxes.take(own), pa.array(np.full(len(owner), level, np.int32)), pa.array(cx), pa.array(cy),
                     pa.ListArray.from_arrays(ends, kept), pa.array(middle)],
                    names=["row", "box", "_lvl", "cx", "cy", "edges", "middle"])
    return lay


def polygon_cover(polygons: DataFrame, geom: str = "geometry", size: float = grid.CELL) -> DataFrame:
    """One row per (polygon, cell) with ``_lvl``, ``cx``, ``cy``, ``box``, ``inside``, ``edges`` and ``middle``; stored.

    Cells of level n are ``size * FAN ** n`` wide and nest. A polygon starts with a few cells as wide as itself; cells
    wholly inside stay as coarse as they are and need no exact test, cells at the rim are split until they have few
    edges or the finest width. A rim cell carries the edges that touch it and whether its mark lies inside, which
    settles every point of the cell. The rows of a polygon follow its outline, not its area.

    How deep a cell is split depends on the cell, which columns cannot say in one pass, so batches of polygons are
    split level by level over flat arrays.
    """
    keep = [c for c in polygons.columns if c != geom]
    shaped = polygons.select(F.struct(*keep, F.lit(0).alias("_")).alias("row"), g.polygon_edges(F.col(geom)).alias("edges"),
                             g.polygon_bounds(F.col(geom)).alias("box")).where(F.size("edges") > 0)
    fields = {f.name: f for f in shaped.schema.fields}
    out = T.StructType([fields["row"], fields["box"], T.StructField("_lvl", T.IntegerType()), T.StructField("cx", T.LongType()),
                        T.StructField("cy", T.LongType()), fields["edges"], T.StructField("middle", T.BooleanType())])
    return checkpointed(shaped.mapInArrow(_lay_out(size), out).select(
        *[F.col("row")[c].alias(c) for c in keep], *CELL_KEYS, "box", (F.size("edges") == 0).alias("inside"), "edges", "middle"))


def at_levels(rows: DataFrame, cover: DataFrame) -> DataFrame:
    """Rows of finest cells (cx, cy), once for each level of the cover, with the cell of that level; ``_lvl`` names it."""
    levels = sorted(cover.agg(F.collect_set("_lvl")).first()[0])
    if levels in ([], [0]):
        return rows.withColumn("_lvl", F.lit(0))
    up = rows.withColumn("_lvl", F.explode(F.array(*[F.lit(n) for n in levels])))
    return up.withColumns({v: F.floor(F.col(v) / F.pow(F.lit(float(FAN)), F.col("_lvl"))).cast("long") for v in ("cx", "cy")})
