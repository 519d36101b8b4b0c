"""Counting the pairs of lines that meet inside one batch of cells, for tables that Spark has dealt out by cell."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd

# Pairs, or pairs of edges, that are looked at together.
CHUNK = 200_000


def _spans(counts: np.ndarray, chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, place): every place below ``counts[owner]`` of every owner, ``chunk`` at a time, however large one count is."""
    ends = np.cumsum(counts, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    for start in range(0, total, chunk):
        stop = min(start + chunk, total)
        first, last = np.searchsorted(ends, [start, stop - 1], side="right")
        own = np.arange(first, last + 1)
        begin = ends[own] - counts[own]
        taken = np.minimum(ends[own], stop) - np.maximum(begin, start)
        owner = np.repeat(own, taken)
        yield owner, np.arange(start, stop) - (ends[owner] - counts[owner])


def _turn(ax, ay, bx, by, cx, cy) -> np.ndarray:
    return np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _edges_meet(e: np.ndarray, f: np.ndarray) -> np.ndarray:
    """``geometry.edges_meet`` on rows whose boxes meet."""
    (ax, ay, bx, by), (cx, cy, dx, dy) = e.T, f.T
    return ((_turn(ax, ay, bx, by, cx, cy) * _turn(ax, ay, bx, by, dx, dy) <= 0)
            & (_turn(cx, cy, dx, dy, ax, ay) * _turn(cx, cy, dx, dy, bx, by) <= 0))


class _Lines:
    """Columns of one side as flat arrays."""

    def __init__(self, df: pd.DataFrame, cell: np.ndarray, name: np.ndarray):
        self.cell, self.name, self.n = cell, name, df["n_lines"].to_numpy(dtype=np.int64)
        self.x0, self.y0, self.x1, self.y1 = (df[c].to_numpy(dtype=float) for c in ("x0", "y0", "x1", "y1"))
        flat = [np.asarray(v, dtype=float) for v in df["edges"]]
        self.size = np.array([len(v) // 4 for v in flat], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.edge = np.concatenate([*flat, np.empty(0)]).reshape(-1, 4)
        self.low, self.high = (np.c_[m(self.edge[:, 0], self.edge[:, 2]), m(self.edge[:, 1], self.edge[:, 3])] for m in (np.minimum, np.maximum))


def _near(asking: _Lines, native: np.ndarray, width: np.ndarray, cx: np.ndarray, cy: np.ndarray, asked: _Lines) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs whose boxes meet and that are to be judged in their cell. ``asked`` is sorted by cell and western end."""
    low, high = np.zeros(len(asking.cell), dtype=np.int64), np.zeros(len(asking.cell), dtype=np.int64)
    order = np.argsort(asking.cell, kind="stable")
    cells, start = np.unique(asking.cell[order], return_index=True)
    begin, end = np.searchsorted(asked.cell, cells), np.searchsorted(asked.cell, cells, side="right")
    for rows, b, e in zip(np.split(order, start[1:]), begin, end):
        if e > b:
            wests = asked.x0[b:e]
            widest = (asked.x1[b:e] - wests).max()
            low[rows] = b + np.searchsorted(wests, asking.x0[rows] - widest - 1e-9 * (1 + widest))
            high[rows] = b + np.searchsorted(wests, asking.x1[rows], side="right")
    for i, k in _spans(np.maximum(high - low, 0), CHUNK):
        j = low[i] + k
        keep = (asking.y0[i] <= asked.y1[j]) & (asked.y0[j] <= asking.y1[i])
        i, j = i[keep], j[keep]
        keep = (asking.x0[i] <= asked.x1[j]) & (asked.x0[j] <= asking.x1[i])
        keep &= np.where(native[i], asking.name[i] < asked.name[j], asking.name[i] != asked.name[j])
        i, j = i[keep], j[keep]
        keep = ((np.floor(np.maximum(asking.x0[i], asked.x0[j]) / width[i]) == cx[i])
                & (np.floor(np.maximum(asking.y0[i], asked.y0[j]) / width[i]) == cy[i]))
        yield i[keep], j[keep]


def _meet(a: _Lines, i: np.ndarray, b: _Lines, j: np.ndarray) -> np.ndarray:
    """Whether an edge of line ``i`` meets one of line ``j``, for every pair."""
    met = np.zeros(len(i), dtype=bool)
    for pair, k in _spans(a.size[i] * b.size[j], CHUNK):
        wide = b.size[j[pair]]
        e, f = a.first[i[pair]] + k // wide, b.first[j[pair]] + k % wide
        near = ((a.low[e, 0] <= b.high[f, 0]) & (b.low[f, 0] <= a.high[e, 0])
                & (a.low[e, 1] <= b.high[f, 1]) & (b.low[f, 1] <= a.high[e, 1]))
        pair, e, f = pair[near], e[near], f[near]
        met[pair[_edges_meet(a.edge[e], b.edge[f])]] = True
    return met


def partner_counts(by: Sequence[str], cell: Sequence[str]) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Step of a cogrouped job: (by, shape_id, _met), the lines that each guest and each host of a batch of cells meets there."""
    keys = [*by, *cell]

    def count(guests: pd.DataFrame, hosts: pd.DataFrame) -> pd.DataFrame:
        out = [*by, "shape_id"]
        if guests.empty or hosts.empty:
            return pd.DataFrame({c: guests[c][:0] for c in out} | {"_met": np.empty(0, dtype=np.int64)})
        both = pd.concat([guests[[*keys, "shape_id"]], hosts[[*keys, "shape_id"]]], ignore_index=True)
        cells = both.groupby(keys, sort=False).ngroup().to_numpy()
        # the order of names decides which of two natives asks, so it must be the same in every batch
        names = np.unique(both["shape_id"].to_numpy(), return_inverse=True)[1]
        n = len(guests)
        order = np.lexsort((hosts["x0"].to_numpy(dtype=float), cells[n:]))
        asking, asked = _Lines(guests, cells[:n], names[:n]), _Lines(hosts.iloc[order], cells[n:][order], names[n:][order])
        found, given = np.zeros(n, dtype=np.int64), np.zeros(len(hosts), dtype=np.int64)
        for i, j in _near(asking, guests["native"].to_numpy(dtype=bool), *(guests[c].to_numpy(dtype=float) for c in ("_w", "cx", "cy")), asked):
            met = _meet(asking, i, asked, j)
            i, j = i[met], j[met]
            np.add.at(found, i, asked.n[j])
            np.add.at(given, j, asking.n[i])
        rows = pd.concat([guests[out].assign(_met=found), hosts.iloc[order][out].assign(_met=given)], ignore_index=True)
        return rows[rows["_met"] > 0]
    return count
