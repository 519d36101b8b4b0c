"""Operators against hand-worked cases and brute force."""

import datetime as dt
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from velomesh.functions import geodesy, geometry as g, measures
from velomesh.operators import asof, cover, crossings, dims, dissolve, grid, history, impute, nearest, quality, quantiles, skew, spatial, stats
from velomesh.plans import frames, lanes as lane_plans, stations as station_plans

LINE = "array<struct<x:double,y:double>>"


def tracts(spark):
    rows = [(1, 1.0, 2.10, 41.40, 2.11, 41.41), (2, 1.0, 2.11, 41.40, 2.12, 41.41)]
    df = spark.createDataFrame(rows, "census_tract_id int, census_tract_area double, a double, b double, c double, d double")
    return df.select("census_tract_id", "census_tract_area", g.box(*[F.col(k) for k in "abcd"]).alias("geometry"))


def lanes(spark, trimester="2020-1", which=("L1", "L2", "L3")):
    shapes = {"L1": [(2.105, 41.405), (2.115, 41.405)], "L2": [(2.1075, 41.402), (2.1075, 41.408)],
              "L3": [(2.112, 41.401), (2.112, 41.403)]}
    df = spark.createDataFrame([(k, trimester, shapes[k]) for k in which], f"lane_id string, year_trimester string, geometry {LINE}")
    return df.withColumn("length_meters", geodesy.line_length_m(F.col("geometry")))


def test_contains_join_hand_case(spark):
    pts = spark.createDataFrame([(1, 2.105, 41.402), (2, 2.110, 41.405), (3, 2.115, 41.402)], "sid int, x double, y double")
    got = spatial.contains_join(pts.select("sid", g.point(F.col("x"), F.col("y")).alias("geometry")), tracts(spark), ["sid"])
    assert {(r.sid, r.census_tract_id) for r in got.collect()} == {(1, 1), (3, 2)}


def test_lane_hand_case(spark):
    state = lanes(spark)
    clipped = lane_plans.lane_tract(state, tracts(spark))
    got = {(r.lane_id, r.census_tract_id): r.length_in_tract for r in clipped.collect()}
    assert got == pytest.approx({("L1", 1): 418.0904, ("L1", 2): 418.0904, ("L2", 1): 666.3705, ("L3", 2): 222.1234}, abs=1e-3)
    net = lane_plans.network_metrics(state).first()
    assert (net.total_lanes, net.connected_lanes, net.isolated_lanes) == (3, 2, 1)
    assert net.connectivity_ratio == pytest.approx(2 / 3)
    metrics = {r.census_tract_id: r for r in lane_plans.tract_metrics(clipped, state, tracts(spark)).collect()}
    assert metrics[1].total_lane_length == pytest.approx(1084.4608, abs=1e-3)
    assert (metrics[1].coverage_score, metrics[2].coverage_score) == pytest.approx((1.0, 0.590352), abs=1e-6)
    assert (metrics[1].connectivity_score, metrics[2].connectivity_score) == (1.0, 0.0)
    assert metrics[2].network_quality_score == pytest.approx(0.295176, abs=1e-6)


@pytest.mark.parametrize("order", ["geodesic", "planar"])
def test_nearest_hand_case(spark, order):
    state = lanes(spark).unionByName(lanes(spark, "2020-2", ("L3",)))
    pts = tracts(spark).select("census_tract_id", g.polygon_centroid(F.col("geometry")).alias("geometry")).withColumn(
        "year_trimester", F.explode(F.array(F.lit("2020-1"), F.lit("2020-2"), F.lit("2020-3"))))
    got = nearest.nearest_line(pts, state, "census_tract_id", "year_trimester", "lane_id", order=order)
    rows = {(r.census_tract_id, r.year_trimester): r for r in got.withColumn("s", measures.accessibility(F.col("metres"))).collect()}
    assert rows[1, "2020-1"].metres == pytest.approx(0, abs=1e-6)
    assert rows[1, "2020-2"].metres == pytest.approx(626.0643, abs=1e-3) and rows[1, "2020-2"].s == pytest.approx(0.614982, abs=1e-6)
    assert rows[1, "2020-3"].metres is None and rows[1, "2020-3"].s == 0.0


def random_lines(n, seed, spread=0.05, copies=0):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        x, y = 2 + rnd.random() * spread, 41 + rnd.random() * spread
        pts = [(x, y)]
        for _ in range(rnd.randint(1, 4)):
            x, y = x + (rnd.random() - 0.5) * 0.01, y + (rnd.random() - 0.5) * 0.01
            pts.append((x, y))
        out.append((f"l{i:03d}", "t", pts))
    out += [(f"c{i:03d}", "t", out[0][2][::-1]) for i in range(copies)]
    return out


def py_meet(a, b, c, d):
    def o(p, q, r):
        return np.sign((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]))
    if min(a[0], b[0]) > max(c[0], d[0]) or min(c[0], d[0]) > max(a[0], b[0]) or min(a[1], b[1]) > max(c[1], d[1]) or min(c[1], d[1]) > max(a[1], b[1]):
        return False
    return o(a, b, c) * o(a, b, d) <= 0 and o(c, d, a) * o(c, d, b) <= 0


def partners(rows):
    edges = {i: list(itertools.pairwise(p)) for i, _, p in rows}
    return {i: {j for j in edges if j != i and any(py_meet(*e, *f) for e in edges[i] for f in edges[j])} for i in edges}


@pytest.mark.parametrize("limit", [2000, 3])
def test_crossings_against_brute_force(spark, monkeypatch, limit):
    """A low limit sends nearly every cell through the sub-cells; copies hold a third of the rows."""
    rows = random_lines(60, 1, copies=30)
    monkeypatch.setattr(grid, "CROWD", limit)
    df = spark.createDataFrame(rows, f"lane string, t string, geometry {LINE}")
    want = partners(rows)
    counts = {r.lane: r.partners for r in spatial.intersection_counts(df, ["t"], "lane", count_copies=True).collect()}
    assert counts == {k: len(v) for k, v in want.items()}
    alike = {i for i, _, p in rows if p in (rows[0][2], rows[0][2][::-1])}
    no_copies = {r.lane: r.partners for r in spatial.intersection_counts(df, ["t"], "lane").collect()}
    assert no_copies == {k: len(v - alike if k in alike else v) for k, v in want.items()}
    share = spatial.connectivity_share(df, ["t"], "lane").first()
    assert (share.total, share.connected) == (90, sum(1 for v in want.values() if v))


@pytest.mark.parametrize("tile, chunk", [(2, 3), (7, 50), (1000, 10**6)])
def test_crossings_in_tiles_and_chunks(spark, monkeypatch, tile, chunk):
    """Cells cut into tiles of few lines, and pairs looked at few at a time, count every pair once."""
    monkeypatch.setattr(spatial, "TILE", tile)
    monkeypatch.setattr(crossings, "CHUNK", chunk)
    rows = random_lines(80, 2, copies=0) + [("none", None, [(2.1, 41.4), (2.2, 41.5)])]
    df = spark.createDataFrame(rows, f"lane string, t string, geometry {LINE}")
    counts = {r.lane: r.partners for r in spatial.intersection_counts(df, ["t"], "lane").collect()}
    assert counts == {k: len(v) for k, v in partners(rows[:-1]).items()}


def test_pairs_of_a_batch_of_cells():
    """Lines of different cells never meet, a pair of natives is asked once, and a long line needs no more room than a chunk."""
    zigzag = [float(v) for k in range(3000) for v in (k * 1e-6, k % 2 * 1e-3, (k + 1) * 1e-6, (k + 1) % 2 * 1e-3)]
    cut, box = [0.0, 5e-4, 3e-3, 5e-4], {"x0": 0.0, "y0": 0.0, "x1": 3e-3, "y1": 1e-3}
    rows = [{"_w": 0.005, "cx": 0, "cy": 0, "_gs": 0, "_hs": 0, "shape_id": i, "n_lines": n, **box, "edges": e, "native": True}
            for i, n, e in (("a", 2, zigzag), ("b", 5, cut))]
    away = [r | {"cx": 7, "shape_id": i} for r, i in zip(rows, "cd")]
    frame = pd.DataFrame([*rows, *away])
    out = crossings.partner_counts([], ["_w", "cx", "cy", "_gs", "_hs"])(frame, frame.drop(columns="native"))
    assert out.groupby("shape_id")["_met"].sum().to_dict() == {"a": 5, "b": 2}


def test_lines_meeting_on_a_cell_border(spark):
    """Touching exactly on a grid line from both sides still counts."""
    c = grid.CELL
    rows = [("a", "t", [(399 * c, 8000 * c), (400 * c, 8000 * c)]), ("b", "t", [(400 * c, 8000 * c), (401 * c, 8001 * c)]),
            ("c", "t", [(403 * c, 8003 * c), (404 * c, 8003 * c)])]
    df = spark.createDataFrame(rows, f"lane string, t string, geometry {LINE}")
    assert {r.lane: r.partners for r in spatial.intersection_counts(df, ["t"], "lane").collect()} == {"a": 1, "b": 1, "c": 0}


def py_metres(x, y, e):
    """Independent check: sample the edge finely with the mid-latitude formula."""
    t = np.linspace(0, 1, 2001)
    ex, ey = e[0][0] + t * (e[1][0] - e[0][0]), e[0][1] + t * (e[1][1] - e[0][1])
    phi = np.radians((y + ey) / 2)
    w = 1 - geodesy.ECC2 * np.sin(phi) ** 2
    m, n = geodesy.SEMI_MAJOR * (1 - geodesy.ECC2) / w ** 1.5, geodesy.SEMI_MAJOR / np.sqrt(w)
    return float(np.hypot(n * np.cos(phi) * np.radians(ex - x), m * np.radians(ey - y)).min())


def py_degrees(x, y, e):
    t = np.linspace(0, 1, 2001)
    return float(np.hypot(e[0][0] + t * (e[1][0] - e[0][0]) - x, e[0][1] + t * (e[1][1] - e[0][1]) - y).min())


def test_nearest_against_brute_force(spark):
    """Near and lonely points; the lonely ones pass through every ring, some are out of reach."""
    rows = random_lines(40, 5)
    rnd = random.Random(7)
    pts = [(i, 2 + rnd.random() * 0.2 - 0.05, 41 + rnd.random() * 0.2 - 0.05) for i in range(40)] + [(99, 2.6, 41.0)]
    lines = spark.createDataFrame(rows, f"lane string, t string, geometry {LINE}")
    points = spark.createDataFrame(pts, "pid int, x double, y double").select("pid", F.lit("t").alias("t"), g.point(F.col("x"), F.col("y")).alias("geometry"))
    got = {r.pid: r.metres for r in nearest.nearest_line(points, lines, "pid", "t", "lane").collect()}
    planar = {r.pid: (r.lane, r.metres) for r in nearest.nearest_line(points, lines, "pid", "t", "lane", order="planar").collect()}
    assert got[99] is None and sum(v is not None for v in got.values()) > 25
    for i, x, y in pts:
        flat = {n: min(py_degrees(x, y, e) for e in itertools.pairwise(p)) for n, _, p in rows}
        metres = {n: min(py_metres(x, y, e) for e in itertools.pairwise(p)) for n, _, p in rows}
        if min(flat.values()) > 0.1:
            assert got[i] is None and planar[i] == (None, None)
            continue
        assert got[i] == pytest.approx(min(m for n, m in metres.items() if flat[n] <= 0.1), abs=0.05)
        winner = min(flat, key=flat.get)
        assert planar[i][0] == winner and planar[i][1] == pytest.approx(metres[winner], abs=0.05)


def test_nearest_in_a_crowd(spark):
    """Thousands of short lines in one spot, one long line across: few edges per point are met, and the results stay exact."""
    rnd, rows = random.Random(11), []
    for i in range(3000):
        x, y = 2 + rnd.random() * 0.002, 41 + rnd.random() * 0.002
        rows.append((f"l{i:04d}", "t", [(x, y), (x + rnd.random() * 1e-5, y + rnd.random() * 1e-5)]))
    rows += [("long", "t", [(1.95, 40.95), (2.05, 41.05)]), ("dot", "t", [(2.0125, 41.0125), (2.0125, 41.0125)])]
    pts = [(i, 2 + rnd.random() * 0.002, 41 + rnd.random() * 0.002) for i in range(30)] + [(90, 2.0125, 41.0125), (91, 2.04, 41.03)]
    lines = spark.createDataFrame(rows, f"lane string, t string, geometry {LINE}")
    points = spark.createDataFrame(pts, "pid int, x double, y double").select("pid", F.lit("t").alias("t"), g.point(F.col("x"), F.col("y")).alias("geometry"))
    got = {r.pid: (r.lane, r.metres) for r in nearest.nearest_line(points, lines, "pid", "t", "lane", order="planar").collect()}
    for i, x, y in pts:
        flat = {n: min(py_degrees(x, y, e) for e in itertools.pairwise(p)) for n, _, p in rows if n == "long" or abs(p[0][0] - x) < 4e-4 and abs(p[0][1] - y) < 4e-4}
        winner = min(flat, key=lambda n: (flat[n], n))
        assert got[i][0] == winner or flat[got[i][0]] == pytest.approx(flat[winner], abs=1e-7)
    shapes = spatial.line_shapes(lines, ["t"], "lane")
    nodes, leaves = nearest.pyramid(grid.explode_edges(shapes, "geometry", ["t", "shape_id"]), "t", 0.1)
    assert leaves.groupBy("level", "cx", "cy").count().agg(F.max("count")).first()[0] <= nearest.LEAF
    start = points.select("pid", "t", F.col("geometry.x").alias("px"), F.col("geometry.y").alias("py"))
    cells = nearest._leaves_in_reach(start, nodes, "pid", "t", 0.1)
    assert cells.join(leaves, ["t", "level", "cx", "cy"]).count() < 4 * nearest.LEAF * len(pts)


def joins_of(df):
    """Each join of the plan as text, before anything runs."""
    return [line.strip(" :+-*") for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]


def test_exploded_rows_are_never_broadcast(spark):
    """A few thousand rows pass for a small table however many pieces they are cut into, so their joins are shuffled."""
    df = spark.createDataFrame(random_lines(60, 3), f"lane string, t string, geometry {LINE}")
    points = tracts(spark).select("census_tract_id", F.lit("t").alias("t"), g.polygon_centroid(F.col("geometry")).alias("geometry"))
    near = joins_of(nearest.nearest_line(points, df, "census_tract_id", "t", "lane"))
    assert near and not [j for j in near if j.startswith("Broadcast")]
    apart = joins_of(spatial.isolated_lines(df, "lane"))
    # the list of crowded cells may be sent; edges, discs and results may not
    assert [j for j in apart if "LeftSemi" in j] and all(j.startswith("SortMerge") for j in apart if "LeftSemi" in j)
    assert all("_factor" in j or "cx#" in j for j in apart if j.startswith("Broadcast"))
    clipped = joins_of(spatial.clip_length_join(df, tracts(spark), ["lane"], "census_tract_id"))
    assert clipped and not [j for j in clipped if j.startswith("Broadcast")]


def test_far_points_open_few_cells(spark):
    """East and west of a crowd a degree is shorter than north of it; points there do not meet the whole crowd."""
    rnd = random.Random(4)
    rows = []
    for i in range(4000):
        x, y = 2 + rnd.random() * 0.03, 41 + rnd.random() * 0.03
        rows.append((f"l{i:04d}", "t", [(x, y), (x + 1e-4, y + rnd.random() * 1e-4)]))
    pts = [(i, 2.015 + 0.095 * math.cos(a), 41.015 + 0.095 * math.sin(a)) for i, a in enumerate(np.linspace(0, 6, 24))]
    lines = spark.createDataFrame(rows, f"lane string, t string, geometry {LINE}")
    start = spark.createDataFrame(pts, "pid int, px double, py double").withColumn("t", F.lit("t"))
    nodes, leaves = nearest.pyramid(grid.explode_edges(spatial.line_shapes(lines, ["t"], "lane"), "geometry", ["t", "shape_id"]), "t", 0.1)
    met = nearest._leaves_in_reach(start, nodes, "pid", "t", 0.1).join(leaves, ["t", "level", "cx", "cy"]).groupBy("pid").count()
    assert met.agg(F.max("count")).first()[0] < 600
    points = start.select("pid", "t", g.point(F.col("px"), F.col("py")).alias("geometry"))
    got = {r.pid: r.metres for r in nearest.nearest_line(points, lines, "pid", "t", "lane").collect()}
    for i, x, y in pts[::6]:
        flat = [py_degrees(x, y, r[2]) for r in rows]
        metres = [py_metres(x, y, r[2]) for r, f in zip(rows, flat) if f <= 0.1]
        assert got[i] == pytest.approx(min(metres), abs=0.05)


def test_isolated_against_brute_force(spark):
    rows = random_lines(50, 3, spread=0.03) + [("far", "t", [(3.0, 42.0), (3.001, 42.0)]), ("near", "t", [(3.00111, 42.0), (3.002, 42.0)])]
    df = spark.createDataFrame(rows, f"lane string, t string, geometry {LINE}")
    got = {r.lane: r.is_isolated for r in spatial.isolated_lines(df, "lane").collect()}
    for i, _, p in rows:
        best = min(py_metres(*q, e) for q in (p[0], p[-1]) for j, _, o in rows if j != i for e in itertools.pairwise(o))
        if abs(best - 10) > 0.1:
            assert got[i] == (best > 10), (i, best)
    assert not got["near"] and not got["far"]


@pytest.mark.parametrize("lat", [0.0, -41.0, 69.0])
def test_isolated_asks_for_degrees_before_metres(spark, lat):
    """Most pairs of a cell are told apart in the plane; the metres decide on what is left, in every direction."""
    rows, due = [], {}
    for i, (angle, metres) in enumerate(itertools.product(np.linspace(0, 2 * math.pi, 12, endpoint=False), (9.9, 10.1))):
        x, y = 3 + 0.01 * i, lat
        east, north = metres * math.cos(angle) / (math.radians(1) * 6378137 * math.cos(math.radians(y))), metres * math.sin(angle) / 110900
        rows += [(f"a{i}", [(x, y), (x - east * 9, y - north * 9)]),
                 (f"b{i}", [(x + east - north / 10, y + north + east / 10), (x + east + north / 10, y + north - east / 10)])]
        due[f"a{i}"] = py_metres(*rows[-2][1][0], tuple(rows[-1][1])) > 10
    df = spark.createDataFrame(rows, f"lane string, geometry {LINE}")
    found = spatial.isolated_lines(df, "lane")
    got = {r.lane: r.is_isolated for r in found.collect()}
    near = {k for k in due if abs(py_metres(*next(p for n, p in rows if n == k)[0], tuple(next(p for n, p in rows if n == "b" + k[1:]))) - 10) < 0.02}
    assert {k: got[k] for k in due if k not in near} == {k: v for k, v in due.items() if k not in near} and len(near) < 6
    assert {True, False} <= set(due.values())
    plan = [j for j in joins_of(found) if "LeftSemi" in j]
    assert plan and all("reach" in j for j in plan)


def test_clipping_tiles_adds_up(spark):
    """Lengths over a full tiling sum to the lane; an edge lane counts on both sides."""
    cells = [(i * 10 + j, 2 + i * 0.01, 41 + j * 0.01) for i in range(8) for j in range(8)]
    tiles = spark.createDataFrame(cells, "tile int, x double, y double").select(
        "tile", g.box(F.col("x"), F.col("y"), F.col("x") + 0.01, F.col("y") + 0.01).alias("geometry"))
    df = spark.createDataFrame(random_lines(40, 9), f"lane string, t string, geometry {LINE}")
    inner = df.where(F.forall("geometry", lambda p: p["x"].between(2.0, 2.08) & p["y"].between(41.0, 41.08)))
    sums = {r.lane: r.m for r in spatial.clip_length_join(inner, tiles, ["lane"], "tile", min_metres=None).groupBy("lane").agg(F.sum("length_m").alias("m")).collect()}
    whole = {r.lane: r.m for r in inner.select("lane", geodesy.line_length_m(F.col("geometry")).alias("m")).collect()}
    assert sums == pytest.approx(whole, abs=1e-4) and len(whole) > 10
    side = spark.createDataFrame([("e", [(2.11, 41.401), (2.11, 41.409)])], f"lane string, geometry {LINE}")
    both = spatial.clip_length_join(side, tracts(spark), ["lane"], "census_tract_id").collect()
    assert {r.census_tract_id for r in both} == {1, 2}


def test_clip_by_polygon_with_hole_and_slanted_edges(spark):
    ring = [(2.0, 41.0), (2.04, 41.0), (2.02, 41.04), (2.0, 41.0)]
    hole = [(2.015, 41.005), (2.025, 41.005), (2.025, 41.015), (2.015, 41.015), (2.015, 41.005)]
    poly = spark.createDataFrame([(1, [ring, hole])], f"pid int, geometry array<{LINE}>")
    line = spark.createDataFrame([("a", [(1.99, 41.01), (2.05, 41.01)])], f"lane string, geometry {LINE}")
    got = spatial.clip_length_join(line, poly, ["lane"], "pid").first().length_m
    want = spark.range(1).select(geodesy.distance(*[F.lit(v) for v in (2.005, 41.01, 2.015, 41.01)]) + geodesy.distance(
        *[F.lit(v) for v in (2.025, 41.01, 2.035, 41.01)])).first()[0]
    assert got == pytest.approx(want, abs=1e-3)


def test_grid_density_counts_touched_boxes(spark):
    rows = [("a", [(2.0, 41.0), (2.025, 41.0)]), ("b", [(2.005, 41.005), (2.005, 41.015)])]
    got = spatial.grid_density(spark.createDataFrame(rows, f"lane string, geometry {LINE}"), "lane").collect()
    assert {(r.cell_x, r.cell_y): r.line_count for r in got} == {(0, 0): 2, (1, 0): 1, (2, 0): 1, (0, 1): 1}


def test_spread_join_keeps_every_pair(spark):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("long").alias("k"))
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    cut = skew.spread_join(big, small, ["k"], ["id"], slice_rows=20)
    assert skew.hot_keys(big, ["k"], 20).count() > 10
    plain = big.join(small, "k")
    assert cut.exceptAll(plain.select(cut.columns)).isEmpty() and cut.count() == plain.count() == 3000


def test_chunked_lag_equals_plain_lag(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("aaab"), i // 7, i, rnd.choice([None, 1, 2, 3])) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, chunk int, o int, v int")
    got = {(r.k, r.o): r.p for r in skew.chunked_lag(df, ["k"], "chunk", ["o"], "v", "p").collect()}
    last, want = {}, {}
    for k, _, o, val in rows:
        want[k, o] = last.get(k)
        last[k] = val
    assert got == want


def test_thinning_runs(spark):
    times = ["00:01:00", "00:09:59", "00:10:00", None, "00:05:00"]
    rows = [(i, f, i // 2, None if t is None else dt.datetime.fromisoformat(f"2020-01-01T{t}")) for f in ("f1", "f2") for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "o int, file string, chunk int, ts timestamp_ntz").withColumn("station", F.lit("7"))
    kept = history.thin_runs(df, "station", "ts", ["o"], "chunk", "file")
    assert sorted((r.file, r.o) for r in kept.collect()) == [(f, i) for f in ("f1", "f2") for i in (0, 2, 3, 4)]
    report = history.thinning_report(df, kept).first()
    assert (report.rows_in, report.rows_kept, report.rows_skipped, report.reduction_pct) == (10, 8, 2, 20.0)
    latest = history.latest_per(kept.where("ts IS NOT NULL").selectExpr("station", "window(ts, '10 minutes').start AS b", "ts"), ["station", "b"], "ts")
    assert sorted(r.ts.strftime("%H:%M") for r in latest.collect()) == ["00:05", "00:10"]
    hourly = history.thin_runs(df, "station", "ts", ["o"], "chunk", "file", 3600)
    assert sorted((r.file, r.o) for r in hourly.collect()) == [(f, i) for f in ("f1", "f2") for i in (0, 3)]


def test_latest_per_settles_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z")], "k int, t int, v string")
    assert history.latest_per(df, ["k"], "t").first() == (1, 5, "b")


def test_gaps_cross_midnight_and_days(spark):
    t = [dt.datetime(2020, 1, 1, 23, 58), dt.datetime(2020, 1, 2, 0, 2), dt.datetime(2020, 1, 5, 0, 2)]
    df = spark.createDataFrame([(1, x) for x in t], "s int, ts timestamp_ntz")
    got = history.gaps(df, ["s"], "ts").collect()
    assert [(r.previous, r.ts, r.gap_s) for r in got] == [(t[1], t[2], 259200.0)]


def test_even_sample(spark):
    stamps = [dt.datetime(2020, 1, 1) + dt.timedelta(minutes=10 * i) for i in range(70)] + [dt.datetime(2020, 1, 2, 3)]
    got = history.even_sample(spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz"), "ts").collect()
    assert sorted(r.ts for r in got) == stamps[:70][::2][:32] + stamps[70:]


def test_nearest_time_with_fallback(spark):
    day = dt.datetime(2020, 1, 1)
    rows = [("a", day + dt.timedelta(hours=1), 10.0), ("a", day + dt.timedelta(hours=2), None), ("b", day + dt.timedelta(hours=1, minutes=10), 20.0)]
    df = spark.createDataFrame(rows, "area string, ts timestamp_ntz, v double")
    got = {(r.step, r.area): (r.v, r.is_fallback, r.gap_s) for r in asof.nearest_time_join(df, "area", "ts", "v").collect()}
    assert got[6, "a"] == (10.0, False, 0) and got[6, "b"] == (20.0, False, 600)
    assert got[5, "a"] == (10.0, False, 600) and (5, "b") not in got
    # 02:00 has a row, but without a value; the nearest time of the day is then 02:00 itself.
    assert (12, "a") not in got and got[12, "b"] == (20.0, True, 3000)
    assert got[0, "a"] == (10.0, True, 0) and got[0, "b"] == (20.0, True, 600)
    assert {k[0] for k in got} == set(range(145))


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles(spark, monkeypatch, seed):
    monkeypatch.setattr(quantiles, "BINS", 8)
    rnd = random.Random(seed)
    rows = [("a", rnd.lognormvariate(0, 3)) for _ in range(700)] + [("b", float(rnd.randint(0, 5))) for _ in range(500)] + [("c", 4.0), ("c", None)]
    got = quantiles.exact_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", [0.0, 0.25, 0.5, 0.9, 1.0])
    for r in got.collect():
        want = np.quantile([v for k, v in rows if k == r.k and v is not None], [0.0, 0.25, 0.5, 0.9, 1.0])
        assert r.q == pytest.approx(list(want), rel=1e-12)
    assert got.count() == 3


def test_imputation(spark):
    df = spark.createDataFrame([(1, 2.0, 5), (1, None, 5), (1, 3.0, None), (1, None, 6), (2, None, None), (None, None, 3)], "k int, a double, c int")
    got = impute.impute(df, ["k"], {"a": "median", "c": "mode"}, default=None).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 2.0, 5), (1, 2.5, 5), (1, 3.0, 5), (1, 2.5, 6), (2, None, None), (None, None, 3)], key=str)
    assert impute.impute(df, ["k"], {"c": "mode"}, threshold_pct=90.0) is df


def test_profiles_and_keys(spark):
    empty = spark.createDataFrame([], "a int")
    assert tuple(quality.missing_profile(empty).first()) == ("a", 0, 0, None)
    df = spark.createDataFrame([(1, None), (1, 2)], "a int, `b.c` int")
    assert {tuple(r) for r in quality.missing_profile(df).collect()} == {("a", 2, 0, 0.0), ("b.c", 2, 1, 50.0)}
    with pytest.raises(ValueError):
        quality.require_unique(df, ["a"])


def test_correlation_significance(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=30)
    y, z = x + rng.normal(size=30), rng.normal(size=30)
    rows = [(2020, float(a), float(b), float(c)) for a, b, c in zip(x, y, z)] + [(2021, 1.0, 2.0, 3.0), (2021, 2.0, 3.0, 1.0)]
    got = stats.corr_significance(spark.createDataFrame(rows, "year int, x double, y double, z double"), ["x", "y", "z"], ["year"]).collect()
    assert {r.year for r in got} == {2020} and len(got) == 3
    for r in got:
        a, b = {"x": x, "y": y, "z": z}[r.a], {"x": x, "y": y, "z": z}[r.b]
        rho = np.corrcoef(a, b)[0, 1]
        t = rho * math.sqrt(28 / (1 - rho * rho))
        # Student's density integrated numerically.
        s = np.linspace(0, abs(t), 200001)
        f = math.gamma(14.5) / (math.sqrt(28 * math.pi) * math.gamma(14)) * (1 + s * s / 28) ** -14.5
        p = 1 - 2 * np.trapezoid(f, s)
        assert (r.r, r.p) == pytest.approx((rho, p), abs=1e-7)
        assert r.p_adj == pytest.approx(min(1, 3 * p), abs=1e-7) and r.significant == (r.p_adj < 0.05)


def test_constant_columns_have_no_coefficient(spark):
    rows = [("a", 1.0, 5.0, float(k)) for k in range(4)] + [("b", float(k), float(2 * k), None) for k in range(3)] + [("c", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double, z double")
    got = {(r.k, r.a, r.b): (r.n, r.r) for r in stats.correlations(df, ["x", "y", "z"], ["k"]).collect()}
    assert got["a", "x", "z"] == (4, None) and got["a", "y", "z"] == (4, None) and got["b", "x", "y"] == (3, pytest.approx(1.0))
    assert got["b", "y", "z"] == (0, None) and got["c", "y", "z"] == (1, None)
    marked = stats.corr_significance(df, ["x", "y", "z"], ["k"]).collect()
    assert [(r.k, r.p, r.significant, r.r_masked) for r in marked] == [("a", None, False, None)] * 3


def test_dissolve(spark):
    """A 3x3 ring of boxes with a hole, a T-junction inside, an island and a corner touch."""
    boxes = [("a", i, j, i + 1, j + 1) for i in range(3) for j in range(3) if (i, j) != (1, 1)]
    boxes += [("a", 3, 0, 5, 2), ("a", 10, 10, 11, 11), ("b", 0, 0, 1, 1), ("b", 1, 1, 2, 2)]
    df = spark.createDataFrame([(k, i * 0.01, j * 0.01, m * 0.01, n * 0.01) for k, i, j, m, n in boxes], "k string, a double, b double, c double, d double")
    polys = df.select("k", g.box(*[F.col(c) for c in "abcd"]).alias("geometry"))
    parts = dissolve.dissolve(polys, ["k"]).withColumn("area", g.polygon_area(F.col("geometry")) * 1e4).collect()
    a = sorted((round(r.area, 6), len(r.geometry)) for r in parts if r.k == "a")
    assert a == [(1.0, 1), (12.0, 2)]
    assert sorted(round(r.area, 6) for r in parts if r.k == "b") == [1.0, 1.0]
    big = dissolve.largest_part(dissolve.dissolve(polys, ["k"]), ["k"]).where("k = 'a'").first()
    assert len(big.geometry) == 2


def _union_by_scanlines(polys, lines=6000):
    """Area of a union of polygons, each given as rings, from the covered stretches of many horizontal lines."""
    ys = [y for p in polys for r in p for _, y in r]
    low, high = min(ys), max(ys)
    total = 0.0
    for k in range(lines):
        y = low + (k + 0.5) * (high - low) / lines
        spans = []
        for p in polys:
            xs = sorted((bx - ax) * (y - ay) / (by - ay) + ax for r in p for (ax, ay), (bx, by) in zip(r, r[1:]) if (ay > y) != (by > y))
            spans += list(zip(xs[::2], xs[1::2]))
        end = -math.inf
        for a, b in sorted(spans):
            total += max(0.0, b - max(a, end))
            end = max(end, b)
    return total * (high - low) / lines


def test_paths_of_many_cells_are_linked_in_one_call():
    import pandas as pd
    rows = [(cell, w, [x, x + 1.0], [0.0, 0.0]) for cell in ("a", "b") for w, x in ((0, 1.0), (0, 0.0))]
    rows.append(("b", 0, [9.0, 9.5, 9.0], [0.0, 1.0, 0.0]))
    pdf = pd.DataFrame([{"_cell": c, "xs": x, "ys": y, "hw": w, "tw": w} for c, w, x, y in rows])
    out = dissolve._chain(pdf)
    assert sorted((c, list(x)) for c, x in zip(out["_cell"], out["xs"])) == [
        ("a", [0.0, 1.0, 2.0]), ("b", [0.0, 1.0, 2.0]), ("b", [9.0, 9.5, 9.0])]


def test_outlines_take_few_calls_however_many_cells(spark, tmp_path):
    """Boxes far apart, each in a cell of its own: the calls that link edges follow the edges, not the cells."""
    calls = tmp_path / "calls"
    calls.mkdir()
    plain = dissolve._chain

    def counted(pdf):
        import uuid
        (calls / uuid.uuid4().hex).touch()
        return plain(pdf)
    boxes = spark.range(60).select(F.lit("k").alias("k"), g.box(F.col("id") / 1.0, F.lit(0.0), F.col("id") + 0.01, F.lit(0.01)).alias("geometry"))
    dissolve._chain = counted
    try:
        assert dissolve.boundary_rings(boxes, ["k"]).count() == 60
    finally:
        dissolve._chain = plain
    assert 2 <= len(list(calls.iterdir())) <= 4


def test_edges_met_at_their_ends_only_are_not_cut(spark):
    """A box adjoining two others, one edge of which it overlaps in part, and a group without a name."""
    box = lambda k, x, y, u, w: (k, [[(x, y), (u, y), (u, w), (x, w), (x, y)]])
    rows = [box("a", 0.0, 0.0, 2.0, 1.0), box("a", 0.0, 1.0, 1.0, 2.0), box("a", 1.0, 1.0, 2.0, 2.0), box(None, 0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, geometry array<array<struct<x:double,y:double>>>")
    got = dissolve.noded_pieces(df, ["k"], size=0.5).collect()
    pieces = sorted((r.k or "", *r.edge) for r in got)
    a = [(0, 0, 0, 1), (0, 0, 2, 0), (0, 1, 0, 2), (0, 1, 1, 1), (0, 2, 1, 2), (1, 1, 1, 2), (1, 1, 2, 1), (1, 2, 2, 2), (2, 0, 2, 1), (2, 1, 2, 2)]
    none = [(0, 0, 0, 1), (0, 0, 1, 0), (0, 1, 1, 1), (1, 0, 1, 1)]
    assert pieces == sorted([("a", *map(float, e)) for e in a] + [("", *map(float, e)) for e in none])


def _outline_by_samples(polys, step=400):
    """Length of a union's outline: the shares of all edges that lie in no other polygon."""
    total = 0.0
    for k, p in enumerate(polys):
        for (ax, ay), (bx, by) in [e for r in p for e in zip(r, r[1:])]:
            free = sum(not any(sum(_inside(r, ax + t * (bx - ax), ay + t * (by - ay)) for r in q) % 2 for j, q in enumerate(polys) if j != k)
                       for t in ((i + 0.5) / step for i in range(step)))
            total += free / step * math.hypot(bx - ax, by - ay)
    return total


def _disc(cx, cy, r, n):
    ring = [(cx + r * math.cos(2 * math.pi * (k + 0.3) / n), cy + r * math.sin(2 * math.pi * (k + 0.3) / n)) for k in range(n)]
    return [*ring, ring[0]]


OVERLAPS = {
    "chain": [[_disc(2.10 + 0.013 * k, 41.4 + 0.004 * (k % 2), 0.01, 24)] for k in range(6)],
    "nested": [[_disc(2.1, 41.4, 0.03, 40)], [_disc(2.1, 41.4, 0.01, 12)], [_disc(2.105, 41.4, 0.004, 9)]],
    # a ring with a hole, an island in the hole, and a disc across the ring's inner border
    "island": [[_disc(2.1, 41.4, 0.03, 40), _disc(2.1, 41.4, 0.02, 32)[::-1]], [_disc(2.1, 41.4, 0.005, 10)], [_disc(2.12, 41.4, 0.006, 14)]],
    "copies": [[_disc(2.1, 41.4, 0.01, 7)]] * 3 + [[_disc(2.1, 41.4, 0.01, 7)[::-1]]],
    # a corner of one touches a slanted edge of the other, which runs the other way: two parts
    "touching": [[[(2.1, 41.4), (2.11, 41.41), (2.1, 41.42), (2.09, 41.41), (2.1, 41.4)]],
                 [[(2.105, 41.405), (2.105, 41.395), (2.115, 41.395), (2.115, 41.405), (2.105, 41.405)]]],
    # many discs around one point: a closed chain with a hole in the middle
    "wreath": [[_disc(2.1 + 0.02 * math.cos(k), 41.4 + 0.02 * math.sin(k), 0.0123, 30)] for k in range(20)],
}


@pytest.mark.parametrize("size", [0.005, 0.002])
def test_union_of_overlapping_polygons(spark, size):
    df = spark.createDataFrame([(k, p) for k, ps in OVERLAPS.items() for p in ps], f"k string, geometry array<{LINE}>")
    parts = dissolve.dissolve(df, ["k"], size=size).withColumns({
        "area": g.polygon_area(F.col("geometry")), "outline": F.aggregate("geometry", F.lit(0.0), lambda s, r: s + g.line_length(r))}).collect()
    shape = {"chain": [1], "nested": [1], "island": [1, 2], "copies": [1], "touching": [1, 1], "wreath": [2]}
    for k, polys in OVERLAPS.items():
        mine = [r for r in parts if r.k == k]
        assert sorted(len(r.geometry) for r in mine) == shape[k], k
        assert sum(r.area for r in mine) == pytest.approx(_union_by_scanlines(polys), rel=2e-5), k
        distinct = polys[:1] if k == "copies" else polys
        assert sum(r.outline for r in mine) == pytest.approx(_outline_by_samples(distinct), rel=2e-3), k


def test_rings_of_many_open_paths(spark):
    """A closed way of 300 paths, a second one, and one that leads nowhere, put in order without meeting in a group."""
    ways = [[(r * 1000 + k, f"{r}:{k}", f"{r}:{(k + 1) % n}") for k in range(n)] for r, n in ((1, 300), (2, 7), (3, 1))]
    ways.append([(5000 + k, f"x:{k}", f"x:{k + 1}") for k in range(20)])
    rows = [w for way in ways for w in way]
    random.Random(3).shuffle(rows)
    got = dissolve._ring_order(spark.createDataFrame(rows, "id long, head string, tail string")).collect()
    assert [[r.id for r in sorted((r for r in got if r.ring == lead), key=lambda r: r.place)] for lead in (1000, 2000, 3000)] == [
        [i for i, *_ in way] for way in ways[:3]]
    assert {r.ring for r in got} == {1000, 2000, 3000}


def test_simplify(spark):
    ring = [(0.0, 0.0), (0.5, 0.00005), (1.0, 0.0), (1.0, 0.5), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    sliver = [(3.0, 0.0), (3.0, 0.00001), (3.00001, 0.0), (3.0, 0.0)]
    df = spark.createDataFrame([(1, [ring]), (2, [sliver])], f"pid int, geometry array<{LINE}>")
    got = dissolve.simplify(df, ["pid"]).collect()
    assert [(r.pid, [(p.x, p.y) for p in r.geometry[0]]) for r in got] == [(1, [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)])]


def test_area_shapes_drop_straight_vertices(spark):
    loc = tracts(spark).withColumn("district_code", F.lit("01")).withColumn("district_name", F.lit("D"))
    shape = frames.area_shapes(loc, "district").first()
    assert len(shape.geometry[0]) == 5


def test_dims(spark):
    days = spark.createDataFrame([(dt.datetime(2020, 1, 1, 5),), (dt.datetime(2021, 2, 3, 20, 59),)], "ts timestamp_ntz")
    known = dims.month_dim(days.limit(1))
    assert sorted(r.year_month for r in dims.extended(known, dims.month_dim(days), ["year_month"]).collect()) == ["2020-01", "2021-02"]
    hours = dims.hour_dim(days, dims.day_dim(days))
    assert {(r.hour, r.day_part) for r in hours.collect()} == {(5, "morning"), (20, "evening")}
    buckets = dims.ten_minute_dim(days, hours).collect()
    assert sorted(r.minute_bucket for r in buckets) == [0, 50]
    assert dims.unknown_rows(days, days).isEmpty()


def test_origin_destination_counts_row_pairs(spark):
    info = spark.createDataFrame([(1, 2.0, 41.0), (1, 2.0, 41.0), (2, 2.1, 41.1), (3, 2.2, 41.2)], "station_id int, lon double, lat double")
    got = station_plans.origin_destination(info, [1, 2]).collect()
    assert {(r.origin_station, r.destination_station, r.n_pairs) for r in got} == {(1, 2, 2), (2, 1, 2)}


def test_every_hot_key_is_cut(spark):
    big = spark.range(3000).selectExpr("id % 300 AS k", "id AS v")
    small = spark.range(300).selectExpr("id AS k", "id * 2 AS w")
    hot = skew.hot_keys(big, ["k"], 4)
    assert hot.count() == 300 and {r.fan for r in hot.collect()} == {3}
    got = skew.spread_join(big, small, ["k"], ["v"], slice_rows=4).collect()
    assert sorted((r.k, r.v, r.w) for r in got) == sorted((i % 300, i, i % 300 * 2) for i in range(3000))


def test_imputation_has_one_schema(spark):
    df = spark.createDataFrame([(1, 3), (1, 4), (2, 5)], "k int, n int")
    full = impute.impute(df, ["k"], {"n": "median"})
    gaps = impute.impute(df.union(spark.createDataFrame([(1, None)], "k int, n int")), ["k"], {"n": "median"})
    assert full.schema == gaps.schema and sorted(r.n for r in gaps.collect()) == [3.0, 3.5, 4.0, 5.0]


@pytest.mark.parametrize("ends,metres", [  # by the inverse geodesic problem on the WGS84 spheroid
    (((0.0, 0.0), (1.0, 0.0)), 111319.491), (((0.0, 0.0), (0.0, 1.0)), 110574.389), (((0.0, 0.0), (90.0, 0.0)), 10018754.171),
    (((0.0, 0.0), (0.0, 90.0)), 10001965.729), (((2.1, 41.4), (2.2, 41.4)), 8361.7)])
def test_distance_at_any_length(spark, ends, metres):
    (ax, ay), (bx, by) = ends
    got = spark.range(1).select(geodesy.distance(*map(F.lit, (ax, ay, bx, by))).alias("d")).first().d
    assert got == pytest.approx(metres, rel=2e-5, abs=15)


def test_rows_without_station_are_kept(spark):
    rows = [(i, None if i < 5 else "s", dt.datetime(2020, 1, 1)) for i in range(8)]
    df = spark.createDataFrame(rows, "o int, station string, ts timestamp_ntz").withColumns({"file": F.lit("f"), "chunk": F.lit(0)})
    assert sorted(r.o for r in history.thin_runs(df, "station", "ts", ["o"], "chunk", "file").collect()) == [0, 1, 2, 3, 4, 5]


def test_station_in_overlapping_tracts_counts_once(spark):
    status = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 4, 2, 2, 6)], "station_id int, ten_min_datetime timestamp_ntz, "
                                   "num_bikes_available int, mechanical_bikes int, ebikes int, num_docks_available int")
    areas = spark.createDataFrame([(1, "A", "01"), (1, "A", "01")], "station_id int, district_name string, district_code string")
    row = station_plans.availability(status, areas).first()
    assert (row.station_count, row.total_bikes_available) == (1, 8)


def test_lane_twice_in_a_trimester_is_refused(spark):
    row = ("L", 2020, "1", "t", "d", "l", [(2.1, 41.4), (2.2, 41.4)])
    schema = f"lane_id string, year int, trimester string, lane_type string, description string, location string, geometry {LINE}"
    assert lane_plans.lane_state(spark.createDataFrame([row], schema)).count() == 1
    with pytest.raises(ValueError, match="duplicate"):
        lane_plans.lane_state(spark.createDataFrame([row, row], schema))


def test_lines_with_needless_vertices_are_equal(spark):
    a, b, c = [(0.0, 0.0), (2.0, 2.0), (3.0, 0.0)], [(3.0, 0.0), (2.0, 2.0), (1.0, 1.0), (0.0, 0.0)], [(0.0, 0.0), (2.0, 2.0), (1.0, 1.0), (3.0, 0.0)]
    df = spark.createDataFrame([(a, b, c)], f"a {LINE}, b {LINE}, c {LINE}")
    row = df.select(g.same_line(F.col("a"), F.col("b")).alias("ab"),
                    g.same_line(F.col("a"), F.col("c")).alias("ac")).first()
    assert row.ab and not row.ac


def _meet(p, q):
    """Closed intersection of two lines, by signs of exact products."""
    from fractions import Fraction
    turn = lambda a, b, c: (lambda v: (v > 0) - (v < 0))((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))
    exact = lambda line: [(Fraction(x), Fraction(y)) for x, y in line]
    return any(turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0
               and min(a[0], b[0]) <= max(c[0], d[0]) and min(c[0], d[0]) <= max(a[0], b[0])
               and min(a[1], b[1]) <= max(c[1], d[1]) and min(c[1], d[1]) <= max(a[1], b[1])
               for a, b in zip(exact(p), exact(p)[1:]) for c, d in zip(exact(q), exact(q)[1:]))


def test_partners_of_lines_of_all_lengths(spark):
    """Lines from centimetres to degrees, copies and single points among them, against every pair."""
    rng = random.Random(11)
    lines = {}
    for k in range(160):
        step, x, y = 10 ** rng.uniform(-7, 0.2), 2.1 + rng.uniform(0, 0.02), 41.4 + rng.uniform(0, 0.02)
        line = [(x, y)]
        for _ in range(rng.randint(1, 4)):
            line.append((line[-1][0] + rng.uniform(-step, step), line[-1][1] + rng.uniform(-step, step)))
        lines[f"l{k:03}"] = line
    for k in range(0, 40, 4):
        lines[f"r{k}"] = lines[f"l{k:03}"][::-1]
        lines[f"t{k}"] = [lines[f"l{k:03}"][-1], (lines[f"l{k:03}"][-1][0] + 1e-4, 41.39)]
    df = spark.createDataFrame([(i % 2, k, v) for i, (k, v) in enumerate(sorted(lines.items()))] , f"g int, lane string, geometry {LINE}")
    group = {k: i % 2 for i, k in enumerate(sorted(lines))}
    same = lambda p, q: p == q or p == q[::-1]
    for copies in (False, True):
        got = {r.lane: r.partners for r in spatial.intersection_counts(df, ["g"], "lane", count_copies=copies).collect()}
        want = {a: sum(group[a] == group[b] and a != b and (copies or not same(p, q)) and (same(p, q) or _meet(p, q))
                       for b, q in lines.items()) for a, p in lines.items()}
        assert got == want
    shapes = spatial.connected_shapes(spatial.line_shapes(df, ["g"], "lane"), ["g"])
    linked = {r.shape_id for r in shapes.where("is_connected").collect()}
    assert linked == {r.shape_id for r in shapes.collect() if want[r.shape_id]}


def test_thousands_of_lines_through_one_point(spark):
    """Every pair meets, and what is written is one count a line."""
    n = 3000
    rows = spark.range(n).select(F.concat(F.lit("l"), "id").alias("lane"), F.array(
        g.point(2.1 - F.cos("id") * 0.003, 41.4 - F.sin("id") * 0.003), g.point(F.lit(2.1), F.lit(41.4)),
        g.point(2.1 + F.cos("id") * 0.002, 41.4 + F.sin("id") * 0.002)).alias("geometry"))
    counts = spatial.intersection_counts(rows, [], "lane")
    assert counts.agg(F.min("partners"), F.max("partners"), F.count("*")).first() == (n - 1, n - 1, n)


def test_density_of_a_long_lane(spark):
    """A lane across thousands of boxes counts in those it touches; what is unfolded follows its length."""
    rows = [("long", [(0.0, 0.0), (20.0, 20.0)]), ("short", [(3.001, 3.004), (3.012, 3.004)])]
    df = spark.createDataFrame(rows, f"lane string, geometry {LINE}")
    got = {(r.cell_x, r.cell_y): r.line_count for r in spatial.grid_density(df, "lane").collect()}
    # at a corner that two diagonal boxes share, the other two may or may not be touched
    assert got[300, 300] == 2 and got[301, 300] >= 1 and 2000 <= sum(n == 1 for n in got.values()) <= 6002
    assert all(abs(x - y) <= 1 for x, y in got)


def _star(n, cx=2.15, cy=41.4, r=0.2):
    """A ring with deep teeth."""
    return [(cx + (r if k % 2 else r * 0.35) * math.cos(2 * math.pi * k / n), cy + (r if k % 2 else r * 0.35) * math.sin(2 * math.pi * k / n)) for k in range(n)] + [
        (cx + r * 0.35, cy)]


def _inside(ring, x, y):
    return sum(((ay > y) != (by > y)) and x < (bx - ax) * (y - ay) / (by - ay) + ax for (ax, ay), (bx, by) in zip(ring, ring[1:])) % 2 == 1


@pytest.mark.parametrize("n", [12, 600])
def test_cover_settles_every_point(spark, n, monkeypatch):
    """A polygon with a hole over cells of one or several levels agrees with the plain test."""
    shell, hole = _star(n), [(2.14, 41.39), (2.16, 41.39), (2.16, 41.41), (2.14, 41.41), (2.14, 41.39)]
    poly = spark.createDataFrame([("p", [shell, hole])], f"name string, shape array<{LINE}>")
    rng = random.Random(n)
    pts = [(i, rng.uniform(1.93, 2.37), rng.uniform(41.18, 41.62)) for i in range(1500)]
    points = spark.createDataFrame(pts, "pid int, x double, y double").select("pid", g.point(F.col("x"), F.col("y")).alias("geometry"))
    want = {i for i, x, y in pts if _inside(shell, x, y) != _inside(hole, x, y)}
    for few, size in ((0, 0.004), (8, 0.02), (8, 0.5), (10 ** 9, 0.001)):
        monkeypatch.setattr(cover, "FEW_EDGES", few)
        got = spatial.contains_join(points, poly, ["pid"], geom="shape", size=size)
        assert {r.pid for r in got.collect()} == want, (few, size)


def test_large_polygon_has_rows_by_its_outline(spark):
    """Ten thousand vertices around a hundred thousand cells: thousands of rows, no cell with more than the edges near it."""
    ring = [(2.1 + math.cos(2 * math.pi * k / 10_000), 41.4 + math.sin(2 * math.pi * k / 10_000)) for k in range(10_000)]
    poly = spark.createDataFrame([("p", [[*ring, ring[0]]])], f"name string, shape array<{LINE}>")
    laid = cover.polygon_cover(poly, "shape", 0.005)
    cells = F.pow(F.lit(float(cover.FAN ** 2)), F.col("_lvl"))
    row = laid.agg(F.count("*").alias("n"), F.max(F.size("edges")).alias("most"), F.countDistinct("_lvl").alias("levels"),
                    F.sum(F.when(F.col("inside"), cells)).alias("inside")).first()
    assert row.n < 8_000 and row.most < 40 and row.levels >= 3 and row.inside == pytest.approx(math.pi / 0.005 ** 2, rel=0.02)


def test_quantiles_over_many_magnitudes(spark):
    rng = random.Random(8)
    values = [10 ** rng.uniform(-13, 13) * rng.choice([1, 1, 1, -1]) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles.exact_quantiles(df, [], "v", [0.25, 0.5, 0.99]).first().q
    assert got == pytest.approx(np.quantile(values, [0.25, 0.5, 0.99]).tolist(), rel=1e-12)


def test_quantiles_of_clusters_in_clusters(spark, monkeypatch):
    """Values that lie in ever narrower clusters stay in one bin of any width; pivots of their own split them."""
    monkeypatch.setattr(quantiles, "BINS", 4)
    monkeypatch.setattr(quantiles, "SLOT", 40)
    monkeypatch.setattr(quantiles, "PIVOTS", 3)
    sizes, split = [], quantiles._split

    def watched(rows, large, keys):
        sizes.append(rows.groupBy(*keys).count().agg({"count": "max"}).first()[0])
        return split(rows, large, keys)

    monkeypatch.setattr(quantiles, "_split", watched)
    values = {"a": [1.0, 1e9] + [1 + 1e-3 * (1 + 1e-3 * k / 900) for k in range(900)], "b": [float(k) for k in range(30)], "c": [7.0] * 500}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [("a", None)], "k string, v double")
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = {r.k: r.q for r in quantiles.exact_quantiles(df, ["k"], "v", probs).collect()}
    assert got.keys() == values.keys() and all(got[k] == pytest.approx(np.quantile(v, probs).tolist(), rel=1e-14) for k, v in values.items())
    assert sizes[0] > 800 and all(b < a for a, b in zip(sizes, sizes[1:])) and len(sizes) >= 2
