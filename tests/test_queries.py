"""Registered queries against their oracle SQL on the smallest tables."""

import math

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "orders", "events")
duckdb = pytest.importorskip("duckdb")

# One or two of each family; ``tools/check.py`` runs them all at sf0.01.
SAMPLE = ("drifting_csv_union", "typed_status", "cleaned_status", "thinned_ticks", "population_income_fact",
          "station_status_fact", "availability_by_district", "capacity_equity", "slider_frames", "lane_tract",
          "tract_metrics", "lane_accessibility", "yearly_access", "grid_density", "isolated_lanes",
          "intersection_counts", "lane_profile", "area_outlines", "service_zones", "described_columns", "population_boxes",
          "population_density_curve", "reporting_gaps", "csv_of_years", "quoted_breaks", "thinned_files", "layer_rejects", "collections_of_years", "monthly_reload",
          "stored_dimension", "clean_lane_feed", "population_pivot", "income_pivot", "income_neighbourhoods", "snapshot_correlations", "docks_histogram",
          "correlation_significance", "lane_topology", "whole_outline", "frame_with_all_areas", "merged_snapshot",
          "streamed_availability", "streamed_thinning", "availability_week", "accessibility_report", "boundary_layer_scan")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def _norm(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float)):
        return "None" if isinstance(v, float) and math.isnan(v) else float(v)
    return str(v)


def _table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=str)


def _same(a, b):
    return len(a) == len(b) and all(
        x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1e-6 * max(1, abs(y)))
        for r, s in zip(a, b) for x, y in zip(r, s))


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert _same(_table([tuple(r) for r in df.collect()], df.columns), _table(cur.fetchall(), names))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_simplified_outlines_merge_each_area_once(spark, monkeypatch):
    from velomesh.plans import frames
    merged, plain = [], frames.dissolve
    monkeypatch.setattr(frames, "dissolve", lambda *a, **k: merged.append(1) or plain(*a, **k))
    rows = entry.queries()["simplified_outlines"](spark, FOLDER).collect()
    assert len(merged) == 1 and rows and all(r.fewer_vertices for r in rows)
