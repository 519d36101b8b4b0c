"""The derived inputs of ``views`` as SQL text, and helpers to compose oracle queries."""

from __future__ import annotations

import re


def _spoiled(column: str, shift: int) -> str:
    return (f"CASE WHEN (event_id + {shift}) % 50 = 0 THEN 'NA' WHEN (event_id + {shift}) % 77 = 0 THEN 'x1' "
            f"ELSE CAST({column} AS VARCHAR) END")


def distance(ax: str, ay: str, ex: str, ey: str) -> str:
    """Spheroid metres between two points, mid-latitude radii."""
    e2 = 0.006694379990141317
    phi = f"radians((({ay}) + ({ey})) / 2e0)"
    w = f"(1e0 - {e2}e0 * sin({phi}) * sin({phi}))"
    dy = f"(6378137e0 * {1 - e2!r}e0 / ({w} * sqrt({w})) * radians(({ey}) - ({ay})))"
    dx = f"(6378137e0 / sqrt({w}) * cos({phi}) * radians(({ex}) - ({ax})))"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def side(ax, ay, ex, ey, cx, cy) -> str:
    return f"sign((({ex}) - ({ax})) * (({cy}) - ({ay})) - (({ey}) - ({ay})) * (({cx}) - ({ax})))"


def pieces_meet(s: str, t: str) -> str:
    """Closed intersection of two segment rows aliased s and t."""
    a, b = (f"{s}.ax", f"{s}.ay", f"{s}.ex", f"{s}.ey"), (f"{t}.ax", f"{t}.ay", f"{t}.ex", f"{t}.ey")
    box = " AND ".join(
        f"least({p[k]}, {p[k + 2]}) <= greatest({q[k]}, {q[k + 2]})" for k in (0, 1) for p, q in ((a, b), (b, a)))
    return (f"{box} AND {side(*a, b[0], b[1])} * {side(*a, b[2], b[3])} <= 0 "
            f"AND {side(*b, a[0], a[1])} * {side(*b, a[2], a[3])} <= 0")


_EPOCH = "CAST(CAST(floor(epoch(last_updated)) AS BIGINT) AS VARCHAR)"
_TEXT = "strftime(last_updated, '%Y-%m-%d %H:%M:%S')"


def parsed_time(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN make_timestamp(CAST({c} AS BIGINT) * 1000000) "
            f"ELSE TRY_CAST({c} AS TIMESTAMP) END")


def guarded(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN CAST({c} AS INTEGER) END"


def guarded_number(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '-?[0-9]+(\\.[0-9]+)?') THEN CAST({c} AS DOUBLE) END"


_FOOT = """greatest(0e0, least(1e0, ((px - ax) * mx * (ex - ax) * mx + (py - ay) * my * (ey - ay) * my)
  / (((ex - ax) * mx) * ((ex - ax) * mx) + ((ey - ay) * my) * ((ey - ay) * my))))"""

CTES: dict[str, str] = {
    "ticks": """SELECT event_id, station_id, b AS num_bikes_available,
  b - CAST(event_id % (b + 1) AS INTEGER) AS mechanical_bikes, CAST(event_id % (b + 1) AS INTEGER) AS ebikes,
  40 - b AS num_docks_available, event_type AS status, ts AS last_reported, ts AS last_updated
FROM (SELECT *, CAST(user_id % 20 AS INTEGER) AS station_id, CAST(floor(value) AS INTEGER) % 40 AS b FROM events)""",
    "raw_status": f"""SELECT event_id, CAST(station_id AS VARCHAR) AS station_id,
  {_spoiled('num_bikes_available', 0)} AS bikes, {_spoiled('mechanical_bikes', 1)} AS mech,
  {_spoiled('ebikes', 2)} AS eb, {_spoiled('num_docks_available', 3)} AS docks,
  CASE WHEN event_id % 60 = 0 THEN 'NA' ELSE {_EPOCH} END AS last_reported,
  CASE WHEN event_id % 40 = 0 THEN 'NA' ELSE status END AS status,
  CASE WHEN event_id % 500 = 1 THEN 'NA' WHEN event_id % 3 = 0 THEN {_EPOCH} ELSE {_TEXT} END AS last_updated
FROM ticks""",
    "typed_status": f"""SELECT event_id, CAST(station_id AS INTEGER) AS station_id, {guarded('bikes')} AS num_bikes_available,
  {guarded('mech')} AS mechanical_bikes, {guarded('eb')} AS ebikes, {guarded('docks')} AS num_docks_available,
  {parsed_time('last_reported')} AS last_reported, nullif(status, 'NA') AS status,
  {parsed_time('last_updated')} AS last_updated
FROM raw_status WHERE last_updated IS NOT NULL AND last_updated <> 'NA'""",
    "information": """SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS station_id, 'Station ' || o_custkey AS name,
  41.3203e0 + ((o_custkey * 53) % 150) / 1000e0 AS lat, 2.0503e0 + ((o_custkey * 37) % 180) / 1000e0 AS lon,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey % 50 AS DOUBLE) END AS altitude,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(10 + o_orderkey % 30 AS INTEGER) END AS capacity,
  o_orderdate + to_seconds(o_orderkey % 86400) AS last_updated
FROM orders""",
    "raw_information": f"""SELECT o_orderkey, CAST(station_id AS VARCHAR) AS station_id, name, CAST(lat AS VARCHAR) AS lat,
  CAST(lon AS VARCHAR) AS lon, CASE WHEN o_orderkey % 10 = 0 THEN 'NA' WHEN o_orderkey % 11 = 0 THEN '1e3'
    WHEN o_orderkey % 17 = 0 THEN '-3' ELSE CAST(altitude AS VARCHAR) END AS altitude,
  CASE WHEN o_orderkey % 13 = 0 THEN 'NA' WHEN o_orderkey % 19 = 0 THEN '-3' ELSE CAST(capacity AS VARCHAR) END AS capacity,
  CASE WHEN o_orderkey % 97 = 0 THEN 'NA' WHEN o_orderkey % 89 = 0 THEN NULL ELSE {_EPOCH} END AS last_updated
FROM information""",
    "typed_information": f"""SELECT o_orderkey, CAST(station_id AS INTEGER) AS station_id, name,
  {guarded_number('lat')} AS lat, {guarded_number('lon')} AS lon, {guarded_number('altitude')} AS altitude,
  {guarded('capacity')} AS capacity, {parsed_time('last_updated')} AS last_updated
FROM raw_information WHERE last_updated IS NOT NULL AND last_updated <> 'NA'""",
    "cells": "SELECT c_custkey, c_custkey % 45 AS i, c_custkey // 45 AS j FROM customer",
    "tracts": """SELECT CAST((1 + i // 9) * 10000000 + c_custkey AS BIGINT) AS census_tract_id,
  lpad(CAST(1 + i // 9 AS VARCHAR), 2, '0') AS district_code, lpad(CAST(1 + j // 4 AS VARCHAR), 4, '0') AS neighbourhood_code,
  (1e6 * (0.5e0 + (c_custkey % 10) * 0.1e0)) / 1e6 AS census_tract_area,
  2.05e0 + 0.004e0 * i AS x0, 41.32e0 + 0.003e0 * j AS y0, 2.05e0 + 0.004e0 * (i + 1) AS x1, 41.32e0 + 0.003e0 * (j + 1) AS y1
FROM cells""",
    "location": """SELECT t.*, 'N' || district_code || '-' || neighbourhood_code AS neighbourhood_name, r.r_name AS district_name
FROM tracts t JOIN region r ON t.district_code = lpad(CAST(r.r_regionkey + 1 AS VARCHAR), 2, '0')""",
    "stations": """SELECT station_id, name, lon, lat, altitude FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY last_updated DESC) AS rn FROM information) WHERE rn = 1""",
    "areas": """SELECT s.station_id, l.census_tract_id, l.neighbourhood_code, l.neighbourhood_name, l.district_code, l.district_name
FROM stations s JOIN location l ON s.lon > l.x0 AND s.lon < l.x1 AND s.lat > l.y0 AND s.lat < l.y1""",
    "station_status": """SELECT * EXCLUDE (rn) FROM (
  SELECT *, time_bucket(INTERVAL '10 minutes', last_updated) AS ten_min_datetime,
    row_number() OVER (PARTITION BY station_id, time_bucket(INTERVAL '10 minutes', last_updated) ORDER BY last_updated DESC) AS rn
  FROM ticks) WHERE rn = 1 AND station_id IN (SELECT station_id FROM stations)""",
    "scored": """SELECT *, CASE WHEN num_bikes_available + num_docks_available > 0
    THEN num_bikes_available * 100e0 / (num_bikes_available + num_docks_available) ELSE 0 END AS pct,
  CASE WHEN num_bikes_available > 0 THEN ebikes * 100e0 / num_bikes_available ELSE 0 END AS epct,
  CASE WHEN num_bikes_available > 0 THEN mechanical_bikes * 100e0 / num_bikes_available ELSE 0 END AS mpct
FROM station_status""",
    "view_neighbourhood": """SELECT neighbourhood_code, neighbourhood_name, ten_min_datetime, avg(pct) AS avg_bike_availability,
  CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes_available
FROM scored JOIN areas USING (station_id) GROUP BY ALL""",
    "view_district": """SELECT district_code, district_name, ten_min_datetime, avg(pct) AS avg_bike_availability,
  CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes_available
FROM scored JOIN areas USING (station_id) GROUP BY ALL""",
    "population": """SELECT CAST(year(o_orderdate) AS VARCHAR) || '-01-01' AS data_referencia,
  CAST((1 + (o_custkey % 45) // 9) * 10000000 + o_custkey AS BIGINT) AS seccio_censal,
  CAST(floor(o_totalprice / 100) AS BIGINT) AS valor, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
    "income": """SELECT make_date(year(o_orderdate) + 1, 1, 1) AS "any", year(o_orderdate) + 1 AS year,
  CAST((1 + (o_custkey % 45) // 9) * 10000000 + o_custkey AS BIGINT) AS seccio_censal, o_totalprice AS import_euros,
  round((o_totalprice - lo) / nullif(hi - lo, 0), 6) AS income_norm
FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)""",
    "population_income": """SELECT p.seccio_censal AS census_tract_id, p.year, max(p.valor) AS population,
  max(i.import_euros) AS income_euros, max(i.income_norm) AS income_normalized
FROM population p JOIN location l ON p.seccio_censal = l.census_tract_id
LEFT JOIN income i ON i.seccio_censal = p.seccio_censal AND i.year = p.year GROUP BY ALL""",
    "lane_points": """SELECT *, x0 + dx1 AS x1, y0 + dy1 AS y1, x0 + dx1 + dx2 AS x2, y0 + dy1 + dy2 AS y2 FROM (
  SELECT *, 2.0513e0 + ((k * 7919) % 600) / 10000e0 AS x0, 41.3211e0 + ((k * 10473 + q * 31) % 400) / 10000e0 AS y0,
    ((k * 31 + q) % 61 - 30) / 6000e0 + 0.0001e0 AS dx1, ((k * 17) % 51 - 25) / 6000e0 + 0.0001e0 AS dy1,
    ((k * 13 + 7) % 61 - 30) / 6000e0 - 0.0001e0 AS dx2, ((k * 29 + q) % 51 - 25) / 6000e0 + 0.00005e0 AS dy2
  FROM (SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_suppkey % 10 = 9 THEN s_suppkey - 1 ELSE s_suppkey END AS k,
    unnest([0, 1, 2, 3]) AS q FROM supplier))""",
    "lanes": """SELECT CAST(q * 3 + 1 AS INTEGER) AS month, 'K' || (s_nationkey % 3) AS layer_code, CAST(1998 + q // 2 AS INTEGER) AS year,
  CAST(q % 2 + 1 AS VARCHAR) AS trimester, 'S' || (s_nationkey % 2) AS sublayer_code,
  'L' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS lane_id,
  (1998 + q // 2) || '-' || (q % 2 + 1) AS year_trimester,
  CASE s_suppkey % 3 WHEN 0 THEN 'Carril bici bidireccional - ' WHEN 1 THEN 'Carril bici unidireccional - '
    ELSE '- Via verda ' END || s_name AS description,
  CASE s_suppkey % 3 WHEN 0 THEN 'bidirectional' WHEN 1 THEN 'unidirectional' ELSE 'unknown' END AS lane_type,
  CASE WHEN s_suppkey % 3 = 2 THEN 'Via verda ' || s_name ELSE s_name END AS location,
  CASE q WHEN 0 THEN '1998-01-31' WHEN 2 THEN '1999-07-31' WHEN 3 THEN '1999-10-31' END AS data_date,
  x0, y0, x1, y1, x2, y2 FROM lane_points""",
    "pieces": """SELECT lane_id, year_trimester, 1 AS no, x0 AS ax, y0 AS ay, x1 AS ex, y1 AS ey FROM lanes
UNION ALL SELECT lane_id, year_trimester, 2, x1, y1, x2, y2 FROM lanes""",
    "trimesters": "SELECT DISTINCT year_trimester, year, trimester FROM lanes",
    "lane_state": f"""SELECT *, {distance('x0', 'y0', 'x1', 'y1')} + {distance('x1', 'y1', 'x2', 'y2')} AS length_meters FROM lanes""",
    # Clip of a segment ey an axis-parallel box: the interval of the parameter inside both slabs.
    "slabs": """SELECT p.*, l.census_tract_id, ex - ax AS dx, ey - ay AS dy, l.x0, l.x1, l.y0, l.y1
FROM pieces p JOIN tracts l ON least(ax, ex) <= l.x1 AND greatest(ax, ex) >= l.x0 AND least(ay, ey) <= l.y1 AND greatest(ay, ey) >= l.y0""",
    "clips": """SELECT *, greatest(0e0, CASE WHEN dx = 0 THEN 0e0 ELSE least((x0 - ax) / dx, (x1 - ax) / dx) END,
    CASE WHEN dy = 0 THEN 0e0 ELSE least((y0 - ay) / dy, (y1 - ay) / dy) END) AS t0,
  least(1e0, CASE WHEN dx = 0 THEN 1e0 ELSE greatest((x0 - ax) / dx, (x1 - ax) / dx) END,
    CASE WHEN dy = 0 THEN 1e0 ELSE greatest((y0 - ay) / dy, (y1 - ay) / dy) END) AS t1 FROM slabs""",
    "lane_tract": f"""SELECT lane_id, year_trimester, census_tract_id,
  sum({distance('ax + t0 * dx', 'ay + t0 * dy', 'ax + t1 * dx', 'ay + t1 * dy')}) AS length_in_tract
FROM clips WHERE t1 > t0 GROUP BY ALL HAVING length_in_tract > 1""",
    "lane_pairs": f"""SELECT DISTINCT s.year_trimester, s.lane_id AS a, t.lane_id AS b FROM pieces s JOIN pieces t
  ON s.year_trimester = t.year_trimester AND s.lane_id <> t.lane_id AND {pieces_meet('s', 't')}""",
    "network_metrics": """SELECT year_trimester, count(*) AS total_lanes, sum(length_meters) AS total_length_meters,
  CAST(sum(c) AS BIGINT) AS connected_lanes, CAST(count(*) - sum(c) AS BIGINT) AS isolated_lanes,
  CAST(sum(c) AS DOUBLE) / count(*) AS connectivity_ratio
FROM (SELECT s.*, CASE WHEN (year_trimester, lane_id) IN (SELECT (year_trimester, a) FROM lane_pairs) THEN 1 ELSE 0 END AS c
  FROM lane_state s) GROUP BY 1""",
    "tract_links": """SELECT t.census_tract_id, t.year_trimester, t.lane_id, max(CASE WHEN u.lane_id IS NULL THEN 0 ELSE 1 END) AS c
FROM lane_tract t LEFT JOIN lane_pairs p ON p.year_trimester = t.year_trimester AND p.a = t.lane_id
LEFT JOIN lane_tract u ON u.census_tract_id = t.census_tract_id AND u.year_trimester = t.year_trimester AND u.lane_id = p.b
GROUP BY ALL""",
    "tract_metrics": """SELECT d.census_tract_id, d.year_trimester, total_lanes, total_lane_length, density / best AS coverage_score,
  coalesce(c.ratio, 0) AS connectivity_score, (density / best + coalesce(c.ratio, 0)) / 2 AS network_quality_score
FROM (SELECT t.census_tract_id, year_trimester, count(DISTINCT lane_id) AS total_lanes, sum(length_in_tract) AS total_lane_length,
    sum(length_in_tract) / max(census_tract_area) AS density,
    max(sum(length_in_tract) / max(census_tract_area)) OVER (PARTITION BY year_trimester) AS best
  FROM lane_tract t JOIN tracts l ON t.census_tract_id = l.census_tract_id GROUP BY 1, 2) d
LEFT JOIN (SELECT census_tract_id, year_trimester, CAST(sum(c) AS DOUBLE) / count(*) AS ratio FROM tract_links GROUP BY 1, 2) c
  ON c.census_tract_id = d.census_tract_id AND c.year_trimester = d.year_trimester""",
    "centroids": "SELECT census_tract_id, (x0 + x1) / 2 AS px, (y0 + y1) / 2 AS py FROM tracts",
    "tangent": """SELECT *, 6378137e0 * cos(radians(py)) / sqrt(1e0 - 0.006694379990141317e0 * sin(radians(py)) * sin(radians(py))) AS mx,
  6378137e0 * 0.9933056200098587e0 / pow(1e0 - 0.006694379990141317e0 * sin(radians(py)) * sin(radians(py)), 1.5e0) AS my FROM centroids""",
    "feet": f"""SELECT c.census_tract_id, p.lane_id, p.year_trimester, px, py, ax, ay, ex, ey, {_FOOT} AS t,
  {_FOOT.replace('* mx', '').replace('* my', '')} AS u FROM tangent c, pieces p""",
    "reach": f"""SELECT census_tract_id, year_trimester, lane_id,
  min({distance('px', 'py', 'ax + t * (ex - ax)', 'ay + t * (ey - ay)')}) AS m,
  min(sqrt(pow(px - (ax + u * (ex - ax)), 2) + pow(py - (ay + u * (ey - ay)), 2))) AS flat
FROM feet GROUP BY ALL HAVING flat <= 0.1e0""",
    "nearest": """SELECT c.census_tract_id, t.year_trimester, t.year, t.trimester, min(r.m) AS metres, arg_min(r.m, r.flat) AS knn_metres
FROM centroids c CROSS JOIN trimesters t LEFT JOIN reach r ON r.census_tract_id = c.census_tract_id
  AND r.year_trimester = t.year_trimester GROUP BY ALL""",
}


def query(select: str) -> str:
    """``select`` preceded ey the WITH list of every derived input it mentions, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_]+", text)):
            if word in CTES and word not in needed:
                needed.add(word)
                visit(CTES[word])
    visit(select)
    parts = [f"{name} AS ({text})" for name, text in CTES.items() if name in needed]
    if not parts:
        return select
    head, body = ("WITH " + ",\n".join(parts)), select.strip()
    return f"{head},\n{body[5:]}" if body.upper().startswith("WITH ") else f"{head}\n{body}"
