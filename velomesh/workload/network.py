"""Lane network: lengths, clipping, connectivity, proximity, outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomesh.functions import geodesy, geometry as g
from velomesh.operators import dissolve as d, history, spatial
from velomesh.plans import frames, indicators, lanes as lane_plans, studies
from velomesh.session import checkpointed
from velomesh.workload import views as v
from velomesh.workload.registry import register, rounded
from velomesh.workload.sqltext import distance, pieces_meet


def _lane_tract(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table of metres per tract, written out since several metrics read it."""
    return checkpointed(lane_plans.lane_tract(v.lane_state(spark, folder), v.location(spark, folder)))


def _tract_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return lane_plans.tract_metrics(_lane_tract(spark, folder), v.lane_state(spark, folder), v.location(spark, folder))


def _trimesters(spark: SparkSession, folder: str) -> DataFrame:
    return lane_plans.dim_trimester(v.lanes(spark, folder))


def _drawn(spark: SparkSession, folder: str) -> DataFrame:
    """All lane rows as lines of their own, trimesters mixed."""
    return v.lane_state(spark, folder).select(F.concat_ws("@", "lane_id", "year_trimester").alias("lane_id"), "geometry")


_MIXED = "SELECT lane_id || '@' || year_trimester AS id, no, ax, ay, ex, ey FROM pieces"
_WHOLE = "SELECT lane_id || '@' || year_trimester AS id, x0, y0, x1, y1, x2, y2 FROM lanes"


@register("trimester_dimension", "P12 U3 Q8", "SELECT year_trimester, year, trimester FROM trimesters")
def trimester_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return _trimesters(spark, folder)


@register("lane_lengths", "G6 G8 F4 Q8", "SELECT lane_id, year_trimester, lane_type, location, round(length_meters, 4) AS length_meters FROM lane_state")
def lane_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(v.lane_state(spark, folder).drop("geometry", "description"), 4, "length_meters")


@register("lane_tract", "J4 G4 G5 F3 Q8", "SELECT lane_id, year_trimester, census_tract_id, round(length_in_tract, 2) AS length_in_tract FROM lane_tract")
def lane_tract(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(lane_plans.lane_tract(v.lane_state(spark, folder), v.location(spark, folder)), 2, "length_in_tract")


@register("lane_connections", "J5 G4", """
SELECT l.lane_id, l.year_trimester, count(DISTINCT b) AS partners FROM lanes l LEFT JOIN lane_pairs p ON p.a = l.lane_id AND p.year_trimester = l.year_trimester GROUP BY 1, 2""")
def lane_connections(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.intersection_counts(v.lane_state(spark, folder), ["year_trimester"], "lane_id", count_copies=True)


@register("network_metrics", "A8 A9 J5 Q8", """
SELECT year_trimester, total_lanes, round(total_length_meters, 3) AS total_length_meters, connected_lanes, isolated_lanes,
  round(connectivity_ratio, 6) AS connectivity_ratio FROM network_metrics""")
def network_metrics(spark: SparkSession, folder: str) -> DataFrame:
    m = lane_plans.network_metrics(v.lane_state(spark, folder))
    return rounded(rounded(m, 3, "total_length_meters"), 6, "connectivity_ratio")


@register("tract_connectivity", "J6 A11", """
SELECT census_tract_id, year_trimester, round(CAST(sum(c) AS DOUBLE) / count(*), 6) AS connectivity_score FROM tract_links GROUP BY 1, 2""")
def tract_connectivity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(lane_plans.tract_connectivity(_lane_tract(spark, folder), v.lane_state(spark, folder)), 6, "connectivity_score")


@register("tract_metrics", "A10 A11 A12 Q8", """
SELECT census_tract_id, year_trimester, total_lanes, round(total_lane_length, 2) AS total_lane_length, round(coverage_score, 5) AS coverage_score,
  round(connectivity_score, 5) AS connectivity_score, round(network_quality_score, 5) AS network_quality_score FROM tract_metrics""")
def tract_metrics(spark: SparkSession, folder: str) -> DataFrame:
    m = rounded(_tract_metrics(spark, folder), 2, "total_lane_length")
    return rounded(m, 5, "coverage_score", "connectivity_score", "network_quality_score")


@register("lane_coverage", "Q9 J24 O1", """
SELECT census_tract_id, neighbourhood_name, district_name, year_trimester, year, trimester, round(total_lane_length, 2) AS total_lane_length,
  round(coverage_score, 5) AS coverage_score FROM tract_metrics JOIN location USING (census_tract_id) JOIN trimesters USING (year_trimester)""")
def lane_coverage(spark: SparkSession, folder: str) -> DataFrame:
    k = indicators.lane_coverage(_tract_metrics(spark, folder), v.location(spark, folder), _trimesters(spark, folder))
    return rounded(rounded(k, 2, "total_lane_length"), 5, "coverage_score")


@register("best_tracts", "O2 J24", """
SELECT census_tract_id, district_name, year_trimester, round(network_quality_score, 5) AS network_quality_score FROM tract_metrics JOIN location USING (census_tract_id)
ORDER BY round(network_quality_score, 6) DESC, census_tract_id, year_trimester LIMIT 5""")
def best_tracts(spark: SparkSession, folder: str) -> DataFrame:
    m = _tract_metrics(spark, folder).join(v.location(spark, folder).select("census_tract_id", "district_name"), "census_tract_id")
    top = m.orderBy(F.round("network_quality_score", 6).desc(), "census_tract_id", "year_trimester").limit(5)
    return rounded(top.select("census_tract_id", "district_name", "year_trimester", "network_quality_score"), 5, "network_quality_score")


@register("lane_connectivity", "Q10 J24 O1", """
SELECT year_trimester, year, trimester, total_lanes, connected_lanes, isolated_lanes, round(connectivity_ratio, 6) AS connectivity_score
FROM network_metrics JOIN trimesters USING (year_trimester)""")
def lane_connectivity(spark: SparkSession, folder: str) -> DataFrame:
    k = indicators.lane_connectivity(lane_plans.network_metrics(v.lane_state(spark, folder)), _trimesters(spark, folder))
    return rounded(k, 6, "connectivity_score")


@register("lane_accessibility", "Q11 J7 J8 G2 G7 G9 P20", """
SELECT census_tract_id, neighbourhood_name, district_name, year_trimester, year, trimester, round(metres, 3) AS min_distance_meters,
  round(CASE WHEN metres IS NULL THEN 0 ELSE 1 / (1 + metres / 1000) END, 6) AS accessibility_score FROM nearest JOIN location USING (census_tract_id)""")
def lane_accessibility(spark: SparkSession, folder: str) -> DataFrame:
    k = indicators.lane_accessibility(v.location(spark, folder), _trimesters(spark, folder), v.lane_state(spark, folder))
    return rounded(rounded(k, 3, "min_distance_meters"), 6, "accessibility_score")


@register("accessibility_report", "Q11 O2", """
SELECT census_tract_id, year_trimester, round(CASE WHEN metres IS NULL THEN 0 ELSE 1 / (1 + metres / 1000) END, 6) AS accessibility_score FROM nearest
ORDER BY year_trimester, CASE WHEN metres IS NULL THEN 0 ELSE 1 / (1 + metres / 1000) END DESC, census_tract_id LIMIT 1000""")
def accessibility_report(spark: SparkSession, folder: str) -> DataFrame:
    k = indicators.lane_accessibility(v.location(spark, folder), _trimesters(spark, folder), v.lane_state(spark, folder), top=1000)
    return rounded(k.select("census_tract_id", "year_trimester", "accessibility_score"), 6, "accessibility_score")


@register("yearly_access", "J9 G10 A23 P20", """
SELECT census_tract_id, year, round(avg(CASE WHEN knn_metres IS NULL THEN 0 ELSE 1 / (1 + knn_metres / 1000) END), 6) AS accessibility_score FROM nearest GROUP BY 1, 2""")
def yearly_access(spark: SparkSession, folder: str) -> DataFrame:
    a = studies.yearly_access(v.location(spark, folder), _trimesters(spark, folder), v.lane_state(spark, folder))
    return rounded(a, 6, "accessibility_score")


@register("yearly_lane_scores", "A23 P13", """
SELECT census_tract_id, CAST(left(year_trimester, 4) AS INTEGER) AS year, round(avg(coverage_score), 5) AS coverage_score, round(avg(connectivity_score), 5) AS connectivity_score
FROM tract_metrics GROUP BY 1, 2""")
def yearly_lane_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(studies.yearly_lane_scores(_tract_metrics(spark, folder)), 5, "coverage_score", "connectivity_score")


_PROFILE = """SELECT p.census_tract_id, p.year, population, income_euros, cs AS coverage_score, ks AS connectivity_score, acc AS accessibility_score
FROM population_income p LEFT JOIN (SELECT census_tract_id, CAST(left(year_trimester, 4) AS INTEGER) AS year, avg(coverage_score) AS cs, avg(connectivity_score) AS ks
  FROM tract_metrics GROUP BY 1, 2) b ON b.census_tract_id = p.census_tract_id AND b.year = p.year
LEFT JOIN (SELECT census_tract_id, year, avg(CASE WHEN knn_metres IS NULL THEN 0 ELSE 1 / (1 + knn_metres / 1000) END) AS acc FROM nearest GROUP BY 1, 2) a
  ON a.census_tract_id = p.census_tract_id AND a.year = p.year"""


def _profile(spark: SparkSession, folder: str) -> DataFrame:
    access = studies.yearly_access(v.location(spark, folder), _trimesters(spark, folder), v.lane_state(spark, folder))
    return studies.yearly_profile(v.population_income(spark, folder), studies.yearly_lane_scores(_tract_metrics(spark, folder)), access)


@register("yearly_profile", "J19 Q15", f"""
SELECT census_tract_id, year, population, income_euros, round(coverage_score, 5) AS coverage_score, round(connectivity_score, 5) AS connectivity_score,
  round(accessibility_score, 5) AS accessibility_score FROM ({_PROFILE})""")
def yearly_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_profile(spark, folder), 5, "coverage_score", "connectivity_score", "accessibility_score")


_CORR = " UNION ALL ".join(
    f"SELECT year, '{a}' AS a, '{b}' AS b, count(*) AS n, CASE WHEN var_pop({a}) > 0 AND var_pop({b}) > 0 THEN corr({a}, {b}) END AS r FROM full_rows GROUP BY year"
    for i, a in enumerate(studies.STUDY_COLUMNS) for b in studies.STUDY_COLUMNS[i + 1:])


@register("correlation_study", "A26 F9 F12 Q15", f"""
WITH full_rows AS (SELECT * FROM ({_PROFILE}) WHERE income_euros IS NOT NULL AND coverage_score IS NOT NULL AND accessibility_score IS NOT NULL
  AND population IS NOT NULL AND connectivity_score IS NOT NULL)
SELECT year, a, b, n, round(r, 5) AS r FROM ({_CORR}) WHERE n >= 3""")
def correlation_study(spark: SparkSession, folder: str) -> DataFrame:
    """Coefficients of the study; p-values are checked against brute force in the tests."""
    return rounded(studies.correlation_study(_profile(spark, folder)).select("year", "a", "b", "n", "r"), 5, "r")


# Two-sided chance of a larger coefficient. For whole degrees of freedom the t distribution is a finite sum
# of powers of the cosine of the angle whose sine is the coefficient; the terms differ for even and odd.
_TAIL = """CASE WHEN n = 2 OR r IS NULL OR isnan(r) THEN NULL WHEN n % 2 = 0
  THEN 1 - abs(r) * list_sum(list_transform(range((n - 2) // 2), lambda k: exp(lgamma(2e0 * k + 1) - 2 * lgamma(k + 1e0) - k * ln(4e0)) * pow(greatest(1 - r * r, 0), k)))
  ELSE 1 - 2 / pi() * (asin(least(abs(r), 1)) + abs(r) * sqrt(greatest(1 - r * r, 0)) * coalesce(list_sum(list_transform(range((n - 3) // 2),
    lambda k: exp(k * ln(4e0) + 2 * lgamma(k + 1e0) - lgamma(2e0 * k + 2)) * pow(greatest(1 - r * r, 0), k))), 0)) END"""
_PAIRS = len(studies.STUDY_COLUMNS) * (len(studies.STUDY_COLUMNS) - 1) // 2


@register("correlation_significance", "A26 Q15", f"""
WITH full_rows AS (SELECT * FROM ({_PROFILE}) WHERE income_euros IS NOT NULL AND coverage_score IS NOT NULL AND accessibility_score IS NOT NULL
  AND population IS NOT NULL AND connectivity_score IS NOT NULL),
c AS (SELECT * FROM ({_CORR}) WHERE n >= 3),
t AS (SELECT year, a, b, n, r, {_TAIL} AS p FROM c),
j AS (SELECT *, least(1e0, p * {_PAIRS}) AS p_adj FROM t)
SELECT year, a, b, n, round(r, 6) AS r, round(p, 6) AS p, round(p_adj, 6) AS p_adj, coalesce(p_adj < 0.05, false) AS significant,
  CASE WHEN p_adj < 0.05 THEN round(r, 6) END AS r_masked FROM j""")
def correlation_significance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(studies.correlation_study(_profile(spark, folder)), 6, "r", "p", "p_adj", "r_masked")


@register("district_coverage", "A22 J20", """
SELECT district_name, year, round(avg(coverage_score), 5) AS avg_coverage_score FROM tract_metrics JOIN location USING (census_tract_id) JOIN trimesters USING (year_trimester) GROUP BY 1, 2""")
def district_coverage(spark: SparkSession, folder: str) -> DataFrame:
    c = studies.coverage_by(_tract_metrics(spark, folder), v.location(spark, folder), _trimesters(spark, folder), "district_name")
    named = c.join(v.districts(spark, folder).select(F.col("nom").alias("district_name")), "district_name")
    return rounded(named, 5, "avg_coverage_score")


@register("neighbourhood_coverage", "A22 J14 J7 P30", """
SELECT n.neighbourhood_name, y.year, round(coalesce(avg(coverage_score), 0), 5) AS avg_coverage_score
FROM (SELECT DISTINCT neighbourhood_name FROM location) n CROSS JOIN (SELECT DISTINCT year FROM trimesters) y
LEFT JOIN (SELECT neighbourhood_name, year, coverage_score FROM tract_metrics JOIN location USING (census_tract_id) JOIN trimesters USING (year_trimester)) m
  ON m.neighbourhood_name = n.neighbourhood_name AND m.year = y.year GROUP BY 1, 2""")
def neighbourhood_coverage(spark: SparkSession, folder: str) -> DataFrame:
    tri = _trimesters(spark, folder)
    c = studies.coverage_by(_tract_metrics(spark, folder), v.location(spark, folder), tri, "neighbourhood_name")
    names = v.neighbourhoods(spark, folder).select(F.col("nom").alias("neighbourhood_name"))
    return rounded(studies.coverage_grid(c, names, tri, "neighbourhood_name"), 5, "avg_coverage_score")


@register("grid_density", "J21 G15 F10 G4", """
WITH b AS (SELECT least(min(x0), min(x1), min(x2)) AS x, least(min(y0), min(y1), min(y2)) AS y, greatest(max(x0), max(x1), max(x2)) AS xx, greatest(max(y0), max(y1), max(y2)) AS yy FROM lanes),
g AS (SELECT cx AS cell_x, cy AS cell_y, b.x + cx * 0.01e0 AS gx, b.y + cy * 0.01e0 AS gy FROM b, (SELECT unnest(range(60)) AS cx), (SELECT unnest(range(60)) AS cy)
  WHERE b.x + cx * 0.01e0 < b.xx AND b.y + cy * 0.01e0 < b.yy),
s AS (SELECT lane_id || '@' || year_trimester AS id, ax, ay, ex, ey, ex - ax AS dx, ey - ay AS dy FROM pieces),
c AS (SELECT cell_x, cell_y, id, greatest(0e0, CASE WHEN dx = 0 THEN 0e0 ELSE least((gx - ax) / dx, (gx + 0.01e0 - ax) / dx) END, CASE WHEN dy = 0 THEN 0e0 ELSE least((gy - ay) / dy, (gy + 0.01e0 - ay) / dy) END) AS t0,
  least(1e0, CASE WHEN dx = 0 THEN 1e0 ELSE greatest((gx - ax) / dx, (gx + 0.01e0 - ax) / dx) END, CASE WHEN dy = 0 THEN 1e0 ELSE greatest((gy - ay) / dy, (gy + 0.01e0 - ay) / dy) END) AS t1
  FROM g, s WHERE least(ax, ex) <= gx + 0.01e0 AND greatest(ax, ex) >= gx AND least(ay, ey) <= gy + 0.01e0 AND greatest(ay, ey) >= gy)
SELECT cell_x, cell_y, count(DISTINCT id) AS line_count FROM c WHERE t0 <= t1 GROUP BY 1, 2""")
def grid_density(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.grid_density(_drawn(spark, folder), "lane_id").select("cell_x", "cell_y", "line_count")


def _point_piece(px: str, py: str) -> str:
    mx = f"(6378137e0 * cos(radians({py})) / sqrt(1e0 - 0.006694379990141317e0 * pow(sin(radians({py})), 2)))"
    my = f"(6378137e0 * 0.9933056200098587e0 / pow(1e0 - 0.006694379990141317e0 * pow(sin(radians({py})), 2), 1.5e0))"
    t = (f"greatest(0e0, least(1e0, (({px} - ax) * {mx} * (ex - ax) * {mx} + ({py} - ay) * {my} * (ey - ay) * {my}) "
         f"/ (pow((ex - ax) * {mx}, 2) + pow((ey - ay) * {my}, 2))))")
    return distance(px, py, f"ax + {t} * (ex - ax)", f"ay + {t} * (ey - ay)")


@register("isolated_lanes", "J22 G16 G17", f"""
WITH w AS ({_WHOLE}), s AS ({_MIXED}),
e AS (SELECT id AS lane, x0 AS px, y0 AS py FROM w UNION ALL SELECT id, x2, y2 FROM w)
SELECT w.id AS lane_id, w.id NOT IN (SELECT lane FROM e JOIN s ON lane <> id AND abs(ax - px) < 0.1e0 AND abs(ay - py) < 0.1e0 AND {_point_piece('px', 'py')} <= 10) AS is_isolated FROM w""")
def isolated_lanes(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.isolated_lines(_drawn(spark, folder), "lane_id")


@register("intersection_counts", "J23 G21 G4", f"""
WITH w AS ({_WHOLE}), s AS ({_MIXED}), p AS (SELECT DISTINCT s.id AS a, t.id AS b FROM s JOIN s t ON s.id <> t.id AND {pieces_meet('s', 't')})
SELECT w.id AS lane_id, count(o.id) AS intersection_count FROM w LEFT JOIN p ON p.a = w.id
LEFT JOIN w o ON o.id = p.b AND (o.x0, o.y0, o.x1, o.y1, o.x2, o.y2) <> (w.x0, w.y0, w.x1, w.y1, w.x2, w.y2) GROUP BY 1""")
def intersection_counts(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.intersection_counts(_drawn(spark, folder), [], "lane_id").withColumnRenamed("partners", "intersection_count")


@register("lane_topology", "Q16 J22 J23", f"""
WITH w AS ({_WHOLE}), s AS ({_MIXED}), p AS (SELECT DISTINCT s.id AS a, t.id AS b FROM s JOIN s t ON s.id <> t.id AND {pieces_meet('s', 't')}),
e AS (SELECT id AS lane, x0 AS px, y0 AS py FROM w UNION ALL SELECT id, x2, y2 FROM w),
near AS (SELECT DISTINCT lane FROM e JOIN s ON lane <> id AND abs(ax - px) < 0.1e0 AND abs(ay - py) < 0.1e0 AND {_point_piece('px', 'py')} <= 10)
SELECT w.id AS lane_id, count(o.id) AS intersection_count, w.id NOT IN (SELECT lane FROM near) AS is_isolated FROM w LEFT JOIN p ON p.a = w.id
LEFT JOIN w o ON o.id = p.b AND (o.x0, o.y0, o.x1, o.y1, o.x2, o.y2) <> (w.x0, w.y0, w.x1, w.y1, w.x2, w.y2) GROUP BY 1""")
def lane_topology(spark: SparkSession, folder: str) -> DataFrame:
    return studies.lane_topology(_drawn(spark, folder))


def _utm(x: str, y: str) -> tuple[str, str]:
    """Easting and northing as SQL, by the published transverse Mercator series."""
    s = f"sin(radians({y}))"
    e = 0.08181919084262149
    t = f"sinh(atanh({s}) - {e!r}e0 * atanh({e!r}e0 * {s}))"
    lam = f"radians({x} - 3e0)"
    xi, eta = f"atan2({t}, cos({lam}))", f"atanh(sin({lam}) / sqrt(1e0 + {t} * {t}))"
    k = 0.9996 * geodesy._RECTIFYING
    north = f"{xi}" + "".join(f" + {a!r}::DOUBLE * sin({2 * j}e0 * {xi}) * cosh({2 * j}e0 * {eta})" for j, a in enumerate(geodesy._ALPHA, 1))
    east = f"{eta}" + "".join(f" + {a!r}::DOUBLE * cos({2 * j}e0 * {xi}) * sinh({2 * j}e0 * {eta})" for j, a in enumerate(geodesy._ALPHA, 1))
    return f"(500000e0 + {k!r}::DOUBLE * ({east}))", f"({k!r}::DOUBLE * ({north}))"


_U = [_utm(f"x{i}", f"y{i}") for i in range(3)]
_C = _utm("2.17e0", "41.387e0")
_FLAT = f"""SELECT *, sqrt(pow(u1 - u0, 2) + pow(v1 - v0, 2)) AS d1, sqrt(pow(u2 - u1, 2) + pow(v2 - v1, 2)) AS d2 FROM (
SELECT id, x0, y0, x2, y2, {", ".join(f"{u} AS u{i}, {w} AS v{i}" for i, (u, w) in enumerate(_U))}, {_C[0]} AS cu, {_C[1]} AS cv FROM ({_WHOLE}))"""
_AWAY = "sqrt(pow((d1 * (u0 + u1) / 2 + d2 * (u1 + u2) / 2) / (d1 + d2) - cu, 2) + pow((d1 * (v0 + v1) / 2 + d2 * (v1 + v2) / 2) / (d1 + d2) - cv, 2))"
_LANE_PROFILE = f"""SELECT id, d1 + d2 AS len, (d1 + d2) / sqrt(pow(u2 - u0, 2) + pow(v2 - v0, 2)) AS sinuosity,
  (degrees(atan2(x2 - x0, y2 - y0)) + 360e0) % 360e0 AS bearing, {_AWAY} AS away FROM ({_FLAT})"""
_BIN = """CASE WHEN away <= 0 THEN NULL WHEN away <= 1000 THEN '0-1km' WHEN away <= 2000 THEN '1-2km' WHEN away <= 3000 THEN '2-3km'
  WHEN away <= 4000 THEN '3-4km' WHEN away <= 5000 THEN '4-5km' ELSE '5km+' END"""


@register("lane_profile", "Q16 G13 G17 G18 G19 P25", f"""
SELECT id AS lane_id, round(len, 4) AS length_meters, 3 AS num_points, round(sinuosity, 6) AS sinuosity, round(bearing, 6) AS bearing,
  (['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'])[CAST(round_even(bearing / 45e0, 0) AS INTEGER) % 8 + 1] AS direction,
  round(away, 4) AS dist_to_center, {_BIN} AS dist_bin FROM ({_LANE_PROFILE})""")
def lane_profile(spark: SparkSession, folder: str) -> DataFrame:
    p = studies.lane_profile(_drawn(spark, folder))
    return rounded(rounded(p, 4, "length_meters", "dist_to_center"), 6, "sinuosity", "bearing")


@register("distance_summary", "A32 P25 Q16", f"""
SELECT {_BIN} AS dist_bin, round(sum(len), 3) AS sum_length, round(avg(len), 4) AS mean_length, count(*) AS n_lanes FROM ({_LANE_PROFILE}) WHERE away > 0 GROUP BY 1""")
def distance_summary(spark: SparkSession, folder: str) -> DataFrame:
    s = studies.distance_summary(studies.lane_profile(_drawn(spark, folder)))
    return rounded(rounded(s, 3, "sum_length"), 4, "mean_length")


@register("longest_and_shortest", "W9", """
SELECT * FROM (SELECT 'longest' AS which, lane_id, round(length_meters, 4) AS length_meters FROM lane_state ORDER BY round(length_meters, 6) DESC, lane_id, year_trimester LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'shortest', lane_id, round(length_meters, 4) FROM lane_state ORDER BY round(length_meters, 6), lane_id, year_trimester LIMIT 1)""")
def longest_and_shortest(spark: SparkSession, folder: str) -> DataFrame:
    s = rounded(v.lane_state(spark, folder).select("lane_id", "year_trimester", "length_meters"), 6, "length_meters")
    ends = [history.arg_extreme(s, "length_meters", ["lane_id", "year_trimester"], big).withColumn("which", F.lit(name))
            for name, big in (("longest", True), ("shortest", False))]
    return rounded(ends[0].union(ends[1]).select("which", "lane_id", "length_meters"), 4, "length_meters")


@register("projected_vertices", "G12", f"""
SELECT id AS lane_id, round({_U[0][0]}, 3) AS easting, round({_U[0][1]}, 3) AS northing, round(6378137e0 * radians(x0), 3) AS web_x,
  round(6378137e0 * ln(tan(pi() / 4 + radians(y0) / 2)), 3) AS web_y, round(x0, 9) AS back_x, round(y0, 9) AS back_y FROM ({_WHOLE})""")
def projected_vertices(spark: SparkSession, folder: str) -> DataFrame:
    """First vertex of every lane in UTM and Web Mercator, and brought back from UTM."""
    p = g.start_point(F.col("geometry"))
    utm, web = geodesy.utm_from_lonlat(p), geodesy.web_mercator_from_lonlat(p)
    back = geodesy.lonlat_from_utm(utm)
    rows = _drawn(spark, folder).select(
        "lane_id", utm["x"].alias("easting"), utm["y"].alias("northing"), web["x"].alias("web_x"), web["y"].alias("web_y"),
        back["x"].alias("back_x"), back["y"].alias("back_y"))
    return rounded(rounded(rows, 3, "easting", "northing", "web_x", "web_y"), 9, "back_x", "back_y")


_EDGES = """SELECT neighbourhood_code, district_code, x0, y0, x1, y1, unnest([struct_pack(c := 'w', a := i, b := j), struct_pack(c := 's', a := i, b := j),
  struct_pack(c := 'w', a := i + 1, b := j), struct_pack(c := 's', a := i, b := j + 1)]) AS e
FROM (SELECT t.*, c.i, c.j FROM tracts t JOIN cells c ON c.c_custkey = t.census_tract_id % 10000000)"""


@register("area_outlines", "A38 Q14", f"""
WITH e AS ({_EDGES}), o AS (SELECT district_code, neighbourhood_code, e FROM e GROUP BY ALL HAVING count(*) = 1),
p AS (SELECT district_code, neighbourhood_code, sum(CASE WHEN e.c = 'w' THEN 0.003e0 ELSE 0.004e0 END) AS outline FROM o GROUP BY 1, 2),
a AS (SELECT district_code, neighbourhood_code, sum((x1 - x0) * (y1 - y0)) AS area FROM tracts GROUP BY 1, 2)
SELECT district_code, neighbourhood_code, CAST(1 AS BIGINT) AS n_parts, round(area, 9) AS area, round(outline, 7) AS outline FROM a JOIN p USING (district_code, neighbourhood_code)""")
def area_outlines(spark: SparkSession, folder: str) -> DataFrame:
    """Merged outlines per neighbourhood: number of parts, area and outline length in degrees."""
    parts = d.dissolve(v.location(spark, folder).select("district_code", "neighbourhood_code", "geometry"), ["district_code", "neighbourhood_code"])
    ring = F.col("geometry")[0]
    return parts.groupBy("district_code", "neighbourhood_code").agg(
        F.count(F.lit(1)).alias("n_parts"), F.round(F.sum(g.polygon_area(F.col("geometry"))), 9).alias("area"),
        F.round(F.sum(g.line_length(ring)), 7).alias("outline"))


@register("whole_outline", "A38", f"""
WITH e AS ({_EDGES}), o AS (SELECT e FROM e GROUP BY ALL HAVING count(*) = 1)
SELECT (SELECT round(sum((x1 - x0) * (y1 - y0)), 8) FROM tracts) AS area, round(sum(CASE WHEN e.c = 'w' THEN 0.003e0 ELSE 0.004e0 END), 7) AS outline FROM o""")
def whole_outline(spark: SparkSession, folder: str) -> DataFrame:
    """All tracts merged into one area, holes included."""
    parts = d.dissolve(v.location(spark, folder).select(F.lit("all").alias("area_name"), "geometry"), ["area_name"])
    rings = F.aggregate("geometry", F.lit(0.0), lambda s, r: s + g.line_length(r))
    return parts.agg(F.round(F.sum(g.polygon_area(F.col("geometry"))), 8).alias("area"), F.round(F.sum(rings), 7).alias("outline"))


_ZONES = """SELECT s_nationkey % 5 AS zone_id, (s_suppkey * 37) % 200 AS i, (s_suppkey * 53) % 200 AS j, 10 + s_suppkey % 31 AS w, 10 + (s_suppkey * 7) % 23 AS h FROM supplier"""


@register("service_zones", "A38", f"""
WITH b AS ({_ZONES}), u AS (SELECT zone_id, i, j, h, unnest(range(w)) AS dx FROM b),
c AS (SELECT DISTINCT zone_id, i + dx AS x, j + dy AS y FROM (SELECT *, unnest(range(h)) AS dy FROM u)),
s AS (SELECT c.zone_id, c.x, c.y, count(d.x) AS n FROM c LEFT JOIN c d ON d.zone_id = c.zone_id AND abs(d.x - c.x) + abs(d.y - c.y) = 1 GROUP BY 1, 2, 3)
SELECT CAST(zone_id AS BIGINT) AS zone_id, round(count(*) * 1e-6, 9) AS area, round(CAST(sum(4 - n) AS DOUBLE) * 1e-3, 7) AS outline FROM s GROUP BY 1""")
def service_zones(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping service boxes of suppliers merged per zone: area and length of all outlines, holes included."""
    b = spark.sql(_ZONES.replace("FROM supplier", "FROM {supplier}"), supplier=v.table(spark, folder, "supplier"))
    at = lambda c: F.col(c) / 1000.0
    boxes = b.select(F.col("zone_id").cast("long").alias("zone_id"), g.box(
        2.0 + at("i"), 41.3 + at("j"), 2.0 + at("i") + at("w"), 41.3 + at("j") + at("h")).alias("geometry"))
    parts = d.dissolve(boxes, ["zone_id"])
    rings = F.aggregate("geometry", F.lit(0.0), lambda s, r: s + g.line_length(r))
    return parts.groupBy("zone_id").agg(F.round(F.sum(g.polygon_area(F.col("geometry"))), 9).alias("area"), F.round(F.sum(rings), 7).alias("outline"))


@register("simplified_outlines", "G14 A38 G22 Q14", f"""
WITH e AS ({_EDGES}), o AS (SELECT district_code, e FROM e GROUP BY ALL HAVING count(*) = 1),
p AS (SELECT district_code, sum(CASE WHEN e.c = 'w' THEN 0.003e0 ELSE 0.004e0 END) AS outline FROM o GROUP BY 1),
a AS (SELECT district_code, sum((x1 - x0) * (y1 - y0)) AS area FROM tracts GROUP BY 1)
SELECT district_code, district_name, round(area, 9) AS area, round(outline, 7) AS outline, true AS fewer_vertices FROM a JOIN p USING (district_code)
JOIN (SELECT DISTINCT district_code, district_name FROM location) USING (district_code)""")
def simplified_outlines(spark: SparkSession, folder: str) -> DataFrame:
    """The largest part of each simplified outline. Its border runs straight between corners, so area and length stay
    while the vertices along it go."""
    keys = ["district_code", "district_name"]
    location = v.location(spark, folder)
    merged = checkpointed(frames.merged_areas(location, "district"))
    big, full = (d.largest_part(frames.area_shapes(location, "district", tolerance=t, merged=merged), keys) for t in (0.0001, None))
    before = full.select(*keys, F.size(F.col("geometry")[0]).alias("n"))
    ring = F.col("geometry")[0]
    return big.join(before, keys).select(*keys, F.round(g.polygon_area(F.col("geometry")), 9).alias("area"),
                                         F.round(g.line_length(ring), 7).alias("outline"), (F.size(ring) < F.col("n")).alias("fewer_vertices"))


@register("map_extent", "A39 G20", """
SELECT round(min(x0), 9) AS xmin, round(min(y0), 9) AS ymin, round(max(x1), 9) AS xmax, round(max(y1), 9) AS ymax,
  round(avg((y0 + y1) / 2), 7) AS lat, round(avg((x0 + x1) / 2), 7) AS lon FROM tracts""")
def map_extent(spark: SparkSession, folder: str) -> DataFrame:
    t = v.tracts(spark, folder)
    row = d.extent(t).withColumn("c", d.map_centre(t).select(F.struct("lat", "lon")).scalar()).select(
        "xmin", "ymin", "xmax", "ymax", "c.lat", "c.lon")
    return rounded(rounded(row, 9, "xmin", "ymin", "xmax", "ymax"), 7, "lat", "lon")


@register("centroid_lookup", "A40 G2", """
SELECT census_tract_id AS code, neighbourhood_name AS name, round((y0 + y1) / 2, 8) AS lat, round((x0 + x1) / 2, 8) AS lng FROM location""")
def centroid_lookup(spark: SparkSession, folder: str) -> DataFrame:
    loc = v.location(spark, folder).select(F.col("census_tract_id").alias("code"), F.col("neighbourhood_name").alias("name"), "geometry")
    return rounded(d.centroid_lookup(loc, "code", "name"), 8, "lat", "lng")
