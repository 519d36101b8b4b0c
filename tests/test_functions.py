"""Scalar functions against hand-worked values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from velomesh.functions import calendar as cal, geodesy, geometry as g, measures, parsing as p


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_guarded_parsing(spark):
    row = one(spark, p.na_to_null(F.lit("NA")), p.guarded_int(F.lit("12")), p.guarded_int(F.lit("-3")),
              p.guarded_decimal(F.lit("-3")), p.guarded_decimal(F.lit("1e3")), p.guarded_decimal(F.lit("NA")),
              p.guarded_int(F.lit("99999999999")))
    assert tuple(row) == (None, 12, None, -3.0, None, None, None)


def test_instants(spark):
    want = dt.datetime(2020, 1, 2, 21, 20)
    row = one(spark, *[p.parse_instant(F.lit(t)) for t in ("1578000000", "1.578e+09", "2020-01-02 21:20:00", "later")])
    assert tuple(row) == (want, want, want, None)


@pytest.mark.parametrize("text,want", [
    ("1578000000", dt.datetime(2020, 1, 2, 21, 20)),
    ("2020-01-02T21:20:00.25Z", dt.datetime(2020, 1, 2, 21, 20, 0, 250000)),
    ("2020-01-02T21:20:05Z", dt.datetime(2020, 1, 2, 21, 20, 5)),
    ("2020-01-02 21:20:05.5", dt.datetime(2020, 1, 2, 21, 20, 5, 500000)),
    ("2/1/2020 21:20", dt.datetime(2020, 1, 2, 21, 20)),
    ("2020-01-02", None), ("", None)])
def test_sampling_times(spark, text, want):
    assert one(spark, p.parse_sampling_time(F.lit(text)))[0] == want


def test_dates_codes_and_texts(spark):
    row = one(spark, p.compact_date(F.lit("20200231")), p.compact_date(F.lit("20200229")),
              p.tract_code_from_boundary(F.lit("01"), F.lit("001")), p.tract_code_from_income(F.lit("1"), F.lit("1")),
              p.tract_code_from_boundary(F.lit("10"), F.lit("001")), p.tract_code_from_income(F.lit("10"), F.lit("1")),
              p.tract_code_from_income(F.lit("1"), F.lit("1001")),
              p.lane_location(F.lit("Carril bici bidireccional - C. Example")),
              p.lane_type(F.lit("Carril bici bidireccional - C. Example")), p.lane_type(F.lit("Via verda")),
              p.lane_location(F.lit("x Carril bici unidireccional Carril bici bidireccional y")))
    assert tuple(row) == (None, dt.date(2020, 2, 29), 1001, 1001, 10001, 10001, 1100, "C. Example", "bidirectional",
                          "unknown", "x Carril bici bidireccional y")


def test_calendar(spark):
    ts = F.lit("2019-06-22 17:39:59").cast("timestamp_ntz")
    row = one(spark, cal.time_floor(ts), cal.day_part(ts), cal.year_trimester(F.lit(None).cast("int"), F.lit("2")),
              cal.trimester_year(F.lit("2019-2")), cal.ordinal_date_label(ts), cal.hour_fraction(ts))
    assert row[0] == dt.datetime(2019, 6, 22, 17, 30)
    assert row[1:4] == ("evening", "-2", 2019)
    assert row[4] == "Saturday, 22nd of June, 2019" and row[5] == pytest.approx(17.65)


@pytest.mark.parametrize("bikes,docks,ebikes,mech,want", [
    (10, 10, 4, 6, (50, 40, 60)), (0, 20, 0, 0, (0, 0, 0)), (0, 0, 0, 0, (0, 0, 0)), (None, 5, None, None, (0, 0, 0))])
def test_percentages(spark, bikes, docks, ebikes, mech, want):
    b, d, e, m = (F.lit(v).cast("int") for v in (bikes, docks, ebikes, mech))
    row = one(spark, measures.availability_pct(b, d), measures.share_or_zero(e, b), measures.share_or_zero(m, b))
    assert tuple(row) == pytest.approx(want)


@pytest.mark.parametrize("income,service,want", [
    (100, 10, "Fair Distribution"), (110, 9, "Fair Distribution"), (100, 12, "Moderate Distribution"),
    (80, 8, "Potential Underservice"), (120, 12, "Privileged Access"), (80, 12, "Good Service Despite Low Income"),
    (120, 8, "Poor Service Despite High Income")])
def test_equity(spark, income, service, want):
    c = measures.equity_class(F.lit(float(income)), F.lit(100.0), F.lit(float(service)), F.lit(10.0))
    assert one(spark, c)[0] == want


@pytest.mark.parametrize("metres,want", [(0.0, None), (1000.0, "0-1km"), (1000.01, "1-2km"), (5000.01, "5km+"), (None, None)])
def test_distance_bins(spark, metres, want):
    assert one(spark, measures.distance_bin(F.lit(metres).cast("double")))[0] == want


@pytest.mark.parametrize("bearing,want", [(22.4, "N"), (22.6, "NE"), (67.5, "E"), (112.5, "E"), (180.0, "S"), (359.0, "N")])
def test_sectors(spark, bearing, want):
    assert one(spark, g.cardinal(F.lit(bearing)))[0] == want


def test_labels(spark):
    row = one(spark, measures.thousands(F.lit(1234567.5)), measures.thousands(F.lit(12.0)), measures.quote_escape(F.lit("l'H")),
              measures.fill_status(F.lit(3), F.lit(0)), measures.fill_status(F.lit(10), F.lit(20)))
    assert tuple(row) == ("1,234,567.5", "12.0", "l\\'H", "Low availability", "Good availability")


def pt(x, y):
    return g.point(F.lit(x), F.lit(y))


def line(*xy):
    return F.array(*[pt(float(x), float(y)) for x, y in xy])


def test_lengths_match_the_spheroid(spark):
    row = one(spark, geodesy.line_length_m(line((2.105, 41.405), (2.115, 41.405))),
              geodesy.line_length_m(line((2.1075, 41.402), (2.1075, 41.408))),
              geodesy.line_length_m(line((2.112, 41.401), (2.112, 41.403))))
    assert tuple(row) == pytest.approx((836.1807, 666.3705, 222.1234), abs=1e-3)


def test_projection_round_trip(spark):
    rows = spark.range(200).select(g.point(F.col("id") / 50.0 + 1.0, 35.0 + F.col("id") / 10.0).alias("p"))
    utm = geodesy.utm_from_lonlat(F.col("p"))
    web = geodesy.web_mercator_from_lonlat(F.col("p"))
    worst = rows.select("p", geodesy.lonlat_from_utm(utm).alias("u"), geodesy.lonlat_from_web_mercator(web).alias("w")).agg(
        *[F.max(F.abs(F.col(f"{c}.{k}") - F.col(f"p.{k}"))) for c in "uw" for k in "xy"]).first()
    assert max(worst) < 1e-9


def test_projection_known_values(spark):
    # On the central meridian the easting is the false easting and the northing the scaled arc.
    row = one(spark, geodesy.utm_from_lonlat(pt(3.0, 0.0)), geodesy.utm_from_lonlat(pt(3.0, 45.0)),
              geodesy.web_mercator_from_lonlat(pt(180.0, 0.0)))
    assert (row[0].x, row[0].y) == pytest.approx((500000, 0), abs=1e-6)
    assert row[1].x == pytest.approx(500000, abs=1e-6) and row[1].y == pytest.approx(0.9996 * 4984944.378, abs=1e-2)
    assert row[2].x == pytest.approx(math.pi * 6378137)


def test_contains_is_strict_and_respects_holes(spark):
    shell = line((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))
    hole = line((4, 4), (6, 4), (6, 6), (4, 6), (4, 4))
    poly = F.array(shell, hole)
    row = one(spark, *[g.contains(poly, pt(x, y)) for x, y in ((1.0, 1.0), (5.0, 5.0), (0.0, 5.0), (4.0, 5.0), (11.0, 5.0), (0.0, 0.0))],
              g.polygon_area(poly), g.polygon_centroid(poly))
    assert tuple(row[:6]) == (True, False, False, False, False, False)
    assert row[6] == pytest.approx(96) and (row[7].x, row[7].y) == pytest.approx((5, 5))


def edge(a, b):
    return g.edge(*[F.lit(float(v)) for v in (*a, *b)])


@pytest.mark.parametrize("a,b,c,d,want", [
    ((0, 0), (2, 2), (0, 2), (2, 0), True), ((0, 0), (1, 0), (1, 0), (2, 5), True), ((0, 0), (4, 0), (1, 0), (2, 0), True),
    ((0, 0), (1, 0), (2, 0), (3, 0), False), ((0, 0), (1, 0), (0, 1), (1, 1), False), ((0, 0), (4, 0), (2, 0), (2, 3), True),
    ((0, 0), (4, 4), (3, 0), (4, 1), False)])
def test_edges_meet(spark, a, b, c, d, want):
    assert one(spark, g.edges_meet(edge(a, b), edge(c, d)), g.edges_meet(edge(c, d), edge(b, a))) == (want, want)


def test_line_measures(spark):
    closed, single = line((2.1, 41.4), (2.2, 41.4), (2.1, 41.4)), line((2.1, 41.4))
    bent = line((0, 0), (0, 4), (4, 4))
    row = one(spark, geodesy.sinuosity(closed), geodesy.sinuosity(single), g.bearing(single), g.bearing(line((0, 0), (-1, 0))),
              g.line_centroid(bent), g.same_line(bent, F.reverse(bent)), g.line_length(bent))
    assert row[:4] == (1.0, 1.0, None, 270.0)
    assert (row[4].x, row[4].y) == pytest.approx((1, 3)) and row[5] and row[6] == 8
