"""Dimensions, facts, availability and time-based queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomesh.functions import geometry as g
from velomesh.operators import dims, history, quality
from velomesh.plans import demographics, frames, indicators, stations, studies
from velomesh.session import checkpointed
from velomesh.workload import views as v
from velomesh.workload.registry import register, rounded

DAY, SECOND = "'%Y-%m-%d'", "'%Y-%m-%d %H:%M:%S'"


@register("location_dimension", "J1 Q5 Q6", """
SELECT census_tract_id, round(census_tract_area, 6) AS census_tract_area, neighbourhood_code, neighbourhood_name, district_code,
  district_name, round(x0, 9) AS west, round(y1, 9) AS north FROM location""")
def location_dimension(spark: SparkSession, folder: str) -> DataFrame:
    corner = F.col("geometry")[0]
    loc = v.location(spark, folder).withColumn("west", corner[0]["x"]).withColumn("north", corner[2]["y"])
    return rounded(rounded(loc.drop("geometry"), 6, "census_tract_area"), 9, "west", "north")


@register("population_calendar", "P14 U3 Q6", """
SELECT DISTINCT data_referencia AS date_value, strftime(CAST(data_referencia AS DATE), '%Y-%m') AS year_month, 1 AS day, year FROM population""")
def population_calendar(spark: SparkSession, folder: str) -> DataFrame:
    c = demographics.calendar_from_population(v.population(spark, folder))
    return c["dim_day"].join(c["dim_month"].select("year_month", "year"), "year_month").select(
        "date_value", "year_month", "day", "year")


@register("population_income_fact", "J2 A7 J12 Q6", """
SELECT census_tract_id, year, population, income_euros, CAST(income_normalized AS DOUBLE) AS income_normalized FROM population_income""")
def population_income_fact(spark: SparkSession, folder: str) -> DataFrame:
    return v.population_income(spark, folder)


def _calendar(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return stations.station_calendar(v.information(spark, folder), v.status(spark, folder))


@register("hour_dimension", "U1 P15 P17 J12 Q7", f"""
SELECT strftime(h, {SECOND}) AS hour_datetime, strftime(h, {DAY}) AS date_value, CAST(year(h) AS INTEGER) AS year, CAST(month(h) AS INTEGER) AS month,
  CAST(day(h) AS INTEGER) AS day, CAST(hour(h) AS INTEGER) AS hour, CASE WHEN hour(h) BETWEEN 5 AND 11 THEN 'morning'
  WHEN hour(h) BETWEEN 12 AND 16 THEN 'afternoon' WHEN hour(h) BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END AS day_part
FROM (SELECT date_trunc('hour', last_updated) AS h FROM information UNION SELECT date_trunc('hour', last_updated) FROM ticks)""")
def hour_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return _calendar(spark, folder)["dim_hour"]


@register("ten_minute_dimension", "P16 U3 J12 Q7", f"""
SELECT DISTINCT strftime(b, {SECOND}) AS ten_min_datetime, strftime(date_trunc('hour', b), {SECOND}) AS hour_datetime, CAST(minute(b) AS INTEGER) AS minute_bucket
FROM (SELECT time_bucket(INTERVAL '10 minutes', last_updated) AS b FROM ticks)""")
def ten_minute_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return _calendar(spark, folder)["dim_ten_minute"]


@register("missing_days", "J13 S13 U4 O3", f"""
SELECT DISTINCT strftime(last_updated, {DAY}) AS date_value, strftime(last_updated, '%Y-%m') AS year_month, CAST(day(last_updated) AS INTEGER) AS day
FROM information WHERE strftime(last_updated, {DAY}) NOT IN (SELECT data_referencia FROM population)""")
def missing_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days the station feed needs and the population calendar lacks."""
    known = demographics.calendar_from_population(v.population(spark, folder))["dim_day"]
    wanted = dims.day_dim(v.information(spark, folder).select(F.col("last_updated").alias("ts")))
    return dims.missing_members(wanted, known, ["date_value"]).orderBy("date_value")


@register("extended_months", "S13 U1", """
SELECT DISTINCT strftime(t, '%Y-%m') AS year_month FROM (SELECT last_updated AS t FROM ticks UNION SELECT CAST(data_referencia AS TIMESTAMP) FROM population)""")
def extended_months(spark: SparkSession, folder: str) -> DataFrame:
    known = demographics.calendar_from_population(v.population(spark, folder))["dim_month"]
    wanted = dims.month_dim(v.status(spark, folder).select(F.col("last_updated").alias("ts")))
    return dims.extended(known, wanted, ["year_month"]).select("year_month")


@register("duplicate_stations", "F11", "SELECT station_id, count(*) AS n_rows FROM information GROUP BY 1 HAVING count(*) > 1")
def duplicate_stations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(v.information(spark, folder), ["station_id"])


@register("station_dimension", "W1 G1 Q7", "SELECT station_id, name, round(lon, 9) AS lon, round(lat, 9) AS lat, altitude FROM stations")
def station_dimension(spark: SparkSession, folder: str) -> DataFrame:
    s = v.stations(spark, folder).select("station_id", "name", F.col("geometry.x").alias("lon"), F.col("geometry.y").alias("lat"), "altitude")
    return rounded(s, 9, "lon", "lat")


@register("station_information_fact", "W2 J12 Q7", f"""
SELECT station_id, strftime(date_trunc('hour', last_updated), {SECOND}) AS hour_datetime, capacity, strftime(last_updated, {SECOND}) AS last_updated
FROM (SELECT *, row_number() OVER (PARTITION BY station_id, date_trunc('hour', last_updated) ORDER BY last_updated DESC) AS rn FROM information) WHERE rn = 1""")
def station_information_fact(spark: SparkSession, folder: str) -> DataFrame:
    return stations.fact_station_information(v.information(spark, folder), v.stations(spark, folder), _calendar(spark, folder)["dim_hour"])


@register("station_status_fact", "W4 J12 Q7", f"""
SELECT station_id, strftime(ten_min_datetime, {SECOND}) AS ten_min_datetime, num_bikes_available, mechanical_bikes, ebikes, num_docks_available,
  status, strftime(last_updated, {SECOND}) AS last_updated FROM station_status""")
def station_status_fact(spark: SparkSession, folder: str) -> DataFrame:
    buckets = _calendar(spark, folder)["dim_ten_minute"]
    return stations.fact_station_status(v.status(spark, folder), v.stations(spark, folder), buckets).drop("last_reported")


@register("row_audit", "A36", """
SELECT 'status' AS table_name, count(*) AS n_rows FROM station_status UNION ALL SELECT 'stations', count(*) FROM stations
UNION ALL SELECT 'people', count(*) FROM population_income UNION ALL SELECT 'with_income', count(income_euros) FROM population_income""")
def row_audit(spark: SparkSession, folder: str) -> DataFrame:
    people = v.population_income(spark, folder)
    return quality.row_audit({"status": v.station_status(spark, folder), "stations": v.stations(spark, folder),
                              "people": people, "with_income": people.where(F.col("income_euros").isNotNull())})


@register("hourly_reporting", "A37 J24", """
SELECT CAST(hour(last_updated) AS INTEGER) AS hour, CASE WHEN hour(last_updated) BETWEEN 5 AND 11 THEN 'morning' WHEN hour(last_updated) BETWEEN 12 AND 16 THEN 'afternoon'
  WHEN hour(last_updated) BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END AS day_part, count(DISTINCT station_id) AS stations_reporting, round(avg(capacity), 6) AS avg_capacity
FROM (SELECT *, row_number() OVER (PARTITION BY station_id, date_trunc('hour', last_updated) ORDER BY last_updated DESC) AS rn FROM information) WHERE rn = 1 GROUP BY 1, 2""")
def hourly_reporting(spark: SparkSession, folder: str) -> DataFrame:
    hours = _calendar(spark, folder)["dim_hour"]
    facts = stations.fact_station_information(v.information(spark, folder), v.stations(spark, folder), hours)
    return rounded(stations.hourly_reporting(facts, hours), 6, "avg_capacity")


def _availability_sql(level: str, code: str, where: str = "") -> str:
    return f"""SELECT {level}_name, {level}_code, strftime(ten_min_datetime, {DAY}) AS date_value, CAST(hour(ten_min_datetime) AS INTEGER) AS hour,
  strftime(ten_min_datetime, {SECOND}) AS ten_min_datetime, round(avg(pct), 6) AS avg_bike_availability, round(avg(epct), 6) AS avg_ebike_percentage,
  round(avg(mpct), 6) AS avg_mechanical_bike_percentage, CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes_available,
  CAST(sum(ebikes) AS BIGINT) AS total_ebikes, CAST(sum(mechanical_bikes) AS BIGINT) AS total_mechanical_bikes, count(DISTINCT station_id) AS station_count
FROM scored JOIN areas USING (station_id) {where} GROUP BY 1, 2, 3, 4, 5"""


_AVERAGES = ("avg_bike_availability", "avg_ebike_percentage", "avg_mechanical_bike_percentage")


@register("availability_by_district", "Q13 A17 J3 J11 P19 G3", _availability_sql("district", "district_code"))
def availability_by_district(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(v.availability(spark, folder), 6, *_AVERAGES)


@register("availability_by_neighbourhood", "Q13 A17 J3", _availability_sql("neighbourhood", "neighbourhood_code"))
def availability_by_neighbourhood(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(v.availability(spark, folder, "neighborhood"), 6, *_AVERAGES)


@register("availability_week", "Q13 F2", _availability_sql(
    "district", "district_code", "WHERE ten_min_datetime >= TIMESTAMP '2024-01-08' AND ten_min_datetime < TIMESTAMP '2024-01-15'"))
def availability_week(spark: SparkSession, folder: str) -> DataFrame:
    """The stored view of one week."""
    days = ("2024-01-08", "2024-01-14")
    week = stations.availability(v.station_status(spark, folder, *days), v.areas(spark, folder), "district", *days)
    return rounded(week, 6, *_AVERAGES)


@register("station_area", "J3 G3", "SELECT station_id, census_tract_id, district_name FROM areas")
def station_area(spark: SparkSession, folder: str) -> DataFrame:
    return v.areas(spark, folder).select("station_id", "census_tract_id", "district_name")


@register("station_stats", "A19 O4", """
SELECT station_id, round(avg(num_bikes_available), 6) AS avg_bikes_available, max(num_bikes_available) AS max_bikes, min(num_bikes_available) AS min_bikes,
  count(*) AS observations FROM ticks GROUP BY 1""")
def station_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stations.station_stats(v.status(spark, folder)), 6, "avg_bikes_available").orderBy(F.desc("avg_bikes_available"))


@register("monthly_usage", "A20 P15", f"""
SELECT station_id, strftime(date_trunc('month', last_updated), {DAY}) AS month, round(avg(num_bikes_available), 6) AS avg_bikes FROM ticks GROUP BY 1, 2""")
def monthly_usage(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stations.monthly_usage(v.status(spark, folder)), 6, "avg_bikes")


@register("listed_stations", "F5 G1", """
SELECT o_orderkey, station_id, name, lon, lat FROM information WHERE station_id IN (3, 39, 46)""")
def listed_stations(spark: SparkSession, folder: str) -> DataFrame:
    """The few stations a report looks at closely."""
    return v.information(spark, folder).where(F.col("station_id").isin(3, 39, 46)).select("o_orderkey", "station_id", "name", "lon", "lat")


@register("origin_destination", "J15 G11 Q19", """
SELECT a.station_id AS origin_station, b.station_id AS destination_station, round(a.lon, 9) AS ax, round(b.lat, 9) AS by_, count(*) AS n_pairs
FROM information a JOIN information b ON a.station_id <> b.station_id WHERE a.station_id IN (3, 39, 46) AND b.station_id IN (3, 39, 46) GROUP BY ALL""")
def origin_destination(spark: SparkSession, folder: str) -> DataFrame:
    od = stations.origin_destination(v.information(spark, folder), [3, 39, 46])
    return od.select("origin_station", "destination_station", F.round(F.col("geometry")[0]["x"], 9).alias("ax"),
                     F.round(F.col("geometry")[1]["y"], 9).alias("by_"), "n_pairs")


@register("reporting_gaps", "W6", f"""
SELECT station_id, strftime(previous, {SECOND}) AS previous, strftime(t, {SECOND}) AS last_updated, round(epoch(t - previous), 6) AS gap_s
FROM (SELECT station_id, last_updated AS t, lag(last_updated) OVER (PARTITION BY station_id ORDER BY last_updated) AS previous
  FROM (SELECT DISTINCT station_id, last_updated FROM ticks)) WHERE epoch(t - previous) > 303""")
def reporting_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(history.gaps(v.status(spark, folder), ["station_id"], "last_updated"), 6, "gap_s")


@register("even_frames", "W7", f"""
SELECT strftime(t, {DAY}) AS day, strftime(t, {SECOND}) AS ten_min_datetime FROM (SELECT t, row_number() OVER (PARTITION BY CAST(t AS DATE) ORDER BY t) - 1 AS i,
  count(*) OVER (PARTITION BY CAST(t AS DATE)) AS n FROM (SELECT DISTINCT ten_min_datetime AS t FROM view_district))
WHERE CASE WHEN n > 32 THEN i % (n // 32) = 0 AND i // (n // 32) < 32 ELSE true END""")
def even_frames(spark: SparkSession, folder: str) -> DataFrame:
    return history.even_sample(v.availability(spark, folder), "ten_min_datetime")


@register("animation_frames", "W7 Q14", f"""
SELECT district_code, strftime(ten_min_datetime, {SECOND}) AS ten_min_datetime, round(avg_bike_availability, 6) AS avg_bike_availability FROM view_district
WHERE ten_min_datetime IN (SELECT t FROM (SELECT t, row_number() OVER (PARTITION BY CAST(t AS DATE) ORDER BY t) - 1 AS i,
  count(*) OVER (PARTITION BY CAST(t AS DATE)) AS n FROM (SELECT DISTINCT ten_min_datetime AS t FROM view_district))
WHERE CASE WHEN n > 32 THEN i % (n // 32) = 0 AND i // (n // 32) < 32 ELSE true END)""")
def animation_frames(spark: SparkSession, folder: str) -> DataFrame:
    f = frames.animation_frames(v.availability(spark, folder))
    return rounded(f.select("district_code", "ten_min_datetime", "avg_bike_availability"), 6, "avg_bike_availability")


@register("slider_frames", "J18 W8 F13 P27 Q14", f"""
WITH vals AS (SELECT neighbourhood_name, CAST(ten_min_datetime AS DATE) AS d, ten_min_datetime,
    hour(ten_min_datetime) * 3600 + minute(ten_min_datetime) * 60 AS s, avg_bike_availability AS a
  FROM view_neighbourhood),
steps AS (SELECT DISTINCT d, unnest(range(145)) AS step FROM vals),
ranked AS (SELECT d, step, neighbourhood_name, ten_min_datetime, a, abs(s - step * 600) AS gap_s,
    row_number() OVER (PARTITION BY d, step, neighbourhood_name ORDER BY abs(s - step * 600), s) AS rn FROM steps JOIN vals USING (d)),
near AS (SELECT * FROM ranked WHERE rn = 1 AND gap_s <= 900),
target AS (SELECT d, step, arg_min(s, abs(s - step * 600) * 100000 + s) AS t FROM steps JOIN vals USING (d)
  WHERE (d, step) NOT IN (SELECT (d, step) FROM near) GROUP BY ALL),
far AS (SELECT d, step, neighbourhood_name, ten_min_datetime, a, abs(s - t) AS gap_s,
    row_number() OVER (PARTITION BY d, step, neighbourhood_name ORDER BY abs(s - t), s) AS rn FROM target JOIN vals USING (d))
SELECT strftime(d, {DAY}) AS date_value, CAST(step AS INTEGER) AS step, neighbourhood_name, strftime(ten_min_datetime, {SECOND}) AS ten_min_datetime,
  round(a, 6) AS avg_bike_availability, CAST(gap_s AS INTEGER) AS gap_s, is_fallback
FROM (SELECT *, false AS is_fallback FROM near UNION ALL SELECT *, true FROM far WHERE rn = 1)""")
def slider_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of all neighbourhoods; the view is a stored table, so it is written out first."""
    view = checkpointed(v.availability(spark, folder, "neighborhood"))
    out = frames.slider_frames(view, "neighbourhood_name").select("date_value", "step", "neighbourhood_name", "ten_min_datetime",
                                            "avg_bike_availability", "gap_s", "is_fallback")
    return rounded(out, 6, "avg_bike_availability")


@register("frame_labels", "P27 P28", f"""
SELECT district_code, strftime(ten_min_datetime, {SECOND}) AS ten_min_datetime, strftime(ten_min_datetime, '%H:%M') AS time,
  round(hour(ten_min_datetime) + minute(ten_min_datetime) / 60e0, 6) AS hour_float FROM view_district""")
def frame_labels(spark: SparkSession, folder: str) -> DataFrame:
    f = frames.with_frame_times(v.availability(spark, folder))
    return rounded(f.select("district_code", "ten_min_datetime", "time", "hour_float"), 6, "hour_float")


@register("frame_with_all_areas", "J17 Q14", """
SELECT l.neighbourhood_code, l.neighbourhood_name, l.area, round(avg_bike_availability, 6) AS avg_bike_availability
FROM (SELECT neighbourhood_code, neighbourhood_name, round(sum((x1 - x0) * (y1 - y0)), 9) AS area FROM location GROUP BY 1, 2) l LEFT JOIN (SELECT * FROM view_neighbourhood WHERE ten_min_datetime = TIMESTAMP '2024-01-05 12:00:00') USING (neighbourhood_code, neighbourhood_name)""")
def frame_with_all_areas(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["neighbourhood_code", "neighbourhood_name"]
    shapes = frames.area_shapes(v.location(spark, folder), "neighbourhood", tolerance=None)
    frame = frames.frame_at(shapes, v.availability(spark, folder, "neighborhood"), "2024-01-05 12:00:00", keys)
    areas = frame.groupBy(*keys, "avg_bike_availability").agg(F.round(F.sum(g.polygon_area(F.col("geometry"))), 9).alias("area"))
    return rounded(areas, 6, "avg_bike_availability")


_EQUITY = """WITH latest AS (SELECT station_id, capacity FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY last_updated DESC) AS rn FROM information) WHERE rn = 1),
per_tract AS (SELECT census_tract_id, district_name, sum(capacity) AS cap FROM latest JOIN areas USING (station_id) GROUP BY 1, 2),
da AS (SELECT district_name, sum(census_tract_area) AS area FROM location GROUP BY 1),
m AS (SELECT p.district_name, year, CAST(sum(population) AS BIGINT) AS total_population, avg(income_euros) AS avg_income, CAST(sum(cap) AS BIGINT) AS total_capacity, area,
    sum(population) / area AS density, round(sum(cap) / sum(population) * 1000 / area, 4) AS service
  FROM per_tract p JOIN population_income USING (census_tract_id) JOIN da ON da.district_name = p.district_name GROUP BY p.district_name, year, area)"""


@register("district_metrics", "A13 A14 A15 W3 P31", _EQUITY + """
SELECT district_name, year, total_population, round(avg_income, 7) AS avg_income, total_capacity, round(area, 6) AS district_area,
  round(density, 4) AS population_density, service AS capacity_per_1000_inhabitants_per_sqkm FROM m""")
def district_metrics(spark: SparkSession, folder: str) -> DataFrame:
    m = rounded(_district_metrics(spark, folder), 4, "population_density")
    return rounded(rounded(m, 6, "district_area"), 7, "avg_income")


def _district_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return indicators.district_metrics(v.information(spark, folder), v.areas(spark, folder), v.location(spark, folder),
                                       v.population_income(spark, folder))


@register("capacity_equity", "Q12 A16 F8 P21 J7", _EQUITY + """,
l AS (SELECT * FROM m WHERE year = (SELECT max(year) FROM m)), c AS (SELECT avg(avg_income) AS ci, avg(service) AS cs FROM l)
SELECT district_name, year, total_population, round(avg_income, 7) AS avg_income, service AS capacity_per_1000_inhabitants_per_sqkm,
  CASE WHEN avg_income BETWEEN ci * 0.9e0 AND ci * 1.1e0 AND service BETWEEN cs * 0.9e0 AND cs * 1.1e0 THEN 'Fair Distribution'
  WHEN avg_income < ci * 0.9e0 AND service < cs * 0.9e0 THEN 'Potential Underservice' WHEN avg_income > ci * 1.1e0 AND service > cs * 1.1e0 THEN 'Privileged Access'
  WHEN avg_income < ci * 0.9e0 AND service > cs * 1.1e0 THEN 'Good Service Despite Low Income'
  WHEN avg_income > ci * 1.1e0 AND service < cs * 0.9e0 THEN 'Poor Service Despite High Income' ELSE 'Moderate Distribution' END AS equity_status FROM l, c""")
def capacity_equity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(indicators.capacity_equity(_district_metrics(spark, folder)), 7, "avg_income")


@register("district_averages", "A24 J24", """
SELECT district_name AS district, round(avg(population), 7) AS avg_population, round(avg(income_euros), 7) AS avg_income
FROM population_income JOIN location USING (census_tract_id) GROUP BY 1""")
def district_averages(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(demographics.averages(v.population_income(spark, folder), v.location(spark, folder)), 7, "avg_population", "avg_income")


@register("income_by_district", "A18 J24 Q19", """
SELECT district_code, round(avg(import_euros), 4) AS avg_income FROM income JOIN location ON seccio_censal = census_tract_id GROUP BY 1""")
def income_by_district(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(studies.income_by_district(v.income(spark, folder), v.location(spark, folder)), 4, "avg_income")


@register("income_by_year", "A18 Q19", "SELECT CAST(year AS INTEGER) AS year, round(avg(import_euros), 2) AS avg_income FROM income GROUP BY 1")
def income_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return studies.income_by_year(v.income(spark, folder))


@register("income_at_centroids", "A21 F6 G2 Q19", """
SELECT census_tract_id, round((x0 + x1) / 2, 8) AS x, round((y0 + y1) / 2, 8) AS y, round(avg(import_euros), 6) AS avg_income
FROM income JOIN tracts ON seccio_censal = census_tract_id WHERE import_euros IS NOT NULL GROUP BY ALL""")
def income_at_centroids(spark: SparkSession, folder: str) -> DataFrame:
    rows = studies.income_at_centroids(v.income(spark, folder).dropna(subset=["import_euros"]), v.location(spark, folder))
    flat = rows.select("census_tract_id", F.col("centroid.x").alias("x"), F.col("centroid.y").alias("y"), "avg_income")
    return rounded(rounded(flat, 8, "x", "y"), 6, "avg_income")
