"""Profiles, distributions, pivots and snapshot summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomesh.operators import quality, stats
from velomesh.plans import demographics, studies
from velomesh.session import checkpointed
from velomesh.sources import snapshots
from velomesh.workload import views as v
from velomesh.workload.registry import register, rounded

# The region names and order years of the test tables, which the oracle must spell out.
DISTRICT_NAMES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)

_GROUPED = """SELECT district_name AS district, year, avg(population) AS avg_population, avg(income_euros) AS avg_income
FROM population_income JOIN location USING (census_tract_id) GROUP BY 1, 2"""


def _grouped(spark: SparkSession, folder: str) -> DataFrame:
    return demographics.averages(v.population_income(spark, folder), v.location(spark, folder), by_year=True)


@register("averages_by_year", "A24", "SELECT district, year, round(avg_population, 7) AS avg_population, round(avg_income, 7) AS avg_income FROM (" + _GROUPED + ")")
def averages_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_grouped(spark, folder), 7, "avg_population", "avg_income")


def _pivot_sql(row: str, column: str, values: tuple, measure: str) -> str:
    cells = ", ".join(f"""round(max(CASE WHEN {column} = '{x}' THEN {measure} END), 7) AS "{x}" """ for x in values)
    return f"SELECT {row}, {cells} FROM ({_GROUPED}) GROUP BY 1"


@register("population_pivot", "A25 O1", _pivot_sql("year", "district", DISTRICT_NAMES, "avg_population"))
def population_pivot(spark: SparkSession, folder: str) -> DataFrame:
    wide = stats.pivot(checkpointed(_grouped(spark, folder)), "year", "district", "avg_population")
    return rounded(wide, 7, *wide.columns[1:])


@register("income_pivot", "A25", _pivot_sql("district", "year", YEARS, "avg_income"))
def income_pivot(spark: SparkSession, folder: str) -> DataFrame:
    wide = stats.pivot(checkpointed(_grouped(spark, folder)), "district", "year", "avg_income")
    return wide.select("district", *[F.round(F.col(f"`{y}`"), 7).alias(y) for y in wide.columns[1:]])


_SNAPSHOT = """SELECT t.*, i.station_id % 2 = 0 AS charging, 10 + i.o_orderkey % 30 AS cap, i.name, epoch(t.last_reported) AS reported
FROM ticks t JOIN (SELECT station_id, name, arg_max(o_orderkey, last_updated) AS o_orderkey FROM information GROUP BY 1, 2) i ON i.station_id = t.station_id"""


def _snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks joined with a one-row-per-station description, in the shape of the JSON snapshots."""
    newest = v.information(spark, folder).groupBy("station_id", "name").agg(
        F.max_by("o_orderkey", "last_updated").alias("k"))
    info = newest.select("station_id", "name", (10 + F.col("k") % 30).cast("int").alias("capacity"),
                         (F.col("station_id") % 2 == 0).alias("is_charging_station"))
    state = v.ticks(spark, folder).select(
        "event_id", "station_id", "num_bikes_available", F.struct(
            F.col("mechanical_bikes").alias("mechanical"), F.col("ebikes").alias("ebike")).alias("num_bikes_available_types"),
        "num_docks_available", "status", F.concat_ws("/", "status", F.lit("x")).alias("cross_street"),
        F.unix_seconds(F.col("last_reported").cast("timestamp")).alias("last_reported"),
        F.lit(False).alias("is_charging_station"))
    merged = snapshots.merge_snapshots(info, snapshots.flatten_bike_types(state))
    return studies.snapshot_profile(merged)


@register("merged_snapshot", "J16 P22 P23 P24 P29 Q17", """
SELECT event_id, station_id, name, charging AS is_charging_station_info, mechanical_bikes AS num_mechanical_bikes, round(num_bikes_available * 100e0 / cap, 6) AS usage_rate,
  CASE WHEN num_bikes_available / cap < 0.2e0 THEN 'Low availability' WHEN num_bikes_available / cap < 0.5e0 THEN 'Medium availability' ELSE 'Good availability' END AS fill_status,
  status AS district, strftime(last_reported, '%Y-%m-%d %H:%M:%S') AS reported_at FROM (""" + _SNAPSHOT + ")")
def merged_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_snapshot(spark, folder).select(
        "event_id", "station_id", "name", "is_charging_station_info", "num_mechanical_bikes", "usage_rate", "fill_status",
        "district", "reported_at"), 6, "usage_rate")


@register("snapshot_totals", "A33 Q17", """
SELECT count(*) AS n_stations, CAST(sum(cap) AS BIGINT) AS total_capacity, CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes,
  CAST(sum(mechanical_bikes) AS BIGINT) AS total_mechanical, CAST(sum(ebikes) AS BIGINT) AS total_ebikes, CAST(sum(num_docks_available) AS BIGINT) AS total_docks,
  round(avg(CASE WHEN charging THEN 1e0 ELSE 0e0 END) * 100, 2) AS charging_pct, round(100e0 * sum(mechanical_bikes) / sum(mechanical_bikes + ebikes), 1) AS mechanical_share,
  round(100e0 * sum(ebikes) / sum(mechanical_bikes + ebikes), 1) AS ebike_share FROM (""" + _SNAPSHOT + ")")
def snapshot_totals(spark: SparkSession, folder: str) -> DataFrame:
    return studies.snapshot_totals(_snapshot(spark, folder))


@register("bikes_by_district", "A34 Q17", """
SELECT status AS district, CAST(sum(mechanical_bikes) AS BIGINT) AS num_mechanical_bikes, CAST(sum(ebikes) AS BIGINT) AS num_ebikes FROM (""" + _SNAPSHOT + ") GROUP BY 1")
def bikes_by_district(spark: SparkSession, folder: str) -> DataFrame:
    return studies.bikes_by_district(_snapshot(spark, folder))


_NUMERIC = {"capacity": "cap", "num_bikes_available": "num_bikes_available", "num_mechanical_bikes": "mechanical_bikes", "num_ebikes": "ebikes",
            "num_docks_available": "num_docks_available", "last_reported": "floor(reported)"}


@register("snapshot_correlations", "A26 Q17", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, CASE WHEN var_pop({x}) > 0 AND var_pop({y}) > 0 THEN round(corr({x}, {y}), 6) END AS r FROM ({_SNAPSHOT})"
    for i, (a, x) in enumerate(_NUMERIC.items()) for b, y in list(_NUMERIC.items())[i + 1:]))
def snapshot_correlations(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.correlations(_snapshot(spark, folder), list(_NUMERIC)), 6, "r")


@register("status_counts", "A28 O4 Q17", """
SELECT status AS value, count(*) AS n_rows, round(100e0 * count(*) / sum(count(*)) OVER (), 2) AS share_pct FROM ticks GROUP BY 1""")
def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.value_counts(v.ticks(spark, folder), "status")


@register("distinct_counts", "A28 Q18", """
SELECT 'data_referencia' AS column_name, count(DISTINCT data_referencia) AS n_distinct FROM population UNION ALL
SELECT 'seccio_censal', count(DISTINCT seccio_censal) FROM population UNION ALL SELECT 'valor', count(DISTINCT valor) FROM population""")
def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.distinct_counts(v.population(spark, folder), ["data_referencia", "seccio_censal", "valor"])


DESCRIBED = ("station_id", "lat", "lon", "altitude", "capacity")


def _describe_sql(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, round(avg({column}), 5) AS mean, round(stddev_samp({column}), 5) AS std, round(CAST(min({column}) AS DOUBLE), 5) AS min,
  round(CAST(quantile_cont({column}, 0.25) AS DOUBLE), 5) AS q25, round(CAST(quantile_cont({column}, 0.5) AS DOUBLE), 5) AS q50, round(CAST(quantile_cont({column}, 0.75) AS DOUBLE), 5) AS q75,
  round(CAST(max({column}) AS DOUBLE), 5) AS max FROM {source}"""


@register("described_columns", "A27 Q18", " UNION ALL ".join(_describe_sql(c, "information") for c in DESCRIBED))
def described_columns(spark: SparkSession, folder: str) -> DataFrame:
    d = stats.describe(v.information(spark, folder), list(DESCRIBED))
    return rounded(d, 5, "mean", "std", "min", "q25", "q50", "q75", "max")


@register("described_texts", "A27", " UNION ALL ".join(f"""SELECT * FROM (SELECT '{c}' AS column_name, CAST(sum(count(*)) OVER () AS BIGINT) AS n, count(*) OVER () AS n_unique, {c} AS top,
  count(*) AS freq FROM orders GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)""" for c in ("o_orderstatus", "o_orderpriority")))
def described_texts(spark: SparkSession, folder: str) -> DataFrame:
    return stats.describe_text(v.table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("population_of_year", "F7 Q18", "SELECT seccio_censal, valor FROM population WHERE data_referencia = '1999-01-01'")
def population_of_year(spark: SparkSession, folder: str) -> DataFrame:
    return v.population(spark, folder).where(F.col("data_referencia") == "1999-01-01").select("seccio_censal", "valor")


@register("mean_population", "A35 O4 Q18", """
SELECT o_orderpriority AS nom_districte, round(avg(floor(o_totalprice / 100)), 7) AS mean_valor FROM orders GROUP BY 1""")
def mean_population(spark: SparkSession, folder: str) -> DataFrame:
    raw = v.raw_population(spark, folder).withColumn("valor", F.col("valor").cast("bigint"))
    return rounded(studies.mean_by(raw, "nom_districte", "valor"), 7, "mean_valor")


@register("population_boxes", "A29 Q18", """
WITH q AS (SELECT o_orderpriority AS nom_districte, floor(o_totalprice / 100) AS x, quantile_cont(floor(o_totalprice / 100), 0.25) OVER w AS q25,
    quantile_cont(floor(o_totalprice / 100), 0.5) OVER w AS q50, quantile_cont(floor(o_totalprice / 100), 0.75) OVER w AS q75 FROM orders WINDOW w AS (PARTITION BY o_orderpriority))
SELECT nom_districte, q25, q50, q75, min(CASE WHEN x >= q25 - 1.5 * (q75 - q25) THEN x END) AS whisker_low, max(CASE WHEN x <= q75 + 1.5 * (q75 - q25) THEN x END) AS whisker_high,
  CAST(sum(CASE WHEN x < q25 - 1.5 * (q75 - q25) OR x > q75 + 1.5 * (q75 - q25) THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers FROM q GROUP BY 1, 2, 3, 4""")
def population_boxes(spark: SparkSession, folder: str) -> DataFrame:
    raw = v.raw_population(spark, folder).withColumn("valor", F.col("valor").cast("bigint"))
    return stats.box_stats(raw, "nom_districte", "valor")


def _histogram_sql(column: str, source: str, bins: int) -> str:
    return f"""WITH s AS (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi, count({column}) AS n FROM {source}),
c AS (SELECT least({bins - 1}, CAST(floor(({column} - lo) / (hi - lo) * {bins}) AS INTEGER)) AS bin, count(*) AS k FROM {source}, s GROUP BY 1)
SELECT CAST(b AS INTEGER) AS bin, round(lo + b * ((hi - lo) / {bins}), 6) AS low, round(lo + (b + 1) * ((hi - lo) / {bins}), 6) AS high, coalesce(k, 0) AS n_rows,
  round(coalesce(k, 0) / (n * ((hi - lo) / {bins})), 9) AS density FROM (SELECT unnest(range({bins})) AS b), s LEFT JOIN c ON c.bin = b"""


@register("bike_histogram", "A30 Q17", _histogram_sql("num_bikes_available", "ticks", 20))
def bike_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(rounded(stats.histogram(v.ticks(spark, folder), "num_bikes_available", 20), 6, "low", "high"), 9, "density")


@register("docks_histogram", "A30 Q17", _histogram_sql("num_docks_available", "ticks", 20))
def docks_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(rounded(stats.histogram(v.ticks(spark, folder), "num_docks_available", 20), 6, "low", "high"), 9, "density")


@register("population_histogram", "A30 Q18", _histogram_sql("valor", "population", 30))
def population_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(rounded(stats.histogram(v.population(spark, folder), "valor", 30), 6, "low", "high"), 9, "density")


@register("population_density_curve", "A31 Q18", """
WITH s AS (SELECT CAST(min(valor) AS DOUBLE) AS lo, CAST(max(valor) AS DOUBLE) AS hi, count(*) AS n, stddev_samp(valor) * pow(count(*), -0.2e0) AS h FROM population)
SELECT CAST(g AS INTEGER) AS i, round(lo + g * (hi - lo) / 199, 6) AS x, round(sum(exp(-0.5e0 * pow((lo + g * (hi - lo) / 199 - valor) / h, 2))) / (n * h * sqrt(2 * pi())), 10) AS density
FROM population, s, (SELECT unnest(range(200)) AS g) GROUP BY g, lo, hi, n, h""")
def population_density_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(rounded(stats.kde(v.population(spark, folder), "valor"), 6, "x"), 10, "density")


@register("income_values", "F6 Q19", "SELECT import_euros FROM income WHERE import_euros IS NOT NULL")
def income_values(spark: SparkSession, folder: str) -> DataFrame:
    return v.income(spark, folder).select("import_euros").dropna(subset=["import_euros"])


@register("complete_rows", "F9", "SELECT o_orderkey, altitude, capacity FROM information WHERE altitude IS NOT NULL AND capacity IS NOT NULL")
def complete_rows(spark: SparkSession, folder: str) -> DataFrame:
    return v.information(spark, folder).select("o_orderkey", "altitude", "capacity").dropna()
