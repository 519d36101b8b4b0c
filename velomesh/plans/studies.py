"""Analyses over the star schema and the raw snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.functions import calendar as cal, geodesy, geometry as g, measures, parsing
from velomesh.operators.nearest import nearest_line
from velomesh.operators.skew import unbroadcast
from velomesh.operators.spatial import intersection_counts, isolated_lines
from velomesh.operators.stats import corr_significance, dense_fill
from velomesh.plans.indicators import tract_points

STUDY_COLUMNS = ("population", "income_euros", "coverage_score", "connectivity_score", "accessibility_score")


def yearly_lane_scores(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("census_tract_id", cal.trimester_year(F.col("year_trimester")).alias("year")).agg(
        F.avg("coverage_score").alias("coverage_score"), F.avg("connectivity_score").alias("connectivity_score"))


def yearly_access(location: DataFrame, trimesters: DataFrame, state: DataFrame) -> DataFrame:
    """Yearly mean score of the lane nearest in planar degrees."""
    near = nearest_line(tract_points(location, trimesters), state, "census_tract_id", "year_trimester", "lane_id",
                        order="planar")
    return near.groupBy("census_tract_id", cal.trimester_year(F.col("year_trimester")).alias("year")).agg(
        F.avg(measures.accessibility(F.col("metres"))).alias("accessibility_score"))


def yearly_profile(people: DataFrame, lane_scores: DataFrame, access: DataFrame) -> DataFrame:
    keys = ["census_tract_id", "year"]
    return (people.select(*keys, "population", "income_euros").join(unbroadcast(lane_scores), keys, "left")
            .join(unbroadcast(access), keys, "left"))


def correlation_study(profile: DataFrame, alpha: float = 0.05) -> DataFrame:
    return corr_significance(profile, STUDY_COLUMNS, ["year"], alpha, min_n=3)


def coverage_by(metrics: DataFrame, location: DataFrame, trimesters: DataFrame, area: str) -> DataFrame:
    """(area, year, avg_coverage_score) for ``district_name`` or ``neighbourhood_name``."""
    return (metrics.join(unbroadcast(location.select("census_tract_id", area)), "census_tract_id")
            .join(trimesters.select("year_trimester", "year"), "year_trimester")
            .groupBy(area, "year").agg(F.avg("coverage_score").alias("avg_coverage_score")))


def coverage_grid(coverage: DataFrame, areas: DataFrame, trimesters: DataFrame, area: str) -> DataFrame:
    """Every area in every year of the calendar, zero where nothing is known."""
    return dense_fill(coverage, areas, area, trimesters, "year", "avg_coverage_score")


def lane_profile(lanes: DataFrame, line_id: str = "lane_id") -> DataFrame:
    """Length, vertices, sinuosity, bearing, sector, distance to the centre and its bin per lane."""
    line, flat = F.col("geometry"), F.col("_flat")
    measured = lanes.select(line_id, "geometry", geodesy.utm_line(line).alias("_flat")).select(
        line_id, g.line_length(flat).alias("length_meters"), g.vertex_count(line).alias("num_points"),
        geodesy.flat_sinuosity(flat).alias("sinuosity"), g.bearing(line).alias("bearing"),
        geodesy.flat_distance_to_centre(flat).alias("dist_to_center"))
    return measured.withColumns({"direction": g.cardinal(F.col("bearing")),
                                 "dist_bin": measures.distance_bin(F.col("dist_to_center"))})


def lane_topology(lanes: DataFrame, line_id: str = "lane_id") -> DataFrame:
    """(line_id, intersection_count, is_isolated)."""
    met = intersection_counts(lanes, [], line_id).withColumnRenamed("partners", "intersection_count")
    return met.join(unbroadcast(isolated_lines(lanes, line_id)), line_id)


def distance_summary(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("dist_bin").isNotNull()).groupBy("dist_bin").agg(
        F.sum("length_meters").alias("sum_length"), F.avg("length_meters").alias("mean_length"),
        F.count("length_meters").alias("n_lanes"))


def snapshot_profile(merged: DataFrame) -> DataFrame:
    """Per station: usage rate, fill status, area from the cross street, last report time."""
    bikes, capacity = F.col("num_bikes_available"), F.col("capacity")
    return merged.withColumns({
        "usage_rate": measures.usage_rate(bikes, capacity), "fill_status": measures.fill_status(bikes, capacity),
        "district": parsing.first_token(F.col("cross_street")),
        "reported_at": cal.epoch_to_timestamp(F.col("last_reported"))})


def snapshot_totals(merged: DataFrame, charging: str = "is_charging_station_info") -> DataFrame:
    total = F.sum(F.col("num_mechanical_bikes") + F.col("num_ebikes"))
    return merged.agg(
        F.count(F.lit(1)).alias("n_stations"), F.sum("capacity").alias("total_capacity"),
        F.sum("num_bikes_available").alias("total_bikes"), F.sum("num_mechanical_bikes").alias("total_mechanical"),
        F.sum("num_ebikes").alias("total_ebikes"), F.sum("num_docks_available").alias("total_docks"),
        F.round(F.avg(F.col(charging).cast("double")) * 100, 2).alias("charging_pct"),
        F.round(F.try_divide(100.0 * F.sum("num_mechanical_bikes"), total), 1).alias("mechanical_share"),
        F.round(F.try_divide(100.0 * F.sum("num_ebikes"), total), 1).alias("ebike_share"))


def bikes_by_district(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("district").isNotNull()).groupBy("district").agg(
        F.sum("num_mechanical_bikes").alias("num_mechanical_bikes"), F.sum("num_ebikes").alias("num_ebikes"))


def income_by_district(income: DataFrame, location: DataFrame) -> DataFrame:
    """Average income per district; the district comes from the tract, which income rows lack."""
    return (income.join(location.select(F.col("census_tract_id").alias("seccio_censal"), "district_code"), "seccio_censal")
            .groupBy("district_code").agg(F.avg("import_euros").alias("avg_income"))
            .orderBy(F.col("avg_income").desc_nulls_first(), "district_code"))


def income_by_year(income: DataFrame) -> DataFrame:
    return income.groupBy(F.year("any").alias("year")).agg(F.round(F.avg("import_euros"), 2).alias("avg_income"))


def income_at_centroids(income: DataFrame, location: DataFrame) -> DataFrame:
    means = income.groupBy(F.col("seccio_censal").alias("census_tract_id")).agg(F.avg("import_euros").alias("avg_income"))
    return (means.join(location.where(F.col("geometry").isNotNull()).select("census_tract_id", "geometry"), "census_tract_id")
            .select("census_tract_id", g.polygon_centroid(F.col("geometry")).alias("centroid"), "avg_income"))


def mean_by(df: DataFrame, by: str, value: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(value).alias(f"mean_{value}")).orderBy(F.col(f"mean_{value}").desc_nulls_first(), by)
