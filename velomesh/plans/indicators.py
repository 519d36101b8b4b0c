"""The published indicators: coverage, connectivity, accessibility, capacity equity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.functions import geometry as g, measures
from velomesh.operators.history import latest_value
from velomesh.operators.nearest import nearest_line
from velomesh.operators.skew import unbroadcast
from velomesh.session import checkpointed


def _names(location: DataFrame) -> DataFrame:
    return location.select("census_tract_id", "neighbourhood_name", "district_name")


def lane_coverage(metrics: DataFrame, location: DataFrame, trimesters: DataFrame) -> DataFrame:
    return (metrics.join(unbroadcast(_names(location)), "census_tract_id").join(trimesters, "year_trimester")
            .select("census_tract_id", "neighbourhood_name", "district_name", "year_trimester", "year", "trimester",
                    "total_lane_length", "coverage_score")
            .orderBy("year_trimester", F.col("coverage_score").desc_nulls_first(), "census_tract_id"))


def lane_connectivity(network: DataFrame, trimesters: DataFrame) -> DataFrame:
    return (network.join(trimesters, "year_trimester")
            .select("year_trimester", "year", "trimester", "total_lanes", "connected_lanes", "isolated_lanes",
                    F.col("connectivity_ratio").alias("connectivity_score"))
            .orderBy("year", "trimester"))


def tract_points(location: DataFrame, trimesters: DataFrame) -> DataFrame:
    """Every tract centroid with every trimester; the short trimester list is unfolded per tract."""
    listed = trimesters.agg(F.array_sort(F.collect_set("year_trimester"))).scalar()
    return (location.select("census_tract_id", g.polygon_centroid(F.col("geometry")).alias("geometry"))
            .withColumn("year_trimester", F.explode(listed)))


def lane_accessibility(location: DataFrame, trimesters: DataFrame, state: DataFrame, top: int | None = None) -> DataFrame:
    """Metres from each tract centroid to its nearest lane and the score derived from it.

    A report can keep the first ``top`` rows; by default all are returned.
    """
    near = nearest_line(tract_points(location, trimesters), state, "census_tract_id", "year_trimester", "lane_id")
    out = (near.join(unbroadcast(_names(location)), "census_tract_id").join(trimesters, "year_trimester")
           .select("census_tract_id", "neighbourhood_name", "district_name", "year_trimester", "year", "trimester",
                   F.col("metres").alias("min_distance_meters"),
                   measures.accessibility(F.col("metres")).alias("accessibility_score")))
    if top is None:
        return out
    return out.orderBy("year_trimester", F.col("accessibility_score").desc_nulls_first(), "census_tract_id").limit(top)


def district_metrics(information: DataFrame, areas: DataFrame, location: DataFrame, people: DataFrame) -> DataFrame:
    """Population, income and station capacity per district and year, over tracts that have stations.

    Income is the plain average over those tracts.
    """
    capacity = latest_value(information, ["station_id"], "capacity", "last_updated")
    per_tract = (capacity.join(areas.select("station_id", "census_tract_id", "district_name"), "station_id")
                 .groupBy("census_tract_id", "district_name").agg(F.sum("capacity").alias("_capacity")))
    area = location.groupBy("district_name").agg(F.sum("census_tract_area").alias("district_area"))
    grouped = (per_tract.join(people, "census_tract_id").groupBy("district_name", "year")
               .agg(F.sum("population").alias("total_population"), F.avg("income_euros").alias("avg_income"),
                    F.sum("_capacity").alias("total_capacity"))
               .join(area, "district_name"))
    per_km2 = measures.safe_ratio(measures.safe_ratio(
        F.col("total_capacity"), F.col("total_population")) * 1000, F.col("district_area"))
    return grouped.withColumns({
        "population_density": measures.safe_ratio(F.col("total_population"), F.col("district_area")),
        "capacity_per_1000_inhabitants_per_sqkm": F.round(per_km2, 4)})


def capacity_equity(metrics: DataFrame) -> DataFrame:
    """Latest year of ``district_metrics`` with the class of each district against the city mean.

    The metrics, one row per district and year, are read three times and so written out first.
    """
    metrics = checkpointed(metrics)
    service = "capacity_per_1000_inhabitants_per_sqkm"
    latest = metrics.where(F.col("year") == metrics.agg(F.max("year")).scalar())
    city = latest.agg(F.struct(F.avg("avg_income").alias("income"), F.avg(service).alias("service"))).scalar()
    return (latest.withColumn("_c", city)
            .select("district_name", "year", "total_population", "avg_income", service, measures.equity_class(
                F.col("avg_income"), F.col("_c.income"), F.col(service), F.col("_c.service")).alias("equity_status"))
            .orderBy("district_name"))
