"""Station dimensions and facts, and ten-minute availability by area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.functions import calendar as cal, geometry as g, measures
from velomesh.operators import dims
from velomesh.operators.history import latest_per, within_days
from velomesh.operators.spatial import contains_join

LEVELS = {"district": ["district_name", "district_code"],
          "neighborhood": ["neighbourhood_name", "neighbourhood_code"]}


def station_calendar(information: DataFrame, status: DataFrame) -> dict[str, DataFrame]:
    """Year to ten-minute dimensions covering both feeds."""
    feeds = [(information, "last_updated"), (status, "last_updated")]
    hours = dims.distinct_times(feeds, cal.trunc("hour", F.col("ts")))
    day = dims.day_dim(hours)
    hour = dims.hour_dim(hours, day)
    buckets = dims.distinct_times([(status, "last_updated")], cal.time_floor(F.col("ts")))
    return {"dim_year": dims.year_dim(hours), "dim_month": dims.month_dim(hours), "dim_day": day,
            "dim_hour": hour, "dim_ten_minute": dims.ten_minute_dim(buckets, hour)}


def dim_station(information: DataFrame) -> DataFrame:
    newest = latest_per(information.select("station_id", "name", "lat", "lon", "altitude", "last_updated"),
                        ["station_id"], "last_updated")
    return newest.select("station_id", "name", g.point(F.col("lon"), F.col("lat")).alias("geometry"), "altitude")


def fact_station_information(information: DataFrame, stations: DataFrame, hours: DataFrame) -> DataFrame:
    rows = information.select("station_id", cal.trunc("hour", F.col("last_updated")).alias("hour_datetime"),
                              "capacity", "last_updated")
    newest = latest_per(rows, ["station_id", "hour_datetime"], "last_updated")
    return dims.valid_keys(dims.valid_keys(newest, stations, ["station_id"]), hours, ["hour_datetime"])


def fact_station_status(status: DataFrame, stations: DataFrame, buckets: DataFrame | None = None,
                        first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Latest reading per station and ten-minute bucket, for known stations (and buckets, if given).

    A day range is put on the ticks' own time, which no bucket crosses, and so reaches the scan.
    """
    if first_day is not None:
        status = status.where(within_days(F.col("last_updated"), first_day, last_day or first_day))
    rows = status.select("station_id", cal.time_floor(F.col("last_updated")).alias("ten_min_datetime"),
                         "num_bikes_available", "mechanical_bikes", "ebikes", "num_docks_available", "status",
                         "last_reported", "last_updated")
    newest = dims.valid_keys(latest_per(rows, ["station_id", "ten_min_datetime"], "last_updated"),
                             stations, ["station_id"])
    return newest if buckets is None else dims.valid_keys(newest, buckets, ["ten_min_datetime"])


def station_area(stations: DataFrame, location: DataFrame) -> DataFrame:
    """Stations with the codes of the tract that contains them; one spatial join for all uses."""
    tracts = location.select("census_tract_id", "neighbourhood_code", "neighbourhood_name", "district_code",
                             "district_name", "geometry")
    return contains_join(stations.select("station_id", "geometry"), tracts, ["station_id"]).drop("geometry")


def with_availability(status: DataFrame) -> DataFrame:
    bikes, docks = F.col("num_bikes_available"), F.col("num_docks_available")
    return status.withColumns({
        "bike_availability_percentage": measures.availability_pct(bikes, docks),
        "ebike_percentage": measures.share_or_zero(F.col("ebikes"), bikes),
        "mechanical_bike_percentage": measures.share_or_zero(F.col("mechanical_bikes"), bikes)})


def availability(status: DataFrame, areas: DataFrame, level: str = "district", first_day: str | None = None,
                 last_day: str | None = None) -> DataFrame:
    """Ten-minute availability per area. ``status`` is the fact table, ``areas`` from ``station_area``.

    Calendar columns come from the bucket itself, so no dimension has to be joined. The day range is put on
    the bucket; give it to ``fact_station_status`` too, or read a fact table by month, to scan less.
    """
    rows = status
    if first_day is not None:
        rows = rows.where(within_days(F.col("ten_min_datetime"), first_day, last_day or first_day))
    keys = LEVELS[level]
    rows = with_availability(rows).join(areas.select("station_id", *keys), "station_id")
    bucket = F.col("ten_min_datetime")
    return rows.groupBy(*keys, F.to_date(bucket).alias("date_value"), F.hour(bucket).alias("hour"),
                        "ten_min_datetime").agg(
        F.avg("bike_availability_percentage").alias("avg_bike_availability"),
        F.avg("ebike_percentage").alias("avg_ebike_percentage"),
        F.avg("mechanical_bike_percentage").alias("avg_mechanical_bike_percentage"),
        F.sum("num_bikes_available").alias("total_bikes_available"), F.sum("ebikes").alias("total_ebikes"),
        F.sum("mechanical_bikes").alias("total_mechanical_bikes"),
        # A station in two overlapping tracts of one area counts once but adds to the sums twice.
        F.countDistinct("station_id").alias("station_count"))


def hourly_reporting(information: DataFrame, hours: DataFrame) -> DataFrame:
    """(hour, day_part, stations_reporting, avg_capacity) over the information facts."""
    return (information.join(hours.select("hour_datetime", "hour", "day_part"), "hour_datetime")
            .groupBy("hour", "day_part").agg(F.countDistinct("station_id").alias("stations_reporting"),
                                             F.avg("capacity").alias("avg_capacity")))


def station_stats(status: DataFrame) -> DataFrame:
    """Average, smallest and largest bike count and number of readings per station."""
    bikes = "num_bikes_available"
    return status.groupBy("station_id").agg(
        F.avg(bikes).alias("avg_bikes_available"), F.max(bikes).alias("max_bikes"), F.min(bikes).alias("min_bikes"),
        F.count(F.lit(1)).alias("observations"))


def monthly_usage(status: DataFrame) -> DataFrame:
    return status.groupBy("station_id", F.to_date(cal.trunc("month", F.col("last_updated"))).alias("month")).agg(
        F.avg("num_bikes_available").alias("avg_bikes"))


def origin_destination(information: DataFrame, station_ids: list[int]) -> DataFrame:
    """Lines between different listed stations, in both directions.

    Every information row of a station pairs with every row of the other; ``n_pairs`` says how
    often a line occurs instead of repeating it. Partners come from the given list, so the join
    has a key.
    """
    places = (information.where(F.col("station_id").isin(station_ids))
              .groupBy("station_id", "lon", "lat").agg(F.count(F.lit(1)).alias("n")))
    start = places.select(F.col("station_id").alias("origin_station"), g.point(F.col("lon"), F.col("lat")).alias("a"),
                          F.col("n").alias("n1"),
                          F.explode(F.array(*[F.lit(s) for s in station_ids])).alias("destination_station"))
    end = places.select(F.col("station_id").alias("destination_station"),
                        g.point(F.col("lon"), F.col("lat")).alias("b"), F.col("n").alias("n2"))
    return (start.where(F.col("origin_station") != F.col("destination_station")).join(end, "destination_station")
            .select("origin_station", "destination_station", g.make_line(F.col("a"), F.col("b")).alias("geometry"),
                    (F.col("n1") * F.col("n2")).alias("n_pairs")))
