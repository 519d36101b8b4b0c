"""Nested JSON station snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INFORMATION_STATION = ("station_id long, name string, lat double, lon double, capacity int, cross_street string, "
                       "post_code string, address string, is_charging_station boolean")
STATUS_STATION = ("station_id long, num_bikes_available int, "
                  "num_bikes_available_types struct<mechanical:int, ebike:int>, num_docks_available int, "
                  "status string, last_reported long, is_charging_station boolean")


def scan_snapshot(spark: SparkSession, paths: Sequence[str] | str, station: str, by_line: bool = False) -> DataFrame:
    """One row per element of ``data.stations``; ``by_line`` reads one snapshot per text line."""
    stations = T.StructType([T.StructField("stations", T.ArrayType(T.StructType.fromDDL(station)))])
    schema = T.StructType([T.StructField("data", stations)])
    raw = spark.read.schema(schema).option("multiLine", str(not by_line).lower()).json(paths)
    return raw.select(F.explode("data.stations").alias("s")).select("s.*")


def flatten_bike_types(status: DataFrame) -> DataFrame:
    """Nested bike counts as two columns, the nested one dropped."""
    return (status.withColumn("num_mechanical_bikes", F.col("num_bikes_available_types.mechanical"))
            .withColumn("num_ebikes", F.col("num_bikes_available_types.ebike")).drop("num_bikes_available_types"))


def merge_snapshots(information: DataFrame, status: DataFrame, key: str = "station_id",
                    drop: Sequence[str] = ("is_charging_station_status",)) -> DataFrame:
    """Inner join on the station; a column both have is kept twice, as ``*_info`` and ``*_status``.

    ``drop`` names the twins that say nothing new.
    """
    shared = (set(information.columns) & set(status.columns)) - {key}
    left = information.withColumnsRenamed({c: f"{c}_info" for c in shared})
    right = status.withColumnsRenamed({c: f"{c}_status" for c in shared})
    return left.join(right, key).drop(*drop)
