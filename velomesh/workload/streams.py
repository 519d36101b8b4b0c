"""Streaming queries, drained to the end of the given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomesh.session import shared_folder
from velomesh.streaming import ticks as stream
from velomesh.workload import views as v
from velomesh.workload.registry import register, rounded


def _is_folder(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def _tick_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream, be it one file or a folder of part files; a missing table raises.

    A file stream reads folders, so a single file is picked out of the folder it lies in.
    """
    path = f"{folder}/events.parquet"
    schema = v.table(spark, folder, "events").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
    events = reader.parquet(path) if _is_folder(spark, path) else reader.option("pathGlobFilter", "events.parquet").parquet(folder)
    events = (events
              .withColumn("station_id", F.expr("CAST(user_id % 20 AS INT)"))
              .withColumn("num_bikes_available", F.expr("CAST(floor(value) AS INT) % 40")))
    return events.selectExpr(
        "station_id", "CAST(ts AS TIMESTAMP) AS last_updated", "num_bikes_available",
        "CAST(num_bikes_available - CAST(event_id % (num_bikes_available + 1) AS INT) AS INT) AS mechanical_bikes",
        "CAST(event_id % (num_bikes_available + 1) AS INT) AS ebikes", "40 - num_bikes_available AS num_docks_available")


def _drained(df: DataFrame, columns: str) -> DataFrame:
    """Run the stream over everything there is and read back what it appended."""
    spark = df.sparkSession
    out = shared_folder(spark, "stream")
    query = (df.writeStream.outputMode("append").format("parquet").option("path", f"{out}/rows")
             .option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(columns).parquet(f"{out}/rows")


@register("streamed_availability", "X1", """
SELECT strftime(ten_min_datetime, '%Y-%m-%d %H:%M:%S') AS ten_min_datetime, district_name, round(avg(pct), 6) AS avg_bike_availability,
  CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes_available, count(*) AS station_count FROM scored JOIN areas USING (station_id) GROUP BY 1, 2""")
def streamed_availability(spark: SparkSession, folder: str) -> DataFrame:
    areas = v.areas(spark, folder).select("station_id", "district_name")
    log = _drained(stream.tick_changes(_tick_stream(spark, folder)), stream.LOG_COLUMNS)
    return rounded(stream.bucket_availability(log, areas, "district_name"), 6, "avg_bike_availability")


@register("streamed_thinning", "X2", """
SELECT station_id, strftime(time_bucket(INTERVAL '10 minutes', last_updated), '%Y-%m-%d %H:%M:%S') AS bucket,
  strftime(min(last_updated), '%Y-%m-%d %H:%M:%S') AS kept FROM ticks GROUP BY 1, 2""")
def streamed_thinning(spark: SparkSession, folder: str) -> DataFrame:
    log = _drained(stream.tick_changes(_tick_stream(spark, folder), latest=False), stream.LOG_COLUMNS)
    return stream.merged_changes(log, latest=False).select(
        "station_id", F.col("ten_min_datetime").alias("bucket"), F.col("last_updated").alias("kept"))
