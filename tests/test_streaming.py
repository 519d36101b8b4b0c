"""Streaming readings of the batch operators."""

import datetime as dt

from velomesh.streaming import ticks
from velomesh.workload import streams

SCHEMA = "station_id int, last_updated timestamp, num_bikes_available int, mechanical_bikes int, ebikes int, num_docks_available int"


def _stream(spark, tmp_path):
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(s, base + dt.timedelta(minutes=m), b, b, 0, 10 - b) for s, m, b in (
        (1, 1, 5), (1, 9, 4), (2, 3, 10), (1, 12, 2), (2, 15, 0), (1, 90, 1))]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(str(tmp_path / "in"))
    return spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))


def _drain(spark, df, tmp_path, name):
    q = (df.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / name))
         .option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(str(tmp_path / name))


def test_bucket_availability(spark, tmp_path):
    areas = spark.createDataFrame([(1, "A"), (2, "A")], "station_id int, district_name string")
    log = _drain(spark, ticks.tick_changes(_stream(spark, tmp_path)), tmp_path, "out")
    out = ticks.bucket_availability(log, areas, "district_name")
    got = {r.ten_min_datetime.strftime("%H:%M"): (r.avg_bike_availability, r.total_bikes_available, r.station_count) for r in out.collect()}
    assert got == {"00:00": (70.0, 14, 2), "00:10": (10.0, 2, 2), "01:30": (10.0, 1, 1)}


def test_thin_stream(spark, tmp_path):
    log = _drain(spark, ticks.tick_changes(_stream(spark, tmp_path), latest=False), tmp_path, "thin")
    kept = sorted((r.station_id, r.last_updated.strftime("%H:%M")) for r in ticks.merged_changes(log, latest=False).collect())
    assert kept == [(1, "00:01"), (1, "00:12"), (1, "01:30"), (2, "00:03"), (2, "00:15")]


def test_late_ticks_over_several_batches_are_kept(spark, tmp_path):
    """Files that arrive in the wrong order, a day late, give the same buckets."""
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    for k, minutes in enumerate((1500, 9, 3, 1505, 1)):
        rows = [(1, base + dt.timedelta(minutes=minutes), minutes % 7, 0, 0, 1)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    log = _drain(spark, ticks.tick_changes(stream), tmp_path, "late")
    kept = sorted((r.ten_min_datetime.strftime("%d %H:%M"), r.num_bikes_available) for r in ticks.merged_changes(log).collect())
    assert kept == [("01 00:00", 9 % 7), ("02 01:00", 1505 % 7)]


def test_streams_read_files_and_folders_alike(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("customer", "orders", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    for query in (streams.streamed_thinning, streams.streamed_availability):
        one, four = (sorted(map(tuple, query(spark, f).collect())) for f in ("/root/testdata/sf0.001", str(tmp_path)))
        assert one == four and len(one) > 50
