"""Streaming readings of two batch operators: bucketed availability and thinning.

Both keep one tick per (station, ten-minute bucket). The stream writes a change log: a row whenever a
tick replaces the one a bucket had. Reading the log keeps the last change of each bucket. So nothing is
lost: the last buckets need no later tick to close them, a late tick is a late change, and a bucket
whose state was dropped after a quiet time simply starts a second entry that the reading merges.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from velomesh.functions import calendar as cal
from velomesh.operators.history import latest_per
from velomesh.plans.stations import with_availability

VALUES = ["num_bikes_available", "mechanical_bikes", "ebikes", "num_docks_available"]
LOG_COLUMNS = "station_id int, ten_min_datetime timestamp, last_updated timestamp, " + ", ".join(f"{c} int" for c in VALUES)


def tick_changes(ticks: DataFrame, latest: bool = True, quiet_ms: int | None = None) -> DataFrame:
    """Change log of a stream of status ticks: the latest (or earliest) tick so far of each station and bucket.

    A stream that never ends should give ``quiet_ms``, the time without ticks after which the state of a bucket is
    dropped. A stream that drains what is there must not: Spark would wait for the time-outs.
    """
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values(["last_updated", *VALUES])
        best = rows.iloc[[-1 if latest else 0]]
        now = int(best["last_updated"].iloc[0].value)
        old = state.get[0] if state.exists else None
        if quiet_ms is not None:
            state.setTimeoutDuration(quiet_ms)
        if old is None or (now >= old if latest else now <= old):
            state.update((now,))
            yield best.assign(station_id=key[0], ten_min_datetime=key[1])[
                ["station_id", "ten_min_datetime", "last_updated", *VALUES]]

    keyed = ticks.where(F.col("last_updated").isNotNull()).withColumn("ten_min_datetime", cal.time_floor(F.col("last_updated")))
    return keyed.groupBy("station_id", "ten_min_datetime").applyInPandasWithState(
        step, LOG_COLUMNS, "at long", "append",
        GroupStateTimeout.NoTimeout if quiet_ms is None else GroupStateTimeout.ProcessingTimeTimeout)


def merged_changes(log: DataFrame, latest: bool = True) -> DataFrame:
    """The last change of each station and bucket of a change log."""
    keys = ["station_id", "ten_min_datetime"]
    if latest:
        return latest_per(log, keys, "last_updated", VALUES)
    first = log.groupBy(*keys).agg(F.min(F.struct("last_updated", *VALUES)).alias("r"))
    return first.select(*keys, "r.*")


def bucket_availability(log: DataFrame, areas: DataFrame, key: str) -> DataFrame:
    """Ten-minute availability per area from the change log; ``areas`` is a static station table."""
    scored = with_availability(merged_changes(log)).join(areas.select("station_id", key), "station_id")
    return scored.groupBy("ten_min_datetime", key).agg(
        F.avg("bike_availability_percentage").alias("avg_bike_availability"),
        F.sum("num_bikes_available").alias("total_bikes_available"), F.countDistinct("station_id").alias("station_count"))
