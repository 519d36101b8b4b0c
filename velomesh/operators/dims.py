"""Dimension upkeep: calendar tables, missing members, valid keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomesh.functions import calendar as cal


def distinct_times(frames: Sequence[tuple[DataFrame, str]], level: Column | None = None) -> DataFrame:
    """Distinct ``ts`` over several sources, optionally truncated first so little is shuffled."""
    ts = F.col("ts") if level is None else level
    parts = [df.select(F.col(c).alias("ts")).where(F.col("ts").isNotNull()).select(ts.alias("ts")).distinct()
             for df, c in frames]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.distinct()


def year_dim(days: DataFrame, ts: str = "ts") -> DataFrame:
    return days.select(F.year(ts).alias("year")).distinct()


def month_dim(days: DataFrame, ts: str = "ts") -> DataFrame:
    return days.select(cal.year_month(F.col(ts)).alias("year_month"), F.year(ts).alias("year"),
                       F.month(ts).alias("month")).distinct()


def day_dim(days: DataFrame, ts: str = "ts") -> DataFrame:
    return days.select(F.to_date(ts).alias("date_value"), cal.year_month(F.col(ts)).alias("year_month"),
                       F.dayofmonth(ts).alias("day")).distinct()


def hour_dim(hours: DataFrame, days: DataFrame, ts: str = "ts") -> DataFrame:
    """One row per hour whose day is known."""
    h = F.col("hour_datetime")
    rows = hours.select(cal.trunc("hour", F.col(ts)).alias("hour_datetime")).distinct().select(
        h, F.to_date(h).alias("date_value"), F.year(h).alias("year"), F.month(h).alias("month"),
        F.dayofmonth(h).alias("day"), F.hour(h).alias("hour"), cal.day_part(h).alias("day_part"))
    return valid_keys(rows, days, ["date_value"])


def ten_minute_dim(times: DataFrame, hours: DataFrame, ts: str = "ts") -> DataFrame:
    """One row per ten-minute bucket whose hour is known."""
    t = F.col("ten_min_datetime")
    rows = times.select(cal.time_floor(F.col(ts)).alias("ten_min_datetime")).distinct().select(
        t, cal.trunc("hour", t).alias("hour_datetime"), F.minute(t).alias("minute_bucket"))
    return valid_keys(rows, hours, ["hour_datetime"])


def trimester_dim(lanes: DataFrame) -> DataFrame:
    return lanes.select(cal.year_trimester(F.col("year"), F.col("trimester")).alias("year_trimester"),
                        "year", "trimester").distinct()


def missing_members(candidates: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct candidate rows whose key the dimension does not hold yet."""
    return candidates.dropDuplicates(list(keys)).join(dim.select(*keys), list(keys), "left_anti")


def extended(dim: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The dimension with its missing members appended."""
    return dim.unionByName(missing_members(candidates, dim, keys).select(*dim.columns))


def valid_keys(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is known to the dimension."""
    return df.join(dim.select(*keys).distinct(), list(keys), "left_semi")


def unknown_rows(df: DataFrame, known: DataFrame) -> DataFrame:
    """Set difference over whole rows."""
    return df.subtract(known)
