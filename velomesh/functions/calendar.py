"""Calendar keys, ten-minute buckets and display labels. Buckets are ``timestamp_ntz``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trunc(unit: str, ts: Column) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def time_floor(ts: Column, minutes: int = 10) -> Column:
    """Start of the ``minutes``-wide bucket counted from the full hour."""
    into_hour = (F.minute(ts) - F.minute(ts) % F.lit(minutes)).cast("int")
    return trunc("hour", ts) + F.make_dt_interval(mins=into_hour)


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def day_part(ts: Column) -> Column:
    h = F.hour(ts)
    return (F.when(h.between(5, 11), "morning").when(h.between(12, 16), "afternoon")
            .when(h.between(17, 20), "evening").otherwise("night"))


def year_trimester(year: Column, trimester: Column) -> Column:
    """``year-trimester``; a missing part counts as empty text."""
    empty = F.lit("")
    return F.concat(F.coalesce(year.cast("string"), empty), F.lit("-"),
                    F.coalesce(trimester.cast("string"), empty))


def trimester_year(key: Column) -> Column:
    return F.left(key, F.lit(4)).try_cast("int")


def clock_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def hour_fraction(ts: Column) -> Column:
    return F.hour(ts) + F.minute(ts) / F.lit(60.0)


def ordinal_date_label(ts: Column) -> Column:
    """``Saturday, 1st of June, 2019``."""
    d = F.dayofmonth(ts)
    last = d % 10
    suffix = (F.when(d.between(4, 20) | d.between(24, 30), "th")
              .when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th"))
    return F.concat(F.date_format(ts, "EEEE"), F.lit(", "), d.cast("string"), suffix,
                    F.lit(" of "), F.date_format(ts, "MMMM"), F.lit(", "), F.date_format(ts, "yyyy"))


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")
