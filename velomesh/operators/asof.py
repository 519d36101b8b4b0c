"""Nearest-time join between a day's fixed steps and the rows of each area."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Ten-minute steps from 00:00 to 24:00 and the tolerance of a quarter of an hour.
STEPS_PER_DAY = 145
STEP_SECONDS = 600
TOLERANCE_SECONDS = 900


def nearest_time_join(rows: DataFrame, area: str, ts: str, present: str, tolerance_s: int = TOLERANCE_SECONDS,
                      step_s: int = STEP_SECONDS, steps: int = STEPS_PER_DAY, fallback: bool = True) -> DataFrame:
    """For each date, step and area the row nearest in time within the tolerance.

    ``present`` must be set for a row to be usable; the nearest row decides, usable or not. A step
    without any usable row takes, for every area, the row nearest to the date's time closest to
    that step, however far. Ties go to the earlier row. Output: rows' columns plus ``date_value``,
    ``step``, ``gap_s`` and ``is_fallback``.

    A row is offered only to the steps its tolerance reaches, so work grows with the rows.
    """
    cols = rows.columns
    timed = (rows.withColumn("date_value", F.to_date(ts))
             .withColumn("_s", F.hour(ts) * 3600 + F.minute(ts) * 60)
             .withColumn("_row", F.struct(*cols)).select("date_value", area, "_s", "_row"))
    low = F.greatest(F.lit(0), F.ceil((F.col("_s") - tolerance_s) / step_s)).cast("int")
    high = F.least(F.lit(steps - 1), F.floor((F.col("_s") + tolerance_s) / step_s)).cast("int")
    offered = (timed.where(low <= high).withColumn("step", F.explode(F.sequence(low, high)))
               .withColumn("gap_s", F.abs(F.col("_s") - F.col("step") * step_s)))
    near = (offered.groupBy("date_value", area, "step")
            .agg(F.min(F.struct("gap_s", "_s", "_row")).alias("_b"))
            .select("date_value", area, "step", "_b.gap_s", "_b._row")
            .where(F.col(f"_row.{present}").isNotNull()))
    out = near.withColumn("is_fallback", F.lit(False))
    if fallback:
        out = out.unionByName(_fallback(timed, near, area, present, step_s, steps))
    return out.select("date_value", "step", *[F.col(f"_row.{c}").alias(c) for c in cols if c != "date_value"],
                      "gap_s", "is_fallback")


def _fallback(timed: DataFrame, near: DataFrame, area: str, present: str, step_s: int, steps: int) -> DataFrame:
    # A date has at most 1,440 distinct minutes, which bounds every array and window below.
    times = timed.groupBy("date_value").agg(F.array_sort(F.collect_set("_s")).alias("_times"))
    filled = near.select("date_value", "step").distinct().withColumn("_filled", F.lit(True))
    empty = (times.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
             .join(filled, ["date_value", "step"], "left").where(F.col("_filled").isNull()))
    at = F.array_min(F.transform(F.col("_times"), lambda t: F.struct(
        F.abs(t - F.col("step") * step_s).alias("gap"), t.alias("t"))))["t"]
    wanted = empty.select("date_value", "step", at.alias("_target"))
    # Per area and date: the last row at or before, and the first row at or after, each target.
    targets = wanted.select("date_value", "_target").distinct()
    areas = timed.select("date_value", area).distinct().join(targets, "date_value")
    marks = areas.select("date_value", area, F.col("_target").alias("_s"), F.lit(None).cast(
        timed.schema["_row"].dataType).alias("_row"))
    line = timed.withColumn("_at", F.col("_s")).unionByName(marks.withColumn("_at", F.lit(None).cast("int")))
    day = Window.partitionBy("date_value", area).orderBy("_s")
    back, ahead = day.rangeBetween(Window.unboundedPreceding, 0), day.rangeBetween(0, Window.unboundedFollowing)
    seen = F.struct(F.col("_at").alias("t"), F.col("_row").alias("r"))
    known = F.when(F.col("_at").isNotNull(), seen)
    both = (line.withColumn("_p", F.last(known, True).over(back)).withColumn("_n", F.first(known, True).over(ahead))
            .where(F.col("_at").isNull()))
    gap_p, gap_n = F.col("_s") - F.col("_p.t"), F.col("_n.t") - F.col("_s")
    pick = F.when(gap_n.isNull() | (gap_p <= gap_n), F.col("_p")).otherwise(F.col("_n"))
    chosen = (both.withColumn("_c", pick)
              .select("date_value", area, F.col("_s").alias("_target"), F.abs(F.col("_c.t") - F.col("_s")).alias("gap_s"),
                      F.col("_c.r").alias("_row"))
              .where(F.col(f"_row.{present}").isNotNull()))
    return (wanted.join(chosen, ["date_value", "_target"])
            .select("date_value", area, "step", "gap_s", "_row", F.lit(True).alias("is_fallback")))
