"""Latest rows, run thinning, gaps and even sampling over time-ordered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomesh.operators.skew import chunked_lag


def latest_per(df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the latest by ``order``, ties settled by the other columns.

    An aggregate, so a key with very many rows shrinks before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [order, *(tiebreak if tiebreak is not None else [c for c in rest if c != order])]
    rest = [*ranked, *[c for c in rest if c not in ranked]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def latest_value(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """(keys, value) taken from the latest row."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(order, value)).alias(value))


def arg_extreme(df: DataFrame, value: str, tiebreak: Sequence[str], largest: bool = True) -> DataFrame:
    """The single row with the largest or smallest value."""
    first = F.col(value).desc() if largest else F.col(value).asc()
    return df.where(F.col(value).isNotNull()).orderBy(first, *tiebreak).limit(1)


def thin_runs(df: DataFrame, station: str, ts: str, order: Sequence[str], chunk: str, file: str,
              every_s: int = 600) -> DataFrame:
    """Keep a row when its time bucket differs from the station's previous row in file order.

    Rows without a parseable time are always kept and do not end a run; so are rows without a
    station, which counts each as a station of its own. State starts anew per file. ``chunk`` numbers consecutive slices of a file (its splits, say); no task ever sorts more
    than one slice of one station.
    """
    slot = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / every_s)
    marked = df.withColumn("_slot", slot).withColumn("_timed", F.col("_slot").isNotNull() & F.col(station).isNotNull())
    kept = marked.where(~F.col("_timed")).select(*df.columns)
    marked = marked.where("_timed")
    run = chunked_lag(marked, [file, station], chunk, order, "_slot", "_before")
    starts = F.col("_before").isNull() | (F.col("_before") != F.col("_slot"))
    return run.where(starts).select(*df.columns).union(kept)


def thinning_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """(rows_in, rows_kept, rows_skipped, reduction_pct) in one row."""
    kept = after.agg(F.count(F.lit(1))).scalar()
    return (before.agg(F.count(F.lit(1)).alias("rows_in")).withColumn("rows_kept", kept)
            .withColumn("rows_skipped", F.col("rows_in") - F.col("rows_kept"))
            .withColumn("reduction_pct", F.round(F.coalesce(F.try_divide(
                100.0 * F.col("rows_skipped"), F.col("rows_in")), F.lit(0.0)), 1)))


def gaps(df: DataFrame, keys: Sequence[str], ts: str, longer_than_s: float = 303.0) -> DataFrame:
    """(keys, previous, ts, gap_s) where consecutive times lie further apart than the limit.

    Times are sorted day by day; the last time of a day is handed to the next day with rows.
    """
    times = df.select(*keys, F.col(ts).alias("ts")).where(F.col("ts").isNotNull()).distinct()
    times = times.withColumn("_day", F.to_date("ts"))
    lagged = chunked_lag(times, keys, "_day", ["ts"], "ts", "previous")
    span = F.timestamp_diff("MICROSECOND", F.col("previous"), F.col("ts")) / 1e6
    return (lagged.withColumn("gap_s", span).where(F.col("gap_s") > longer_than_s)
            .select(*keys, "previous", F.col("ts").alias(ts), "gap_s"))


def even_sample(df: DataFrame, ts: str, per_day: int = 32) -> DataFrame:
    """(day, ts): at most ``per_day`` evenly spaced distinct times of each day, from the first on.

    Meant for bucketed times (144 ten-minute stamps a day at most).
    """
    stamps = df.select(F.to_date(ts).alias("day"), F.col(ts).alias("ts")).distinct()
    day = Window.partitionBy("day")
    n = F.count(F.lit(1)).over(day)
    i = F.row_number().over(day.orderBy("ts")) - 1
    step = F.when(n > per_day, F.floor(n / per_day)).otherwise(F.lit(1))
    return (stamps.withColumn("_i", i).withColumn("_step", step)
            .where((F.col("_i") % F.col("_step") == 0) & (F.col("_i") / F.col("_step") < per_day))
            .select("day", F.col("ts").alias(ts)))


def within_days(ts: Column, first: str, last: str) -> Column:
    """Date-range filter written on the timestamp itself; on a column of a scan it is pushed down to it."""
    return (ts >= F.lit(first).cast("timestamp_ntz")) & (
        ts < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz"))
