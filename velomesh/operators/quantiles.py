"""Exact order statistics that never gather one group's values in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomesh.session import checkpointed

# Bins per refinement. Two refinements split a group into BINS * BINS slots, of which only the
# slots holding a wanted rank are ever sorted.
BINS = 1024
# Different values a slot may hold when it is sorted; larger ones are split again, by pivots of their own values:
# PIVOTS runs of PIVOTS each.
SLOT, PIVOTS = 100_000, 64


def _ranks(n: Column, probs: Sequence[float]) -> Column:
    """Zero-based ranks needed to interpolate the given probabilities among n values."""
    at = [(n - 1) * F.lit(float(p)) for p in probs]
    return F.array_distinct(F.array(*[f(a).cast("long") for a in at for f in (F.floor, F.ceil)]))


def _even(v: Column) -> Column:
    """Values over many magnitudes on one scale; never decreasing, so bins keep the order."""
    return F.signum(v) * F.log1p(F.abs(v) * 1e12)


def _narrow(freq: DataFrame, keys: list[str], scale: Callable[[Column], Column] = lambda v: v) -> DataFrame:
    """Keep only the values whose bin holds a wanted rank; ranks become relative to the bin."""
    low, high = scale(F.col("_lo")), scale(F.col("_hi"))
    position = F.try_divide(scale(F.col("_v")) - low, high - low) * BINS
    binned = freq.withColumn("_bin", F.least(F.lit(BINS - 1), F.coalesce(
        F.floor(position).cast("int"), F.lit(0))))
    return _picked(binned, keys)


def _picked(binned: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the bins that hold a wanted rank, with the bin's range and the ranks inside it."""
    bins = binned.groupBy(*keys, "_bin").agg(
        F.sum("_n").alias("_in"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi"),
        F.first("_want").alias("_want"))
    # At most as many rows per group in this window as there are bins.
    w = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_in").over(w), F.lit(0))
    picked = (bins.withColumn("_before", before)
              .withColumn("_local", F.transform(
                  F.filter(F.col("_want"), lambda r: (r["at"] >= F.col("_before"))
                           & (r["at"] < F.col("_before") + F.col("_in"))),
                  lambda r: F.struct((r["at"] - F.col("_before")).alias("at"), r["rank"].alias("rank"))))
              .where(F.size("_local") > 0)
              .select(*keys, "_bin", "_blo", "_bhi", "_local"))
    return (binned.drop("_lo", "_hi", "_want").join(picked, [*keys, "_bin"])
            .select(*keys, "_bin", "_v", "_n", F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"),
                    F.col("_local").alias("_want")))


def _split(rows: DataFrame, large: DataFrame, keys: list[str]) -> DataFrame:
    """Split the slots ``large`` into bins of about equally many values, however those lie; others stay whole."""
    shares = [k / PIVOTS ** 2 for k in range(PIVOTS ** 2)]
    runs = F.transform(F.sequence(F.lit(0), F.lit(PIVOTS - 1)), lambda k: F.slice("_p", k * PIVOTS + 1, PIVOTS))
    drawn = rows.join(large, keys, "left_semi").groupBy(*keys).agg(
        F.percentile_approx("_v", shares, 5 * PIVOTS ** 2).alias("_p")).select(*keys, runs.alias("_runs"))
    # the run a value belongs to, then its place inside; the first pivot is the slot's least value
    run = F.greatest(F.size(F.filter("_runs", lambda r: r[0] <= F.col("_v"))), F.lit(1))
    placed = rows.join(drawn, keys, "left").withColumn("_run", run)
    place = F.col("_run") * PIVOTS + F.size(F.filter(F.get("_runs", F.col("_run") - 1), lambda x: x <= F.col("_v")))
    slot, part = F.struct("_bin1", "_bin"), F.when(F.col("_runs").isNull(), 0).otherwise(place)
    return _picked(placed.withColumns({"_bin1": slot, "_bin": part}).drop("_runs", "_run", "_lo", "_hi"), keys[:-1])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """(keys, q: array<double>) with linear interpolation, NULL values left out.

    Equal values are counted first, so repeated readings cost one row. Two rounds of bins, by magnitude
    and then of equal width, single out the few values around each wanted rank. Where values lie so unevenly that more
    than ``SLOT`` are left, the slot is split by its own pivots until no slot holds more; only then is it sorted.
    ``keys`` must not be NULL and may be empty for the whole table.
    """
    keys = list(keys)
    group = keys or ["_all"]
    base = df if keys else df.withColumn("_all", F.lit(1))
    freq = (base.where(F.col(value).isNotNull())
            .groupBy(*group, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    sizes = freq.groupBy(*group).agg(F.sum("_n").alias("_total"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = sizes.withColumn("_want", F.transform(
        _ranks(F.col("_total"), probs), lambda r: F.struct(r.alias("at"), r.alias("rank"))))
    rows = _narrow(freq.join(wanted.drop("_total"), group), group, _even)
    rows = _narrow(rows.withColumnRenamed("_bin", "_bin1"), [*group, "_bin1"])
    slots, rows = [*group, "_bin1", "_bin"], checkpointed(rows)
    while True:
        large = checkpointed(rows.groupBy(*slots).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > SLOT).select(*slots))
        if large.isEmpty():
            break
        rows = checkpointed(_split(rows, large, slots))
    slot = Window.partitionBy(*group, "_bin1", "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(slot), F.lit(0))
    hits = (rows.withColumn("_before", before)
            .withColumn("_hit", F.explode(F.filter(F.col("_want"), lambda r: (
                r["at"] >= F.col("_before")) & (r["at"] < F.col("_before") + F.col("_n")))))
            .groupBy(*group).agg(F.map_from_entries(F.collect_list(
                F.struct(F.col("_hit.rank"), F.col("_v")))).alias("_at")))
    n = F.col("_total")

    def interpolated(p):
        pos = (n - 1) * F.lit(float(p))
        low, high = F.floor(pos).cast("long"), F.ceil(pos).cast("long")
        v0, v1 = F.element_at("_at", low), F.element_at("_at", high)
        return v0 + (v1 - v0) * (pos - low)
    out = hits.join(sizes.select(*group, "_total"), group)
    return out.select(*keys, F.array(*[interpolated(p) for p in probs]).alias("q"))
