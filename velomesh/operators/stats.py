"""Descriptive statistics, distributions, correlations and reshaping."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomesh.operators.quantiles import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n, mean, std, min, q25, q50, q75, max) with exact quartiles."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])).alias("r")
    ).select("r.*")
    basic = long.groupBy("column_name").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, ["column_name"], "value", QUARTILES)
    return basic.join(q, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"), "max")


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n, n_unique, top, freq) for non-numeric columns."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("r"))
    counts = (pairs.select("r.*").where(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("c")))
    top = F.min(F.struct((-F.col("c")).alias("c"), "value"))
    return (counts.groupBy("column_name")
            .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_unique"), top.alias("t"))
            .select("column_name", "n", "n_unique", F.col("t.value").alias("top"), (-F.col("t.c")).alias("freq")))


def box_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, q25, q50, q75, whisker_low, whisker_high, n_outliers): box-plot numbers per group.

    Whiskers end at the outermost values within 1.5 interquartile ranges of the box.
    """
    q = exact_quantiles(df.where(F.col(by).isNotNull()), [by], value, QUARTILES)
    box = q.select(by, *[F.col("q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))])
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    v = F.col("_v")
    inside = (v >= F.col("q25") - reach) & (v <= F.col("q75") + reach)
    counted = df.groupBy(by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(v.isNotNull()).join(box, by).groupBy(by, "q25", "q50", "q75").agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("n_outliers"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """(bin, low, high, n_rows, density): equal-width bins over the value range, last one closed.

    Empty bins are listed too. ``density`` integrates to one.
    """
    v = F.col(value).cast("double")
    span = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"))).scalar()
    counted = (df.where(v.isNotNull()).select(v.alias("v")).withColumn("s", span)
               .withColumn("bin", F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(
                   F.col("v") - F.col("s.lo"), F.col("s.hi") - F.col("s.lo")) * bins), F.lit(0))).cast("int"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("n_rows")))
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("s", span)
    n = F.coalesce(F.col("n_rows"), F.lit(0))
    return frame.join(counted, "bin", "left").select(
        "bin", (F.col("s.lo") + F.col("bin") * width).alias("low"),
        (F.col("s.lo") + (F.col("bin") + 1) * width).alias("high"), n.alias("n_rows"),
        F.try_divide(n.cast("double"), F.col("s.n") * width).alias("density"))


def kde(df: DataFrame, value: str, points: int = 200) -> DataFrame:
    """(i, x, density): Gaussian kernel density with Scott's bandwidth on an even grid.

    Equal values are counted first; each then adds its weighted kernel to every grid point, summed
    before the shuffle, so a task sends at most ``points`` rows on.
    """
    v = F.col(value).cast("double")
    s = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"),
                        F.stddev_samp(v).alias("sd"))).scalar()
    freq = df.where(v.isNotNull()).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("w")).withColumn("s", s)
    h = F.col("s.sd") * F.pow(F.col("s.n").cast("double"), F.lit(-0.2))
    grid = freq.withColumn("h", h).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("s.lo") + F.col("i") * (F.col("s.hi") - F.col("s.lo")) / (points - 1)
    z = (x - F.col("v")) / F.col("h")
    kernel = F.col("w") * F.exp(-0.5 * z * z) / (F.col("s.n") * F.col("h") * math.sqrt(2 * math.pi))
    return grid.groupBy("i", x.alias("x")).agg(F.sum(kernel).alias("density"))


def correlations(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, a, b, n, r): Pearson r of every column pair over the rows that have both, from one aggregation.

    Means and co-moments are merged across partitions. A column without spread has no coefficient: ``r`` is NULL.
    """
    def moments(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.regr_count(y, x).alias("n"), F.regr_sxx(y, x).alias("sxx"),
                        F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"))
    found = df.groupBy(*by).agg(F.array(*[moments(a, b) for a, b in itertools.combinations(columns, 2)]).alias("m"))
    m = {k: F.col(f"m.{k}") for k in ("a", "b", "n", "sxx", "syy", "sxy")}
    # rounding may carry a perfect fit past one
    r = F.when((m["sxx"] > 0) & (m["syy"] > 0), F.greatest(F.lit(-1.0), F.least(
        F.lit(1.0), F.try_divide(m["sxy"], F.sqrt(m["sxx"]) * F.sqrt(m["syy"])))))
    return (found.select(*by, F.explode("m").alias("m"))
            .select(*by, m["a"], m["b"], m["n"], r.alias("r")))


def _incomplete_beta(a: np.ndarray, b: float, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta by its continued fraction (Lentz), vectorised over a and x."""
    log_gamma = np.vectorize(math.lgamma)
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    tiny = 1e-300
    c = np.ones_like(y)
    d = 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for coef in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)),
                     -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + coef * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + coef / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(p * np.log(y) + q * np.log1p(-y) - log_gamma(p) - log_gamma(q) + log_gamma(p + q)) / p
    value = np.where(y <= 0, 0.0, front * h)
    return np.where(swap, 1 - value, value)


@F.pandas_udf(T.DoubleType())
def pearson_p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p-value of Pearson r over n pairs; only ever runs on the small pair table."""
    dof = n.to_numpy(dtype=float) - 2
    rr = r.to_numpy(dtype=float)
    known = ~np.isnan(rr) & (dof > 0)
    a = np.where(known, dof, 1.0) / 2
    x = np.clip(1 - np.where(known, rr, 0.0) ** 2, 0.0, 1.0)
    return pd.Series(np.where(known, _incomplete_beta(a, 0.5, x), np.nan))


def corr_significance(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), alpha: float = 0.05,
                      min_n: int = 3) -> DataFrame:
    """(by, a, b, n, r, p, p_adj, significant, r_masked) over complete rows.

    p is Bonferroni-adjusted for the number of pairs; groups below ``min_n`` rows are left out.
    """
    k = len(columns) * (len(columns) - 1) // 2
    table = correlations(df.select(*by, *columns).dropna(), columns, by).where(F.col("n") >= min_n)
    table = table.withColumn("p", F.nanvl(pearson_p_value("r", "n"), F.lit(None).cast("double")))
    adjusted = F.least(F.lit(1.0), F.col("p") * k)
    significant = F.coalesce(adjusted < alpha, F.lit(False))
    return (table.withColumn("p_adj", adjusted).withColumn("significant", significant)
            .withColumn("r_masked", F.when(significant, F.col("r"))))


def pivot(df: DataFrame, row: str, column: str, measure: str, values: Sequence[object] | None = None) -> DataFrame:
    """One row per ``row``, one column per value of ``column`` (all that occur, or those listed), sorted by ``row``.

    The values become column names, so they are read first; Spark refuses more than
    ``spark.sql.pivotMaxValues`` of them.
    """
    grouped = df.groupBy(row)
    wide = grouped.pivot(column, list(values)) if values is not None else grouped.pivot(column)
    return wide.agg(F.first(measure, ignorenulls=True)).orderBy(row)


def dense_fill(df: DataFrame, dim_a: DataFrame, a: str, dim_b: DataFrame, b: str, value: str,
               default: float = 0.0) -> DataFrame:
    """Every a with every b, missing values set to ``default``.

    ``dim_b`` is a short calendar list; it is read as one array value and unfolded per row of
    ``dim_a``, so no join without a key is planned.
    """
    listed = dim_b.select(b).distinct().agg(F.array_sort(F.collect_set(b))).scalar()
    frame = dim_a.withColumn(b, F.explode(listed))
    return (frame.join(df.select(a, b, value), [a, b], "left")
            .withColumn(value, F.coalesce(F.col(value), F.lit(default))))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
