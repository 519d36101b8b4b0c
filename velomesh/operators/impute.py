"""Filling gaps from the group's own history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.operators.quality import needs_imputation
from velomesh.operators.quantiles import exact_quantiles


def group_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, median_<column>...): exact medians of several columns in one pass over long rows."""
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])).alias("r"))
    medians = exact_quantiles(long.select(*keys, "r.name", "r.value"), [*keys, "name"], "value", [0.5])
    return medians.groupBy(*keys).agg(*[
        F.max(F.when(F.col("name") == c, F.col("q")[0])).alias(f"median_{c}") for c in columns])


def group_mode(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys, mode_<column>): most frequent value, the smallest among equals."""
    counts = (df.where(F.col(column).isNotNull()).groupBy(*keys, column)
              .agg(F.count(F.lit(1)).alias("_n")))
    # Largest count first, then smallest value: the smallest (-n, value) pair.
    return (counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v"))).alias("_m"))
            .select(*keys, F.col("_m.v").alias(f"mode_{column}")))


def impute(df: DataFrame, keys: Sequence[str], rules: Mapping[str, str], threshold_pct: float | None = 0.1,
           gate_columns: Sequence[str] | None = None, default: object = None) -> DataFrame:
    """Replace NULLs by the group's ``median`` or ``mode``; rows with NULL keys keep their NULLs.

    With a threshold, nothing happens unless a gate column misses more than that share; ``None``
    imputes always. Columns filled by median are double, whether or not anything is filled.
    """
    medians = [c for c, rule in rules.items() if rule == "median"]
    if threshold_pct is not None and not needs_imputation(df, list(gate_columns or rules), threshold_pct):
        return df.withColumns({c: F.col(c).cast("double") for c in medians}) if medians else df
    keyed = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    out = df
    if medians:
        out = out.join(group_medians(keyed, keys, medians), list(keys), "left")
    for c, rule in rules.items():
        if rule == "mode":
            out = out.join(group_mode(keyed, keys, c), list(keys), "left")
    fallback = [] if default is None else [F.lit(default)]
    filled = [F.coalesce(F.col(c), F.col(f"{rules[c]}_{c}"), *fallback).alias(c) if c in rules else F.col(c)
              for c in df.columns]
    return out.select(*filled)
