"""Profiles, row audits and key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, total_rows, missing_count, missing_pct), one scan for all columns."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing_count"))
                               for i, c in enumerate(columns)]))
    return (counts.select("total_rows", rows.alias("r"))
            .select("r.column_name", "total_rows", "r.missing_count",
                    F.round(F.try_divide(100.0 * F.col("r.missing_count"), F.col("total_rows")), 2)
                    .alias("missing_pct")))


def needs_imputation(df: DataFrame, columns: Sequence[str], threshold_pct: float = 0.1) -> bool:
    """Gate: does any column miss more than the threshold? Reads one row per column."""
    return not missing_profile(df, columns).where(F.col("missing_pct") > threshold_pct).isEmpty()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pass ``df`` on, or raise when a key repeats."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate rows for key {list(keys)}")
    return df


def row_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for every table given."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n_rows, share_pct), most frequent first."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    return (counts.withColumn("share_pct", F.round(100.0 * F.col("n_rows") / total, 2))
            .orderBy(F.col("n_rows").desc(), "value"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_distinct): one de-duplication over (column, value) pairs."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"))
                                for c in columns]))
    return (df.select(pairs.alias("p")).select("p.*").where(F.col("v").isNotNull()).distinct()
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct")))
