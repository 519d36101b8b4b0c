"""Equi-joins and lags that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomesh.session import checkpointed

# Rows of one key that a single task should compare with the other side.
SLICE_ROWS = 100_000


def hot_keys(df: DataFrame, keys: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(keys, fan): every key with more than ``slice_rows`` rows and the slices to cut it into.

    There is at most one such key per ``slice_rows`` rows; the table is counted once and stored.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > slice_rows)
    return checkpointed(counts.select(*keys, F.ceil(F.col("n") / slice_rows).cast("int").alias("fan")))


def unbroadcast(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is shuffled and sorted, never sent whole through the driver.

    Spark sizes a table by its files and takes no account of rows that ``explode`` adds or of compression, so pieces of
    a table far beyond the driver's memory can pass for a small one.
    """
    return df.hint("merge")


def spread_join(big: DataFrame, small: DataFrame, keys: Sequence[str], spread_by: Sequence[str],
                condition: Column | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Inner equi-join that cuts hot keys of ``big`` into slices and copies ``small`` per slice.

    ``big`` is written once; keys are counted on what was written, and a plain join is planned when none is hot.
    ``spread_by`` names columns of ``big`` that differ between rows of one key. Copies add at most one row of
    ``small`` per key and ``slice_rows`` rows of ``big``. The key list is left to Spark's size check; ``small`` is not, see
    ``unbroadcast``.
    """
    big, small = checkpointed(big), unbroadcast(small)
    joined = None
    if big.count() > slice_rows:
        hot = hot_keys(big, keys, slice_rows)
        if not hot.isEmpty():
            joined = _sliced_join(big, small, hot, keys, spread_by)
    if joined is None:
        joined = big.join(small, list(keys))
    return joined if condition is None else joined.where(condition)


def _sliced_join(big: DataFrame, small: DataFrame, hot: DataFrame, keys: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    fan = F.coalesce(F.col("fan"), F.lit(1))
    cut = (big.join(hot, list(keys), "left")
           .select(*big.columns, F.when(fan > 1, F.pmod(F.xxhash64(*spread_by), fan))
                   .otherwise(F.lit(0)).cast("int").alias("slice")))
    copied = (small.join(hot, list(keys), "left")
              .select(*small.columns, F.explode(F.sequence(F.lit(0), fan - 1)).alias("slice")))
    return cut.join(unbroadcast(copied), [*keys, "slice"]).drop("slice")


def chunked_lag(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str],
                value: str, out: str) -> DataFrame:
    """Previous ``value`` per key in (chunk, order) sequence, without sorting a whole key in one task.

    Rows are sorted inside (keys, chunk) only. The last value of each chunk travels to the next
    chunk through a table with one row per (keys, chunk). Chunks must be ordered like the rows.
    """
    inside = Window.partitionBy(*keys, chunk).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(chunk)
    # Wrapped, so that a NULL value in the previous row differs from having no previous row.
    seen = df.withColumn("_prev", F.lag(F.struct(F.col(value).alias("v"))).over(inside))
    tails = (df.groupBy(*keys, chunk)
             .agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_tail"))
             .withColumn("_carry", F.lag("_tail").over(across)).drop("_tail"))
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, chunk)]
    carried = seen.alias("l").join(tails.alias("r"), on, "left")
    previous = F.when(F.col("l._prev").isNotNull(), F.col("l._prev")).otherwise(F.col("r._carry"))
    return carried.select(*[F.col(f"l.{c}") for c in df.columns], previous["v"].alias(out))
