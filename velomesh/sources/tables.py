"""Table sinks and idempotent steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomesh.operators.dims import missing_members


def publish(df: DataFrame, table: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write a managed table in one go: ``overwrite``, ``append`` or ``error``.

    A table that is replaced is built beside the old one, which goes only when the new one stands.
    """
    spark = df.sparkSession
    swap = mode == "overwrite" and spark.catalog.tableExists(table)
    name = f"{table}__{uuid.uuid4().hex[:8]}" if swap else table
    writer = df.write.mode("error" if swap else mode).format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    if swap:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {table}")


def exists_and_filled(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and not spark.table(table).isEmpty()


def require_tables(spark: SparkSession, tables: Sequence[str]) -> None:
    absent = [t for t in tables if not spark.catalog.tableExists(t)]
    if absent:
        raise LookupError(f"build these tables first: {absent}")


def ensure_step(spark: SparkSession, table: str, build: Callable[[], DataFrame], force: bool = False,
                needs: Sequence[str] = (), partition_by: Sequence[str] = ()) -> bool:
    """Build ``table`` unless it already has rows; ``force`` rebuilds. True when it was built.

    A failing step raises, so nothing downstream runs on half-built tables.
    """
    require_tables(spark, needs)
    if not force and exists_and_filled(spark, table):
        return False
    publish(build(), table, "overwrite", partition_by)
    return True


def ensure_files(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The parquet table at ``path``, built first unless it is there with rows; ``force`` rebuilds."""
    if not force:
        try:
            ready = spark.read.parquet(path)
            if not ready.isEmpty():
                return ready
        except AnalysisException:
            pass
    build().write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.parquet(path)


def insert_missing(spark: SparkSession, candidates: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Append the members the dimension table does not hold yet."""
    dim = spark.table(table)
    publish(missing_members(candidates, dim, keys).select(*dim.columns), table, "append")


def write_monthly(df: DataFrame, path: str, ts: str, partition: str = "year_month") -> None:
    """Replace exactly the months that ``df`` carries, all months in one job.

    Rebalancing by month sizes the files and splits a month that holds most of the rows.
    """
    keyed = df.withColumn(partition, F.date_format(ts, "yyyy-MM")).hint("rebalance", partition)
    (keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
