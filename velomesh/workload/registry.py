"""Named queries over the test tables, each with the operators it shows and its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomesh.workload.sqltext import query

Job = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    covers: tuple[str, ...]
    run: Job
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Dates, times and decimals in forms every engine prints alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str, covers: str, sql: str | None = None) -> Callable[[Job], Job]:
    """Add a query; ``sql`` may use the derived inputs of ``sqltext`` as tables."""
    def add(job: Job) -> Job:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(job(spark, folder))
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Entry(name, tuple(covers.split()), run, query(sql) if sql else None)
        return job
    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})
