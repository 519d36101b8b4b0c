"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUNTIME = {
    # Wall-clock semantics: every timestamp is read and printed in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Geometry is heavy on processors and light on bytes, so even small shuffles stay spread out.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    # Month reloads replace only the months they carry.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_STATIC = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Plans here are long; recording a Python call site per expression would dominate their build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "velomesh", driver_memory: str | None = None) -> SparkSession:
    """Session for tests, benches and jobs, with the settings the operators rely on.

    A cluster passes its own master and sizes. Sessions made elsewhere are used as they are: they need
    the UTC time zone, and otherwise work with Spark's defaults.
    """
    builder = SparkSession.builder.appName(app).config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (_RUNTIME | _STATIC).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _one_machine(master: str) -> bool:
    """Whether driver and tasks share one process, and so any folder."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def _shared_base(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one-process sessions without it get one of their own."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not _one_machine(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="velomesh-")
        context.setCheckpointDir(base)
    return base.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """Name of a new sub-folder of the folder every executor can reach."""
    return f"{_shared_base(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Used where a result feeds several branches: the work is done once and survives lost executors.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared_base(df.sparkSession))
    return df.checkpoint(eager=True)
