"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velomesh.session import checkpointed, shared_folder

#: ASCII white space as the contracts name it: space and the controls 9 to 13.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


#: Spark drops a query's shuffle files when it ends, not when the driver's garbage is collected.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str, release: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The result is a plain scan, so a join on it gets an exchange of its own that Spark can split
    where a key is hot; and it survives the loss of any executor. With ``release`` the write's shuffle
    files, which nothing reads any more, go as soon as it ends; the session's setting is put back.
    With ``by`` it is a table bucketed by those columns, whose joins on them need no exchange of it, and more tightly packed.
    """
    path, conf = shared_folder(df.sparkSession, purpose), df.sparkSession.conf
    before = conf.get(DROP_SHUFFLES)
    if release:
        conf.set(DROP_SHUFFLES, "true")
    name = f"{purpose}_{uuid.uuid4().hex[:12]}".replace("-", "_")
    try:
        if by:
            buckets = int(conf.get("spark.sql.shuffle.partitions"))
            df.write.bucketBy(buckets, *by).option("compression", "zstd").saveAsTable(name, format="parquet", path=path)
        else:
            df.write.parquet(path)
    finally:
        conf.set(DROP_SHUFFLES, before)
    if by:
        return df.sparkSession.table(name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """Add ``name``: the position (from 0) of each row in the order given, without a one-task sort.

    Rows are dealt by range and numbered inside their partition; the partitions' row counts, one
    row per partition, give the offsets.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = checkpointed(dealt.withColumn("_part", F.spark_partition_id())
                         .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("_part").agg(F.count("*").alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (dealt.join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_row"))
            .drop("_part", "_row", "_before"))


def whole_groups(batches: Iterable[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Cut a stream sorted by ``key`` into tables of about ``rows`` rows that never split a group."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        cut = int((keys != keys[-1]).sum())
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
        size -= cut
    if held:
        yield pa.Table.from_batches(held)
