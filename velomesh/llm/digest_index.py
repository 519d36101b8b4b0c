"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. New rows are reduced to one row per digest,
sort-merge anti-joined with the index (whose side needs no shuffle) and appended. All of it is
DataFrame work; nothing runs in Python on the executors.

Defined results: a null text counts as empty; a null identity comes after all others; of rows that agree
in identity and text, one stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velomesh.llm.common import ASCII_SPACE, stored
from velomesh.session import shared_folder


def normalised(text: Column) -> Column:
    """Text with each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), ASCII_SPACE, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def _place(identity: str, row: str) -> Column:
    """Sort key of a row among its equals: nulls last, then identity, then the row's own number."""
    return F.struct(F.col(identity).isNull().alias("absent"), F.col(identity).alias("doc_id"), F.col(row).alias("row_id"))


class DigestIndex:
    """A table (digest, keep_id, keep_row) with one row for each digest ever seen.

    ``path`` outlives the session: opening the same path again finds the rows of earlier sessions. Give
    about one bucket for every few hundred megabytes of digests expected; the number is fixed when the
    index is made.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or shared_folder(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, keep_row BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, firsts: DataFrame) -> DataFrame:
        """Rows of ``firsts`` (one per digest) whose digest the index lacks."""
        return firsts.hint("merge").join(self.rows().select("digest"), "digest", "left_anti")

    def append(self, batch: DataFrame) -> None:
        """Add the digests of ``batch`` (digest, doc_id, row_id) that are new, with their first rows.

        Running the same batch again adds nothing, so a job that broke off can simply be repeated.
        """
        firsts = (batch.groupBy("digest").agg(F.min(_place("doc_id", "row_id")).alias("first"))
                  .select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row_id").alias("keep_row")))
        fresh = self.unseen(firsts).select("digest", "keep_id", "keep_row")
        fresh.repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, row_id, digest) of every row, stored so that row numbers stay what they are."""
    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.monotonically_increasing_id().alias("row_id"), digest(F.col("text")).alias("digest")),
                  "digests")


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, batches: int = 2) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``docs`` enters the index in ``batches`` slices of ascending identity, each deduplicated against all
    before it; so on an index that starts empty the smallest identity of each text stays. ``keep_id`` may
    name a document of an earlier load; ``group_size`` counts rows of ``docs``.
    """
    spark = docs.sparkSession
    index = index or DigestIndex(spark)
    rows = digests(docs)
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        index.append(rows)
    else:
        cuts = [low + (high - low + 1) * k // batches for k in range(1, batches)]
        slice_of = sum((F.coalesce(F.col("doc_id") >= c, F.lit(True)).cast("int") for c in cuts), F.lit(0))
        for k in range(batches):
            index.append(rows.where(slice_of == k))
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = stored(sizes.hint("merge").join(index.rows(), "digest"), "digest-groups")
    found = rows.hint("merge").join(groups, "digest")
    return found.select("doc_id", "keep_id", "group_size",
                        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row_id") == F.col("keep_row"))).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text, in its own columns."""
    kept = (deduplicate(docs).where("kept")
            .select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_digest")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       F.col("doc_id").cast("long").alias("_own"), digest(F.col("text")).alias("_own_digest"))
    same = rows.join(kept, (F.col("_own_digest") == F.col("_digest")) & F.col("_own").eqNullSafe(F.col("_id")), "left_semi")
    return same.dropDuplicates(["_own_digest"]).select("_doc.*")
