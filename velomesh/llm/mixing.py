"""Mixing sources to target weights with hash-threshold histograms.

Every document gets a fixed hash of its identity. A source's budget beyond whole passes is met by taking
the documents whose hash lies below a threshold. The threshold comes from nested histograms: words
summed by source and leading hash bits, then again inside the one bucket where the running sum crosses
the budget, until that bucket holds a single hash. Larger budgets take supersets of smaller ones, no row
is sorted, and a rerun takes the same documents. All of it is DataFrame work.

Defined results: a null text has size 0 and takes nothing; a null source is a source of its own and comes
last; a null identity hashes like an empty one; rows with equal identity share their fate; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velomesh.llm.common import numbered, stored
from velomesh.session import checkpointed

WORDS = r"[^\x20\x09-\x0D]+"
#: Each document's hash has 60 bits; each histogram looks at 12 of them.
HASH_BITS, STEP_BITS = 60, 12
#: No source gives more than this many times its size.
PASSES = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)


def words(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def unit_hash(identity: str = "doc_id"):
    """The first 15 hexadecimal digits of the identity's MD5 as a number."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(identity).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, passes, rest) from rows of (source, size).

    Weights share the total. A target above ``PASSES`` times its source's size stops there and the
    excess is shared anew by weight, until none is above. The level rises from round to round; only
    the two sums that fix it come to the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(totals, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = checkpointed(ranked.select("source", "source_size", weight.cast("long").alias("weight")))
    cap = F.col("source_size") * PASSES
    total, weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (total or 0, weights or 1)
    while True:
        capped = cap * level[1] < F.col("weight") * level[0]
        row = ranked.agg(F.sum(F.when(capped, cap).otherwise(0)).alias("c"),
                         F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("w")).first()
        new = ((total or 0) - (row["c"] or 0), row["w"] or 1)
        if new == level or not total:
            break
        level = new
    share = F.col("weight") * level[0]
    target = F.when(capped, cap.cast("double")).otherwise(share.cast("double") / F.lit(float(level[1])))
    passes = (F.when(F.col("source_size") == 0, 0).when(capped, PASSES)
              .otherwise(F.expr(f"(weight * {level[0]}L) div ({level[1]}L * greatest(source_size, 1L))")))
    return (ranked.withColumn("target", target).withColumn("passes", passes.cast("long"))
            .select("source", "source_size", "target", "passes",
                    (F.col("target") - (F.col("passes") * F.col("source_size")).cast("double")).alias("rest")))


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, threshold): documents of the source with a smaller hash add up to its ``rest``.

    ``rows`` has source, size and hash. Each round joins only the rows of the boundary buckets. Where
    the sum crosses inside the documents of one hash, they are taken if that comes nearer.
    """
    found = []
    state = checkpointed(goals.where("rest > 0").select(
        F.col("source").alias("_source"), F.lit(0).cast("long").alias("_prefix"), "rest"))
    for depth in range(STEP_BITS, HASH_BITS + 1, STEP_BITS):
        inside = (rows.join(state, rows["source"].eqNullSafe(state["_source"])
                            & (F.shiftright(rows["hash"], HASH_BITS - depth + STEP_BITS) == state["_prefix"]))
                  .where("size > 0"))
        bucket = F.shiftright(F.col("hash"), HASH_BITS - depth)
        sums = inside.groupBy("_source", "rest", bucket.alias("bucket")).agg(
            F.sum("size").alias("own"), F.min("hash").alias("least"), F.max("hash").alias("most"))
        upto = Window.partitionBy("_source").orderBy("bucket")
        crossed = (sums.withColumn("upto", F.sum("own").over(upto))
                   .withColumn("rest", F.col("rest") - (F.col("upto") - F.col("own")).cast("double"))
                   .where((F.col("rest") >= 0) & (F.col("own") > F.col("rest"))))
        crossed = checkpointed(crossed.select("_source", "bucket", "rest", "own", "least", "most"))
        single = F.col("least") == F.col("most")
        found.append(crossed.where(single).select(
            F.col("_source").alias("source"),
            (F.col("least") + (F.col("rest") * 2 > F.col("own")).cast("long")).alias("threshold")))
        state = crossed.where(~single).select("_source", F.col("bucket").alias("_prefix"), "rest")
        if state.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows (doc_id, source, size, hash) and one goal per source with its threshold."""
    rows = stored(docs.select("doc_id", "source", words().alias("size"), unit_hash().alias("hash")), "mix-rows")
    goals = checkpointed(targets(rows))
    limits = thresholds(rows, goals).select(F.col("source").alias("_s"), "threshold")
    goals = goals.join(limits, goals["source"].eqNullSafe(limits["_s"]), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "passes",
        F.coalesce("threshold", F.lit(0)).alias("threshold"))
    return rows, stored(goals, "mix-goals")


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    rows, goals = plan(docs)
    copies = F.col("passes") + (F.col("hash") < F.col("threshold")).cast("long")
    return (rows.join(goals, rows["source"].eqNullSafe(goals["_source"]))
            .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, in its own columns."""
    _, goals = plan(docs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("source").alias("_own"),
                       words().alias("_size"), unit_hash().alias("_hash"))
    copies = F.col("passes") + (F.col("_hash") < F.col("threshold")).cast("long")
    return (rows.join(goals, rows["_own"].eqNullSafe(goals["_source"])).where("_size > 0")
            .select("_doc", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
            .select("_doc.*"))
