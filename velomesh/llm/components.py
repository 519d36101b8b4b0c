"""Connected components by alternating star steps; every step is a shuffle, nothing is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each node to the least of them: the larger ones, or the node and its smaller ones."""
    if large:
        edges = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")), "components")
        linked = edges.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        least = stored(edges.groupBy("a").agg(F.min("b").alias("root")), "components")
        linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        linked = linked.union(least.select("a", F.col("root").alias("b")))
    return stored(linked.where("a <> b").distinct(), "components")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node reachable.

    The number of rounds grows with the logarithm of the longest chain; edges never outgrow the nodes
    by more than the input did.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(ordered.distinct(), "components")
    state = _state(edges)
    while state[0]:
        edges = _star(_star(edges, large=True), large=False)
        state, last = _state(edges), state
        if state == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
