"""Nearest neighbours by inner product with a hash-prefix forest.

Each tree gives a vector a long hash string; a symbol of it is the largest, with sign, of its coordinates along a
few random orthogonal directions. Sorted strings put vectors with a long common prefix side by side. A query descends in
all trees to its longest prefixes, then ascends in all of them at once, a symbol at a time, until the
prefixes it shares hold enough candidates. What is enough is measured: on a bounded sample of queries,
answered exactly, the least number that finds the share ``recall`` of their neighbours.

On the cluster a prefix is a cell. Cell sizes are counted once; each query is sent to its cells only, each vector
to its cell in every tree at the lengths that queries stop at. Large cells are cut: queries and vectors
of a cell meet block by block. Equal vectors are one entry, so copies cost nothing.

Vectors of different length are lifted to one length by one more coordinate, which leaves the order of
inner products unchanged.

Defined results: vectors that are null, empty, zero, or hold a null or a value that is not finite take no part, neither
as queries nor as candidates; equal vectors tie and go by smaller identity; rows of equal
identity and vector are one; rows of equal identity and different vectors are different rows, each a query with
ranks of its own and a candidate of the others; vectors of another length than the most frequent one take no part; a
query with fewer candidates than asked for gets all; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomesh.llm.common import numbered, stored, whole_groups
from velomesh.session import checkpointed

#: Trees; queries answered exactly to fit the number of candidates; share of neighbours to find there.
TREES, FIT_QUERIES, RECALL = 28, 200, 0.95
#: Coordinates a symbol is chosen from. Fewer make coarser cells, which need fewer trees and so fewer copies of a vector.
WIDTH = 16
#: Cells above this many vectors, or this share of all, are cut; likewise for queries.
CELL_ROWS, CELL_QUERIES, CELL_SHARE = 4096, 1024, 1000
#: Share of the sampled queries that may hold less than the number of candidates asked for.
SHORT = 0.05
#: The sides that meet in a cell, queries first.
ASKS, ROWS = 0, 1
SEED = 7


@lru_cache(maxsize=1)
def rotations(dim: int, trees: int, depth: int) -> np.ndarray:
    """Matrices of ``WIDTH`` random orthogonal directions, one per tree and symbol."""
    rng = np.random.default_rng([SEED, dim])
    return np.stack([np.linalg.qr(rng.normal(size=(dim, min(dim, WIDTH))))[0] for _ in range(trees * depth)]).astype(np.float32)


def strings(vectors: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Hash strings: (rows, trees, depth) symbols below ``symbols_of(dim)``."""
    turned = rotations(vectors.shape[1], trees, depth)
    out = np.empty((len(vectors), trees * depth), np.int64)
    every = np.arange(len(vectors))
    v = vectors.astype(np.float32)
    for k, r in enumerate(turned):
        y = v @ r
        top = np.abs(y).argmax(1)
        out[:, k] = 2 * top + (y[every, top] < 0)
    return out.reshape(len(vectors), trees, depth)


def symbols_of(dim: int) -> int:
    return 2 * min(dim, WIDTH)


def prefixes(symbols: np.ndarray, base: int) -> np.ndarray:
    """Prefix numbers (rows, trees, depth): the first symbols read as digits."""
    out = symbols.copy()
    for k in range(1, out.shape[2]):
        out[:, :, k] += out[:, :, k - 1] * base
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), len(values) // max(len(flat), 1))


def usable(vector: str) -> Column:
    v = F.col(vector)
    return (v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
            & F.exists(v, lambda x: x != 0))


@dataclass(frozen=True)
class Shape:
    """What a task needs to hash vectors."""

    dim: int
    longest: float
    trees: int
    depth: int
    kind: str  # Spark's type of a vector, as narrow as the table's own

    def lifted(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Vectors of equal length in one more dimension; queries stay in their plane."""
        if query:
            return np.concatenate((v / np.linalg.norm(v, axis=1, keepdims=True), np.zeros((len(v), 1))), 1)
        v = v / self.longest
        return np.concatenate((v, np.sqrt(np.maximum(0.0, 1.0 - (v * v).sum(1, keepdims=True)))), 1)

    def prefixes(self, v: np.ndarray, query: bool) -> np.ndarray:
        return prefixes(strings(self.lifted(v, query), self.trees, self.depth), symbols_of(self.dim + 1))


@dataclass(frozen=True)
class Forest:
    """The index: entries (entry, vector, ids), their number, and the shape of their strings."""

    entries: DataFrame
    count: int
    shape: Shape


def vector_kind(vectors: DataFrame) -> str:
    """Vectors travel once per tree, so single precision stays single."""
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    return "array<float>" if single else "array<double>"


def build(vectors: DataFrame, k: int, trees: int = TREES) -> Forest:
    """Index of all rows (vec_id, embedding); of equal vectors the ``k + 1`` least identities are kept.

    More cannot appear in a result of ``k``. Strings are long enough for the table: the number of
    symbols grows with the logarithm of the entries.
    """
    kind = vector_kind(vectors)
    good = vectors.where(usable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    sizes = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = sizes["d"] if sizes else 1
    order = Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last())
    few = (good.where((F.size("v") == dim) & F.col("vec_id").isNotNull()).distinct()
           .withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1))
    entries = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("v").alias("vector"), "ids")
    # numbered by least identity, so that ties between entries go as ties between identities
    entries = stored(numbered(entries, [F.element_at("ids", 1), F.xxhash64("vector")], "entry").select("entry", "vector", "ids"), "forest-entries")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    count, longest = entries.agg(F.count("*"), F.max(norm)).first()
    base = symbols_of(dim + 1)
    depth = max(2, math.ceil(math.log(max(count, 2) / 20) / math.log(base)) + 1) if count > 20 else 2
    depth = min(depth, int(62 / math.log2(base)))
    return Forest(entries, count, Shape(dim, float(longest or 1.0) * (1 + 1e-12), trees, depth, kind))


def cell_sizes(forest: Forest) -> DataFrame:
    """(tree, length, prefix, n): entries in each cell; tasks add up what they hold first."""
    shape = forest.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = shape.prefixes(_matrix(b.column("vector")), query=False)
            for t in range(shape.trees):
                for d in range(shape.depth):
                    kinds, n = np.unique(p[:, t, d], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), x, np.int32)) for x in (t, d + 1)]
                                                     + [pa.array(kinds), pa.array(n.astype(np.int64))], ["tree", "length", "prefix", "n"])

    parts = forest.entries.select("vector").mapInArrow(run, "tree int, length int, prefix long, n long")
    return stored(parts.groupBy("tree", "length", "prefix").agg(F.sum("n").alias("n")), "forest-cells")


def _query_cells(forest: Forest, queries: DataFrame, cells: DataFrame) -> DataFrame:
    """(entry, tree, length, prefix, n) of every query in every tree at every length, stored."""
    shape = forest.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = shape.prefixes(_matrix(b.column("vector")), query=True)
            ids = b.column("entry").to_numpy()
            trees, depth = p.shape[1:]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, trees * depth)),
                 pa.array(np.tile(np.repeat(np.arange(trees, dtype=np.int32), depth), len(ids))),
                 pa.array(np.tile(np.arange(1, depth + 1, dtype=np.int32), len(ids) * trees)), pa.array(p.ravel())],
                ["entry", "tree", "length", "prefix"])

    asked = queries.mapInArrow(run, "entry long, tree int, length int, prefix long")
    return stored(asked.join(cells, ["tree", "length", "prefix"], "left").withColumn("n", F.coalesce("n", F.lit(0))), "forest-queries")


def _top(q: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's ``k`` best rows and all that tie with the last."""
    near = q @ rows.T
    if near.shape[1] > k:
        limit = np.partition(near, near.shape[1] - k, 1)[:, -k] - 1e-9 * (1 + np.abs(near).max())
        i, j = np.nonzero(near >= limit[:, None])
    else:
        i, j = np.divmod(np.arange(near.size), near.shape[1])
    return i, j, (q[i] * rows[j]).sum(1)


def _exact(forest: Forest, queries: DataFrame, k: int) -> DataFrame:
    """(query, entry, vector, score): the sample's exact neighbours among all entries, in blocks."""
    chosen = queries.toPandas()  # FIT_QUERIES rows at most
    ids = chosen["entry"].to_numpy()
    q = np.array(chosen["vector"].tolist(), dtype=np.float64).reshape(len(ids), forest.shape.dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i, j, s = _top(q, _matrix(b.column("vector")), k + 1)
            yield pa.RecordBatch.from_arrays([pa.array(ids[i]), b.column("entry").take(pa.array(j)),
                                              b.column("vector").take(pa.array(j)), pa.array(s)], ["query", "entry", "vector", "score"])

    found = forest.entries.select("entry", "vector").mapInArrow(run, f"query long, entry long, vector {forest.shape.kind}, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    return (found.where("query <> entry").withColumn("at", F.row_number().over(best)).where(F.col("at") <= k).drop("at"))


def enough(forest: Forest, queries: DataFrame, cells: DataFrame, k: int, recall: float) -> int:
    """The least number of candidates that finds ``recall`` of the sample's neighbours.

    Where even the shortest prefixes miss too many, it is more than they can hold, and queries ascend
    to the root: every entry is a candidate.
    """
    shape = forest.shape
    share = FIT_QUERIES / max(queries.count(), 1)
    spot = F.xxhash64("entry").bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    sample = stored(queries.where(spot < share), "forest-sample")
    truth = _exact(forest, sample, k).toPandas()
    if not len(truth):
        return forest.count * shape.trees + 1
    asked = sample.toPandas()
    at = {e: i for i, e in enumerate(asked["entry"].tolist())}
    mine = shape.prefixes(np.array(asked["vector"].tolist()), query=True)
    theirs = shape.prefixes(np.array(truth["vector"].tolist()), query=False)
    who = np.array([at[x] for x in truth["query"].tolist()])
    shared = (mine[who] == theirs).any(1)  # does any tree agree at each length
    held = np.zeros((len(asked), shape.depth), np.int64)
    rows = _query_cells(forest, sample, cells).groupBy("entry", "length").agg(F.sum("n").alias("n")).collect()
    for r in rows:
        held[at[r["entry"]], r["length"] - 1] = r["n"]

    every = np.arange(len(asked))

    def stops(least: int) -> np.ndarray:
        ok = held >= least
        return np.where(ok.any(1), shape.depth - 1 - ok[:, ::-1].argmax(1), -1)

    def found(least: int) -> float:
        stop = stops(least)[who]
        return float(np.where(stop >= 0, shared[np.arange(len(who)), stop], True).mean())

    options = np.unique(held)
    low, high = 0, len(options)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if found(int(options[mid])) >= recall else (mid + 1, high)
    if low == len(options):
        return int(options[-1]) + 1
    stop = stops(int(options[low]))
    # what nearly all of the sample hold where they stop: more asks more of queries amid close copies only
    usual = np.quantile(held[every, stop][stop >= 0], SHORT) if (stop >= 0).any() else 0
    return max(int(options[low]), int(usual))


def _stops(asked: DataFrame, least: int) -> DataFrame:
    """(entry, stop): the longest prefixes that hold enough over all trees; 0 is the root."""
    sums = asked.groupBy("entry", "length").agg(F.sum("n").alias("held"))
    return stored(sums.groupBy("entry").agg(
        F.coalesce(F.max(F.when(F.col("held") >= least, F.col("length"))), F.lit(0)).alias("stop")), "forest-stops")


def _visits(asked: DataFrame, stops: DataFrame) -> DataFrame:
    """(entry, tree, length, prefix): the cells each query looks into, all trees at the same length.

    The root is the same in all trees and visited in the first only.
    """
    within = asked.join(stops, "entry").where(F.col("length") == F.col("stop")).select("entry", "tree", "length", "prefix")
    zero = F.lit(0)
    root = stops.where("stop = 0").select("entry", zero.alias("tree"), zero.alias("length"), zero.cast("long").alias("prefix"))
    return stored(within.union(root), "forest-visits")


@dataclass(frozen=True)
class _Cuts:
    """Into how many blocks of queries and of vectors the large cells are cut; all others stay whole."""

    cells: np.ndarray  # sorted (tree, length, prefix)
    ask_cuts: np.ndarray
    row_cuts: np.ndarray

    @staticmethod
    def keys(tree: np.ndarray, length: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        out = np.empty(len(prefix), [("tree", np.int64), ("length", np.int64), ("prefix", np.int64)])
        out["tree"], out["length"], out["prefix"] = tree, length, prefix
        return out

    @classmethod
    def of(cls, large: pd.DataFrame) -> _Cuts:
        cells = cls.keys(*(large[c].to_numpy(np.int64) for c in ("tree", "length", "prefix")))
        order = np.argsort(cells)
        return cls(cells[order], *(large[c].to_numpy(np.int64)[order] for c in ("ask_cuts", "row_cuts")))

    def blocks(self, tree: np.ndarray, length: np.ndarray, prefix: np.ndarray, entry: np.ndarray,
               side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, query block, vector block): a query goes to its block of queries against every block of vectors; a vector likewise."""
        ask, row = np.ones(len(entry), np.int64), np.ones(len(entry), np.int64)
        if len(self.cells):
            keys = self.keys(tree, length, prefix)
            at = np.minimum(np.searchsorted(self.cells, keys), len(self.cells) - 1)
            hit = self.cells[at] == keys
            ask[hit], row[hit] = self.ask_cuts[at[hit]], self.row_cuts[at[hit]]
        own, other = (ask, row) if side == ASKS else (row, ask)
        rows = np.repeat(np.arange(len(entry)), other)
        every = np.arange(len(rows)) - np.repeat(np.cumsum(other) - other, other)
        mine = ((entry * 0x9E3779B1 >> 7) % own)[rows]
        first, second = (mine, every) if side == ASKS else (every, mine)
        return rows, first.astype(np.int32), second.astype(np.int32)


def candidates(forest: Forest, queries: DataFrame, cells: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """(query, entry, score): the ``k + 1`` best of each query over its cells, stored."""
    shape = forest.shape
    lengths = sorted(r["length"] for r in visits.select("length").distinct().collect())
    asked = visits.groupBy("tree", "length", "prefix").agg(F.count("*").alias("asked"))
    roots = visits.sparkSession.createDataFrame([(0, 0, 0, forest.count)], "tree int, length int, prefix long, n long")
    place = ["tree", "length", "prefix"]
    # cells cut into blocks: at most two thousand per tree and length, whatever the table's size
    rows_cut = max(CELL_ROWS, forest.count // CELL_SHARE)
    asks_cut = max(CELL_QUERIES, queries.count() // CELL_SHARE)
    large = cells.union(roots).join(asked, place).where((F.col("n") > rows_cut) | (F.col("asked") > asks_cut)).select(
        *place, F.ceil(F.col("n") / rows_cut).cast("int").alias("row_cuts"), F.ceil(F.col("asked") / asks_cut).cast("int").alias("ask_cuts"))
    # a bounded list, so each task can look cuts up while it deals vectors out
    cuts = _Cuts.of(large.toPandas())

    def dealt(batches: Iterator[pa.RecordBatch], side: int) -> Iterator[pa.RecordBatch]:
        for b in batches:
            entry = b.column("entry").to_numpy()
            if side == ASKS:
                todo = [(b.column("tree").to_numpy(), b.column("length").to_numpy(), b.column("prefix").to_numpy())]
            else:
                p = shape.prefixes(_matrix(b.column("vector")), query=False)
                todo = [(np.full(len(p), t), np.full(len(p), d), p[:, t, d - 1] if d else np.zeros(len(p), np.int64))
                        for d in lengths for t in range(shape.trees if d else 1)]
            for tree, length, prefix in todo:
                at, first, second = cuts.blocks(tree, length, prefix, entry, side)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (tree[at].astype(np.int32), length[at].astype(np.int32), prefix[at], first, second, np.full(len(at), side, np.int32))]
                    + [b.column(c).take(pa.array(at)) for c in ("entry", "vector")], [*place, "ask_cut", "row_cut", "side", "entry", "vector"])

    schema = f"tree int, length int, prefix long, ask_cut int, row_cut int, side int, entry long, vector {shape.kind}"
    asks = queries.select("entry", "vector").join(visits, "entry").select("entry", "vector", *place)
    asks = asks.mapInArrow(lambda batches: dealt(batches, ASKS), schema)
    rows = forest.entries.select("entry", "vector").mapInArrow(lambda batches: dealt(batches, ROWS), schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "cell", 8192):
            cell, side, entry = (t.column(c).to_numpy() for c in ("cell", "side", "entry"))
            v = _matrix(t.column("vector"))
            starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            out = []
            for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(cell)]):
                m = a + int((side[a:z] == 0).sum())
                if a < m < z:
                    i, j, s = _top(v[a:m], v[m:z], k + 1)
                    out.append((entry[a:m][i], entry[m:z][j], s))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query", "entry", "score"])

    cell = F.xxhash64(*place, "ask_cut", "row_cut").alias("cell")
    met = asks.union(rows).select(cell, "side", "entry", "vector").repartition("cell").sortWithinPartitions("cell", "side")
    found = met.mapInArrow(meet, "query long, entry long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    found = found.groupBy("query", "entry").agg(F.max("score").alias("score")).withColumn("at", F.row_number().over(best))
    # k + 1 entries hold k others than the query itself
    return stored(found.where(F.col("at") <= k + 1).drop("at"), "forest-found")


def _nearest(forest: Forest, queries: DataFrame, k: int, recall: float) -> DataFrame:
    """(query, entry, score): the ``k + 1`` best entries found for each query.

    A query whose cells hold fewer, as amid close copies, ascends on until they do or it is at the root.
    """
    cells = cell_sizes(forest)
    asked = _query_cells(forest, queries, cells)
    stops = _stops(asked, enough(forest, queries, cells, k, recall))
    found = candidates(forest, queries, cells, _visits(asked, stops), k)
    while True:
        full = found.groupBy("query").agg(F.count("*").alias("n"))
        short = stops.join(full, stops["entry"] == full["query"], "left").where(
            (F.col("stop") > 0) & (F.coalesce("n", F.lit(0)) < min(k + 1, forest.count))).select("entry", (F.col("stop") - 1).alias("stop"))
        stops = stored(short, "forest-stops")
        if stops.isEmpty():
            return found
        again = queries.join(stops.select("entry"), "entry", "left_semi")
        more = candidates(forest, again, cells, _visits(asked, stops), k)
        found = stored(found.join(stops.select(F.col("entry").alias("query")), "query", "left_anti").union(more), "forest-found")


def search(vectors: DataFrame, is_query: Column, k: int = 20, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest found of every row for which ``is_query`` (over ``vec_id``) holds: query_id, rank, vec_id, score."""
    forest = build(vectors, k, trees)
    good = vectors.where(usable("embedding") & (F.size("embedding") == forest.shape.dim) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(forest.shape.kind).alias("vector"))
    asking = good.where(is_query).distinct().join(forest.entries.select("entry", "vector"), "vector").select("vec_id", "entry", "vector")
    asking = stored(asking, "forest-asking")
    queries = stored(asking.select("entry", "vector").dropDuplicates(["entry"]), "forest-asked")
    found = _nearest(forest, queries, k, recall)
    members = found.join(forest.entries.select("entry", "ids"), "entry").select("query", "score", "entry", F.explode("ids").alias("vec_id"))
    near = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "entry")
    members = stored(members.withColumn("at", F.row_number().over(near)).where(F.col("at") <= k + 1).drop("at"), "forest-members")
    named = (asking.select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query")).join(members, "query")
             .where((F.col("query_id") != F.col("vec_id")) | (F.col("query") != F.col("entry"))))
    rank = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id", "entry")
    return (named.withColumn("rank", F.row_number().over(rank).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
