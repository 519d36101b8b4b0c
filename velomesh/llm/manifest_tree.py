"""A Merkle manifest whose tampered leaves become versions of a persistent, path-copying tree.

Leaves are numbered per source and cut into aligned blocks of ``FAN ** HEIGHT``. A block is one small tree:
nodes are only ever added, so a tampered leaf gives a version that copies its ancestors inside the block and
shares every other node. The blocks' roots are the leaves of the next level of blocks, and so on; what a
version needs above its block is one path per block, carried down by joins, on which the version goes on.
The sources' roots are the leaves of one more such tree.

Defined results: a null source is a source of its own and comes first; null identities come first in their source
and are never tampered with; rows of one identity are ordered by their leaf, so repeated rows are leaves of their
own; a null field is ``-``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomesh.llm.common import stored
from velomesh.session import checkpointed

#: Children of a node, and levels inside a block (6,561 leaves).
FAN, HEIGHT = 3, 8

#: The fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left:string,right:string>>"
_PROOF = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, copied long")


def _hash(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class PathTree:
    """A tree of digests that never changes a node: versions share what they do not touch.

    ``levels`` is the height of a block that has neighbours; without it the tree ends at its one root.
    """

    def __init__(self, leaves: Sequence[str], levels: int | None):
        self.digest, self.kids = list(leaves), [()] * len(leaves)
        self.rows = [range(len(leaves))]
        while len(self.rows) <= levels if levels is not None else len(self.rows[-1]) > 1:
            row = self.rows[-1]
            self.rows.append([self._node(tuple(row[i:i + FAN])) for i in range(0, len(row), FAN)])
        self.root = self.rows[-1][0]

    def _node(self, kids: tuple[int, ...]) -> int:
        self.digest.append(_hash(*[self.digest[k] for k in kids]))
        self.kids.append(kids)
        return len(self.kids) - 1

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """(left, right) digests beside the path from a leaf to the root, level by level."""
        found = []
        for row in self.rows[:-1]:
            first = at - at % FAN
            run = [self.digest[k] for k in row[first:first + FAN]]
            found.append(("".join(run[:at - first]), "".join(run[at - first + 1:])))
            at //= FAN
        return found

    def version(self, at: int, leaf: str) -> int:
        """Root of the version in which leaf ``at`` reads ``leaf``: new ancestors, every other node shared."""
        self.digest.append(leaf)
        self.kids.append(())
        copy = len(self.kids) - 1
        for row in self.rows[1:]:
            kids, slot = self.kids[row[at // FAN]], at % FAN
            copy = self._node((*kids[:slot], copy, *kids[slot + 1:]))
            at //= FAN
        return copy


def climb(node: str, path: Sequence[tuple[str, str]]) -> str:
    """The digest at the end of a path of siblings."""
    for left, right in path:
        node = _hash(left, node, right)
    return node


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, a colon, itself; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**changed: Column) -> Column:
    """SHA-256 of a row's fields, 32 bytes; ``changed`` replaces fields."""
    return F.unhex(F.sha2(F.concat(*[field(changed.get(name, F.col(name))) for name in FIELDS]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered, touched): one row per document, stored; texts end here.

    ``tree`` orders like the source with null first. Rows whose identity has an even CRC-32 are tampered with
    (``touched``), even where the text is null or has no line break to lose.
    """
    docs = docs.select(*FIELDS)
    doc_id = F.col("doc_id")
    touched = doc_id.isNotNull() & (F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0)
    changed = leaf_digest(text=F.replace("text", F.lit("\n"), F.lit("")))
    tree = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("source")))
    return stored(docs.select(tree.alias("tree"), doc_id.cast("long").alias("doc_id"), leaf_digest().alias("leaf"),
                              F.when(touched, changed).alias("tampered"), touched.alias("touched")), "manifest-leaves")


def numbered_in(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Add ``pos`` (from 0, in ``order``) and ``total`` within each ``tree``; no tree meets in one task.

    Rows are dealt by range over all trees and numbered inside their partition; one row per partition and tree
    says where each stretch begins.
    """
    dealt = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    dealt = checkpointed(dealt.withColumn("_part", F.spark_partition_id())
                         .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    spans = dealt.groupBy(tree, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(tree, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                         F.sum("_n").over(whole).alias("total"))
    return (dealt.join(spans, [tree, "_part"])
            .withColumn("pos", F.col("_before") + F.col("_row") - F.col("_first"))
            .drop("_part", "_row", "_first", "_before", "_n"))


def _block_tree(block: pa.Table, digest: str) -> tuple[PathTree, pa.Table]:
    """The tree over one block, and the block in its order."""
    block = block.sort_by("pos")
    alone = block.column("total")[0].as_py() <= FAN ** HEIGHT
    return PathTree([d.hex() for d in block.column(digest).to_pylist()], None if alone else HEIGHT), block


def _blocked(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {FAN ** HEIGHT}"))


def block_roots(nodes: DataFrame) -> DataFrame:
    """(tree, pos, total, digest) of the next level: one node for each aligned block of this one."""
    def root(block: pa.Table) -> pa.Table:
        tree, block = _block_tree(block, "digest")
        first = block.slice(0, 1)
        total = -(-first.column("total")[0].as_py() // FAN ** HEIGHT)
        return pa.table({"tree": first.column("tree"), "pos": first.column("block"), "total": [total],
                         "digest": [bytes.fromhex(tree.digest[tree.root])]})
    up = _blocked(nodes.select("tree", "pos", "total", "digest"))
    return up.groupBy("tree", "block").applyInArrow(root, "tree string, pos long, total long, digest binary")


def block_paths(nodes: DataFrame) -> DataFrame:
    """(tree, pos, block, path): the siblings of each node up to the root of its block."""
    def paths(block: pa.Table) -> pa.Table:
        tree, block = _block_tree(block, "digest")
        found = [[{"left": a, "right": b} for a, b in tree.siblings(k)] for k in range(block.num_rows)]
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return block.select(["tree", "pos", "block"]).append_column("path", pa.array(found, kind))
    up = _blocked(nodes.select("tree", "pos", "total", "digest"))
    return up.groupBy("tree", "block").applyInArrow(paths, f"tree string, pos long, block long, path {_PATH}")


def upper_paths(nodes: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """Paths of ``nodes`` (tree, pos, total, digest) to the root of their tree, and those roots.

    ``longest`` is the number of nodes of the largest tree. Each round of blocks divides it by ``FAN ** HEIGHT``. A
    path is put together from above, joined on the block below, so no join key has more rows than a block.
    """
    levels = [nodes]
    while longest > 1:
        levels.append(checkpointed(block_roots(levels[-1])))
        longest = -(-longest // FAN ** HEIGHT)
    roots = levels[-1].select("tree", F.col("digest").alias("root"))
    paths = levels[-1].select("tree", "pos", F.array().cast(_PATH).alias("path"))
    for level in reversed(levels[:-1]):
        above = paths.select("tree", F.col("pos").alias("block"), F.col("path").alias("rest"))
        paths = (block_paths(level).join(above, ["tree", "block"])
                 .select("tree", "pos", F.concat("path", "rest").alias("path")))
    return paths, roots


def _longest(nodes: DataFrame) -> int:
    return nodes.agg(F.max("total")).first()[0] or 0


def _prove(block: pa.Table, above: pa.Table) -> pa.Table:
    """Proofs and versions of one block; ``above`` is its one row of path, subroot and root."""
    tree, block = _block_tree(block, "leaf")
    up = above.to_pylist()[0]
    path = [(s["left"], s["right"]) for s in up["path"]]
    rest, base = "".join(a + b for a, b in path), len(tree.kids)
    out = {"doc_id": block.column("doc_id"), "leaf": tree.digest[:block.num_rows], "proof_sha256": [], "folded_root": [], "copied": []}
    for at, (touched, changed) in enumerate(zip(block.column("touched").to_pylist(), block.column("tampered").to_pylist())):
        beside = tree.siblings(at)
        out["proof_sha256"].append(_hash(*[a + b for a, b in beside], rest))
        if touched:
            before = len(tree.kids)
            node = tree.digest[tree.version(at, changed.hex())]
            out["copied"].append(len(tree.kids) - before)
        else:
            node = climb(tree.digest[at], beside)
            out["copied"].append(0)
        out["folded_root"].append(climb(node, path))
    assert len(tree.kids) - base == sum(out["copied"])
    out |= {"subroot": [up["subroot"]] * block.num_rows, "root": [up["root"]] * block.num_rows,
            "verified": [f == up["root"] for f in out["folded_root"]]}
    names = [f.split()[0] for f in _PROOF.split(", ")]
    return pa.table({n: out[n] for n in names})


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, copied.

    ``copied`` counts the nodes that the document's version added to its block; 0 for rows left as they are.
    """
    rows = numbered_in(leaves(docs), "tree", ["doc_id", "leaf"])
    nodes = rows.select("tree", "pos", "total", F.col("leaf").alias("digest"))
    longest = _longest(nodes)
    firsts = checkpointed(block_roots(nodes))
    paths, subroots = upper_paths(firsts, -(-longest // FAN ** HEIGHT))
    subroots = checkpointed(subroots)

    # the tree over the sources' roots, whose leaves are the sources in their order
    tops = numbered_in(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("own"), F.col("root").alias("digest")),
                       "tree", ["own"])
    ends, top = upper_paths(tops, _longest(tops))
    ends = (tops.join(ends, ["tree", "pos"]).join(top, "tree")
            .select(F.col("own").alias("tree"), F.lower(F.hex("digest")).alias("subroot"),
                    F.lower(F.hex("root")).alias("root"), F.col("path").alias("rest")))
    above = (paths.join(ends, "tree")
             .select("tree", F.col("pos").alias("block"), F.concat("path", "rest").alias("path"), "subroot", "root"))
    return (_blocked(rows).groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
            .applyInArrow(_prove, _PROOF))
