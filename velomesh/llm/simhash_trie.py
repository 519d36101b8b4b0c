"""SimHash near-duplicates by a self-join of a binary trie.

Fingerprints are the leaves of a binary trie. Node pairs are walked together from the top; the bits in
which they differ add up, and a pair is dropped as soon as it has more than the budget. Two
fingerprints within ``d`` bits agree in one of ``d + 1`` bit blocks, so the trie is rooted once at each
block: its top nodes are the block's values and only equal ones are paired. Each top node is a group
of its own on the cluster. A node too large for a task is opened on the cluster first, some bits
deeper, into the child pairs that still keep the budget.

Of each node pair's links a spanning forest is kept, which loses no connection; components are then
found by star steps.

Defined results: a null or empty text has fingerprint zero and is linked like any other; rows with the
same identity are separate rows of one document; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.llm.common import stored, whole_groups
from velomesh.llm.components import components

BITS = 64
#: A trie node with more fingerprints than this is opened on the cluster before it goes to a task.
NODE_ROWS = 50_000
#: Bits by which such a node is opened at a time.
OPEN_BITS = 6
#: Node pairs whose sizes multiply to this or less are compared leaf by leaf.
LEAF_PAIRS = 64
#: Node pairs, and shingles, handled at once.
FRONT, BLOCK = 200_000, 200_000


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash: a bit is 1 where over half the word shingles' XXH64 (seed 42) have it."""
    words = text.lower().split()  # of bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - shingle + 1)
    if count == 1:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:count].tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    set_bits = np.zeros(BITS, np.int64)
    one = xxhash.xxh64_intdigest
    for at in range(0, count, BLOCK):
        hashes = np.fromiter((one(joined[s:e], 42) for s, e in zip(starts[at:at + BLOCK], stops[at:at + BLOCK])),
                             np.dtype("<u8"))
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.fromiter((fingerprint(t or b"", shingle) for t in b.column("text").to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(prints.view(np.int64))],
                                             ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                       F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def blocks(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of the ``distance + 1`` bit blocks."""
    cuts = [BITS * k // (distance + 1) for k in range(distance + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _rooted(prints: DataFrame, distance: int) -> DataFrame:
    """Each fingerprint below each of its top nodes: (block, top, path, pa, pb, depth, side).

    ``path`` holds the other bits, in the high end of 64; ``pa`` and ``pb`` are the paths of the two nodes
    of a pair down to ``depth`` bits, and ``side`` tells to which of the two the row belongs.
    """
    def one(block: int, shift: int, width: int):
        fp = F.col("fp")
        top = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))
        # the bits above the block, then those below it, then zeros
        above = F.shiftleft(F.shiftrightunsigned(fp, shift + width), shift + width) if shift + width < BITS else F.lit(0)
        below = F.shiftleft(fp.bitwiseAND(F.lit((1 << shift) - 1)), width)
        path = above.cast("long").bitwiseOR(below)
        return F.struct(F.lit(block).alias("block"), top.alias("top"), path.alias("path"))

    rooted = F.explode(F.array(*[one(k, *b) for k, b in enumerate(blocks(distance))]))
    zero = F.lit(0).cast("long")
    return (prints.select("fp", rooted.alias("r")).select("fp", "r.*")
            .withColumns({"pa": zero, "pb": zero, "depth": F.lit(0), "side": F.lit(0)}))


NODE = ["block", "top", "depth", "pa", "pb"]


def _opened(rows: DataFrame, distance: int) -> DataFrame:
    """The rows of large node pairs, dealt to the pairs of children that keep the error budget."""
    child = F.shiftrightunsigned(F.expr("shiftleft(path, depth)"), BITS - OPEN_BITS)
    masks = F.array(*[F.lit(m) for m in range(1 << OPEN_BITS) if m.bit_count() <= distance])
    spent = F.bit_count(F.col("pa").bitwiseXOR(F.col("pb")))
    rows = rows.withColumns({"child": child, "mask": F.explode(masks)}).where(spent + F.bit_count("mask") <= distance)
    other = F.col("child").bitwiseXOR(F.col("mask").cast("long"))
    same = F.col("pa") == F.col("pb")
    # in a pair of a node with itself the smaller child is side 0
    side = F.when(same, (F.col("child") > other).cast("int")).otherwise(F.col("side"))
    a, b = F.when(side == 0, F.col("child")).otherwise(other), F.when(side == 0, other).otherwise(F.col("child"))
    return rows.select("fp", "block", "top", "path",
                       F.shiftleft("pa", OPEN_BITS).bitwiseOR(a).alias("pa"),
                       F.shiftleft("pb", OPEN_BITS).bitwiseOR(b).alias("pb"),
                       (F.col("depth") + OPEN_BITS).alias("depth"), side.alias("side"))


def node_pairs(prints: DataFrame, distance: int, node_rows: int = NODE_ROWS) -> DataFrame:
    """Rows of all node pairs that a task can hold; larger ones are opened until they are small."""
    rows, small = _rooted(prints, distance), None
    for _ in range(BITS // OPEN_BITS):
        large = rows.groupBy(*NODE).count().where(F.col("count") > node_rows).select(*NODE)
        large = stored(large, "trie-nodes")
        if large.isEmpty():
            return rows if small is None else small.union(rows)
        rest = rows.join(large, NODE, "left_anti").select(*rows.columns)
        small = rest if small is None else small.union(rest)
        rows = stored(_opened(rows.join(large, NODE, "left_semi").select(*rows.columns), distance), "trie-rows")
    return small.union(rows)


def _split(ones: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Where the ones begin in sorted ranges that agree in all bits before."""
    return hi - (ones[hi] - ones[lo])


def trie_links(values: np.ndarray, pairs: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of links among sorted ``values``, walking node pairs (lo, hi, lo, hi) down together.

    Pairs are handled in blocks, deepest first, so the front stays small.
    """
    bits: dict[int, np.ndarray] = {}
    stack = [(0, pairs[k:k + FRONT], np.zeros(len(pairs[k:k + FRONT]), np.int64)) for k in range(0, len(pairs), FRONT)]
    while stack:
        depth, p, err = stack.pop()
        if not len(p):
            continue
        la, ha, lb, hb = p.T
        done = ((ha - la) * (hb - lb) <= LEAF_PAIRS) | (depth == BITS)
        if done.any():
            a, b = _leaf_pairs(p[done])
            near = np.bitwise_count(values[a] ^ values[b]) <= distance
            yield a[near], b[near]
            p, err = p[~done], err[~done]
            if not len(p):
                continue
            la, ha, lb, hb = p.T
        if depth not in bits:
            one = (values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            bits[depth] = np.concatenate(([0], np.cumsum(one, dtype=np.int32)))
        ma, mb = _split(bits[depth], la, ha), _split(bits[depth], lb, hb)
        same = la == lb
        kids = [(np.stack([la, ma, lb, mb], 1), err, None), (np.stack([ma, ha, mb, hb], 1), err, None),
                (np.stack([la, ma, mb, hb], 1), err + 1, None), (np.stack([ma, ha, lb, mb], 1), err + 1, ~same)]
        rows = [(k if keep is None else k[keep], e if keep is None else e[keep]) for k, e, keep in kids]
        p, err = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        alive = (p[:, 1] > p[:, 0]) & (p[:, 3] > p[:, 2]) & (err <= distance)
        p, err = p[alive], err[alive]
        for k in range(0, len(p), FRONT):
            stack.append((depth + 1, p[k:k + FRONT], err[k:k + FRONT]))


def _leaf_pairs(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All position pairs of small node pairs; of a node with itself each pair once."""
    la, ha, lb, hb = p.T
    na, nb = ha - la, hb - lb
    count = na * nb
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    nb = np.repeat(nb, count)
    a, b = np.repeat(la, count) + at // nb, np.repeat(lb, count) + at % nb
    keep = (a < b) | np.repeat(la != lb, count)
    return a[keep], b[keep]


def _forest(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of each linked pair, least position on top."""
    up = parent
    for x, y in zip(a.tolist(), b.tolist()):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        while up[y] != y:
            up[y] = up[up[y]]
            y = up[y]
        if x < y:
            up[y] = x
        elif y < x:
            up[x] = y


def links(prints: DataFrame, distance: int, node_rows: int = NODE_ROWS) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints within ``distance`` bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "node", 100_000):
            node, side = t.column("node").to_numpy(), t.column("side").to_numpy()
            fp = t.column("fp").to_numpy().view(np.uint64)
            path = t.column("path").to_numpy().view(np.uint64)
            order = np.lexsort((path, side, node))
            node, side, path, fp = node[order], side[order], path[order], fp[order]
            starts = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]) | (side[1:] != side[:-1]))))
            stops = np.append(starts[1:], len(node))
            first, cross = side[starts] == 0, t.column("cross").to_numpy(zero_copy_only=False)[order][starts]
            alone = np.stack([starts, stops, starts, stops], 1)[first & ~cross & (stops - starts > 1)]
            nxt = np.append(node[starts][1:] == node[starts][:-1], False)
            two = np.flatnonzero(first & cross & nxt)
            both = np.stack([starts[two], stops[two], starts[two + 1], stops[two + 1]], 1) if len(two) else np.empty((0, 4), np.int64)
            parent = list(range(len(node)))
            for a, b in trie_links(path, np.concatenate([alone, both]), distance):
                near = np.bitwise_count(fp[a] ^ fp[b]) <= distance  # the whole fingerprints, block included
                _forest(parent, a[near], b[near])
            root = np.array(parent, dtype=np.int64)
            child = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[child].view(np.int64)), pa.array(fp[root[child]].view(np.int64))], ["a", "b"])

    rows = node_pairs(prints, distance, node_rows).select(
        F.xxhash64(*NODE).alias("node"), "side", "path", "fp", (F.col("pa") != F.col("pb")).alias("cross"))
    return (rows.repartition("node").sortWithinPartitions("node")
            .mapInArrow(run, "a long, b long").distinct())


def _assigned(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id): root is the least fingerprint of the component."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(links(prints, distance))
    known = stored(prints.join(roots, prints["fp"] == roots["node"], "left")
                   .select("fp", "least", F.coalesce("root", "fp").alias("root")), "fingerprints")
    tops = stored(known.groupBy("root").agg(F.min("least").alias("component_id")), "fingerprints")
    named = stored(known.join(tops, "root").select("fp", "root", "component_id"), "fingerprints")
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per document: doc_id, text_hash, fingerprint (16 hexadecimal digits), component_id."""
    return _assigned(docs, shingle, distance).select(
        "doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one row of each component, in its own columns: the least identity, then text hash."""
    place = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash")
    kept = (_assigned(docs, shingle, distance).groupBy("root").agg(F.min(place).alias("k"))
            .select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       F.col("doc_id").cast("long").alias("_own"), F.xxhash64("text").alias("_own_hash"))
    same = rows.join(kept, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_own_hash") == F.col("_hash")), "left_semi")
    return same.dropDuplicates(["_own", "_own_hash"]).select("_doc.*")
