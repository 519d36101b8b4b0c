"""Dropping lines that many documents share, by a sharded minimal perfect hash over the distinct lines.

Documents are dealt into small blocks. A block names each of its distinct line keys once, as a 128-bit hash with the
number of its documents that hold the key. Summed up per hash and dealt by hash into shards, the keys of a
shard get a minimal perfect hash, which numbers them 0 to n - 1 without storing them; beside it stand
two flat arrays: a fingerprint and a count for each number. Blocks then probe the arrays: a block's hashes travel to
their shards as one packed row for each shard, and only those that are found too often travel back.

A block is bounded in documents and every shard gets one row of each block, so neither a line that is everywhere nor a
source with a third of all rows makes a task larger than the others.

Defined results: a null or empty text is one empty line; a document counts a key once, however often it repeats
it; repeated rows are documents of their own; a text that loses all lines is empty; an empty table gives an empty
result. Other columns pass through, also such as have the names used here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomesh.llm.common import stored

#: Documents in a block as a power of two, and lines that a shard should hold.
BLOCK_BITS, SHARD_LINES = 8, 1 << 20
#: Slots of a level for each key that is still without a number; more slots, fewer levels.
ROOM = 2.0
#: Largest count that an array holds; higher ones are held as this.
MOST = 0xFFFF
#: Fixed value: the white space that keys lose at both ends.
SPACE = b" \t\n\x0b\x0c\r"

#: A line key as its two halves.
KEY = np.dtype([("hi", "<u8"), ("lo", "<u8")])


def _scatter(keys: np.ndarray, level: int, slots: int) -> np.ndarray:
    """The slot of each key on one level of the hash."""
    with np.errstate(over="ignore"):
        x = keys["lo"] + np.uint64(level + 1) * (keys["hi"] | np.uint64(1))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(slots)).astype(np.int64)


@dataclass
class Shard:
    """A minimal perfect hash in levels, with a fingerprint and a count for each number it gives.

    A key's number is the rank, over all levels' bits, of the first set bit it meets. A bit is set where
    exactly one of the keys still without a number fell.
    """

    sizes: np.ndarray
    bits: np.ndarray
    prints: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> Shard:
        """``keys`` must be distinct."""
        sizes, levels, left = [], [], keys
        while len(left):
            slots = -(-max(int(ROOM * len(left)), 1) // 64) * 64
            at = _scatter(left, len(sizes), slots)
            alone = np.bincount(at, minlength=slots) == 1
            sizes.append(slots)
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at]]
        shard = cls(np.array(sizes, "<i8"), np.concatenate(levels) if levels else np.empty(0, "u1"), np.empty(0), np.empty(0))
        number = shard.numbers(keys)
        shard.prints, shard.counts = np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<u2")
        shard.prints[number] = shard.prints_of(keys)
        shard.counts[number] = np.minimum(counts, MOST)
        return shard

    @staticmethod
    def prints_of(keys: np.ndarray) -> np.ndarray:
        return (keys["hi"] >> np.uint64(32)).astype("<u4")

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for keys that meet no set bit."""
        flat, before = self._ranks
        out, left, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, slots in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = start + _scatter(keys[left], level, slots)
            hit = flat[at] == 1
            out[left[hit]] = before[at[hit]]
            left = left[~hit]
            start += slots
        return out

    @cached_property
    def _ranks(self) -> tuple[np.ndarray, np.ndarray]:
        """Each bit, and the set bits before it."""
        flat = np.unpackbits(self.bits, bitorder="little")
        return flat, np.cumsum(flat, dtype=np.int64) - flat

    def count(self, keys: np.ndarray) -> np.ndarray:
        """How many documents hold each key; 0 for keys that are not of the index, but for one in 2 ** 32 of them."""
        number = self.numbers(keys)
        known = number >= 0
        known[known] = self.prints[number[known]] == self.prints_of(keys[known])
        out = np.zeros(len(keys), np.int64)
        out[known] = self.counts[number[known]]
        return out

    def pack(self) -> bytes:
        parts = [self.sizes.astype("<i8").tobytes(), self.bits.tobytes(), self.prints.tobytes(), self.counts.tobytes()]
        return np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(parts)

    @classmethod
    def unpack(cls, data: bytes) -> Shard:
        ends = np.cumsum(np.frombuffer(data, "<i8", 4)) + 32
        cuts = [32, *ends.tolist()]
        return cls(*[np.frombuffer(data[a:b], t) for a, b, t in zip(cuts, cuts[1:], ("<i8", "u1", "<u4", "<u2"))])


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A to Z as small letters."""
    return line.strip(SPACE).lower()


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _chars(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def _texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    for text in column.cast(pa.binary()).to_pylist():
        yield text or b""


def _block_marks(least: int):
    """(block, keys, docs) for each run of documents of one block."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, dict[bytes, int]] = {}
            for block, text in zip(batch.column("block").to_pylist(), _texts(batch.column("text"))):
                held = found.setdefault(block, {})
                for key in {line_key(line) for line in text.split(b"\n")}:
                    if _chars(key) >= least:
                        digest = _digest(key)
                        held[digest] = held.get(digest, 0) + 1
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(found, pa.int64()),
                "keys": pa.array([b"".join(h) for h in found.values()], pa.binary()),
                "docs": pa.array([np.fromiter(h.values(), "<u4", len(h)).tobytes() for h in found.values()], pa.binary())})
    return mark


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys["hi"] % np.uint64(shards)).astype(np.int64)


def _spread(shards: int):
    """One row (shard, hi, lo, docs) for each key of a block."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), KEY)
            docs = np.frombuffer(b"".join(batch.column("docs").to_pylist()), "<u4")
            columns = (_shard_of(keys, shards), keys["hi"].view("<i8"), keys["lo"].view("<i8"), docs.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shard", "hi", "lo", "docs"])
    return spread


def _to_shards(shards: int):
    """One row (shard, block, keys) for each block and each shard that its keys belong to."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("keys").to_pylist()):
                keys = np.frombuffer(data, KEY)
                shard = _shard_of(keys, shards)
                order = np.argsort(shard, kind="stable")
                own, starts = np.unique(shard[order], return_index=True)
                parts = np.split(keys[order], starts[1:]) if len(own) else []
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(own, pa.int64()), "block": pa.array([block] * len(own), pa.int64()),
                    "data": pa.array([p.tobytes() for p in parts], pa.binary())})
    return deal


def _pack_shard(group: pa.Table) -> pa.Table:
    """(shard, data): the packed shard over all its keys."""
    keys = np.empty(group.num_rows, KEY)
    for half in KEY.names:
        keys[half] = group.column(half).to_numpy().view("<u8")
    shard = Shard.build(keys, group.column("docs").to_numpy())
    return pa.table({"shard": group.column("shard").slice(0, 1), "data": pa.array([shard.pack()], pa.binary())})


def _probe(least_docs: int):
    """(block, found): the keys of a block that enough documents hold. Each shard's arrays come before its probes."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        for batch in batches:
            blocks, found = [], []
            for own, block, data in zip(*[batch.column(c).to_pylist() for c in ("shard", "block", "data")]):
                if block is None:
                    at, shard = own, Shard.unpack(data)
                elif own == at:
                    keys = np.frombuffer(data, KEY)
                    hit = keys[shard.count(keys) >= least_docs]
                    if len(hit):
                        blocks.append(block)
                        found.append(hit.tobytes())
            yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()), "found": pa.array(found, pa.binary())})
    return probe


class LineIndex:
    """Shards of a table's line keys: (shard, data), stored. Keys have ``least_chars`` code points or more."""

    def __init__(self, rows: DataFrame, shards: int, least_chars: int):
        self.rows, self.shards, self.least_chars = rows, shards, least_chars

    @classmethod
    def over(cls, marks: DataFrame, least_chars: int, shard_lines: int = SHARD_LINES) -> LineIndex:
        """The index of stored ``marks``."""
        spark = marks.sparkSession
        lines = marks.agg(F.sum(F.octet_length("docs") / 4)).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-lines // shard_lines)))
        counts = (marks.select("keys", "docs").mapInArrow(_spread(shards), "shard long, hi long, lo long, docs long")
                  .groupBy("shard", "hi", "lo").agg(F.sum("docs").alias("docs")))
        packed = counts.groupBy("shard").applyInArrow(_pack_shard, "shard long, data binary")
        return cls(stored(packed, "line-shards"), shards, least_chars)

    def too_common(self, marks: DataFrame, least_docs: int) -> DataFrame:
        """(block, found): packed keys of a block that ``least_docs`` documents of the index or more hold; one row a shard."""
        if not 0 < least_docs <= MOST:
            raise ValueError(f"counts are held up to {MOST}")
        probes = marks.select("block", "keys").mapInArrow(_to_shards(self.shards), "shard long, block long, data binary")
        arrays = self.rows.select("shard", F.lit(None).cast("long").alias("block"), "data")
        met = arrays.unionByName(probes).repartition("shard").sortWithinPartitions("shard", F.col("block").asc_nulls_first())
        return met.mapInArrow(_probe(least_docs), "block long, found binary")


def in_blocks(docs: DataFrame) -> DataFrame:
    """(block, row, text): ``docs`` dealt into blocks of documents that lie together, stored so that they stay so."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return stored(docs.select(F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("block"), row.alias("row"),
                              F.col("text")), "line-documents")


def line_marks(blocks: DataFrame, least_chars: int) -> DataFrame:
    """(block, keys, docs): packed hashes of the keys of a block and the documents that hold each, stored."""
    marks = blocks.select("block", "text").mapInArrow(_block_marks(least_chars), "block long, keys binary, docs binary")
    return stored(marks, "line-marks")


def _without_found(block: pa.Table, hits: pa.Table) -> pa.Table:
    """Texts of a block without the lines whose keys were found."""
    common = {data[k:k + 16] for data in hits.column("found").to_pylist() for k in range(0, len(data), 16)}
    texts, total, dropped = [], [], []
    for text in _texts(block.column("text")):
        lines = text.split(b"\n")
        keep = [x for x in lines if _digest(line_key(x)) not in common] if common else lines
        texts.append(b"\n".join(keep))
        total.append(len(lines))
        dropped.append(len(lines) - len(keep))
    return pa.table({"row": block.column("row"), "text": pa.array(texts, pa.binary()).view(pa.string()),
                     "n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())})


def drop_common_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, index: LineIndex | None = None) -> DataFrame:
    """``docs`` with shortened texts: (row, text, n_lines, n_dropped), ``row`` holding the other columns.

    Lines go whose key has ``least_chars`` code points and is held by ``least_docs`` documents, of ``docs`` or of
    those that an ``index`` of earlier documents was built over.
    """
    blocks = in_blocks(docs)
    least = index.least_chars if index else least_chars
    marks = line_marks(blocks, least)
    index = index or LineIndex.over(marks, least)
    found = index.too_common(marks, least_docs)
    result = T.StructType([blocks.schema["row"], T.StructField("text", T.StringType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_without_found, result)
