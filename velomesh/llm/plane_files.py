"""Token ids in byte-plane files.

Documents are dealt by range of identity, encoded with the tokenizers library, closed with an end id and
laid end to end. Each part of the range is cut into blocks of a fixed number of ids; a block's ids are
transposed into byte planes (all lowest bytes first, then the next, ...) and each plane is compressed with
zstandard on its own. A block is one row of a Parquet file: its place, its planes, and the runs of
documents inside it. That is the chunk index: any block can be read, and any document found, without the
others. Spark's writer commits the files, so a lost executor leaves no half-written block, and they can
lie on any file system Spark knows.

Defined results: a null or empty text has the end id alone; a null identity comes first; rows of equal
identity lie beside each other in the order of their text's hash; an empty table writes no blocks;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from velomesh.llm.common import stored
from velomesh.llm.tokens import TextEncoder
from velomesh.session import checkpointed, shared_folder

#: Ids in a block, bytes of an id, zstandard level.
BLOCK_IDS, WIDTH, LEVEL = 65_536, 4, 3
#: Words remembered by a worker; runs of letters handed to the library as one sequence, and sequences in one call.
HELD_WORDS, RUN_WORDS, RUN_BATCH = 800_000, 200, 100
#: Documents taken from a batch at once, and characters split into words at once: what a worker holds besides its words.
BATCH_DOCS, BLOCK_CHARS = 256, 1_000_000
_RUN = pa.list_(pa.struct([("doc", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int64()), ("last", pa.bool_()), ("n", pa.int64())]))
_BLOCK = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64()),
                    ("planes", pa.list_(pa.binary())), ("runs", _RUN)])
_BLOCK_DDL = ("part int, block long, start long, n_ids long, planes array<binary>, "
              "runs array<struct<doc: long, doc_id: long, piece: long, last: boolean, n: long>>")


@lru_cache(maxsize=1)
def library_encoder(path: str) -> TextEncoder:
    """Encoder by the tokenizers library, kept by the worker from task to task."""
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    size = tok.get_vocab_size(with_added_tokens=True)
    ends = np.array([(tok.id_to_token(i) or "").endswith(tok.model.end_of_word_suffix or "") for i in range(size)])

    def others(words: list[str]) -> list[bytes]:
        step = RUN_WORDS * RUN_BATCH
        return [np.array(e.ids, "<u4").tobytes() for at in range(0, len(words), step)
                for e in tok.encode_batch_fast(words[at:at + step], add_special_tokens=False)]

    def runs(words: list[str]) -> list[bytes]:
        """Runs of letters by the sequence: each ends at a token that carries the end-of-word mark."""
        if not tok.model.end_of_word_suffix:
            return others(words)
        out, step = [], RUN_WORDS * RUN_BATCH
        for at in range(0, len(words), step):
            some = words[at:at + step]
            lines = [" ".join(some[i:i + RUN_WORDS]) for i in range(0, len(some), RUN_WORDS)]
            ids = np.array([i for e in tok.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], "<u4")
            stops = np.flatnonzero(ends[ids]) + 1
            if len(stops) != len(some):
                out += others(some)
                continue
            raw = ids.tobytes()
            cuts = [0, *(stops * WIDTH).tolist()]
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    return TextEncoder(runs, others, HELD_WORDS, BLOCK_CHARS)


def to_planes(raw: bytes) -> list[bytes]:
    """Compressed byte planes of little-endian ids."""
    pack = zstandard.ZstdCompressor(level=LEVEL)
    return [pack.compress(p.tobytes()) for p in np.frombuffer(raw, np.uint8).reshape(-1, WIDTH).T]


def from_planes(planes: list[bytes]) -> bytes:
    """The ids that ``to_planes`` took."""
    unpack = zstandard.ZstdDecompressor()
    return np.stack([np.frombuffer(unpack.decompress(p), np.uint8) for p in planes], 1).tobytes()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` and write their ids to the folder ``path``."""
    end = end_id.to_bytes(WIDTH, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), library_encoder(tokenizer)
        held, runs, start, block, doc = bytearray(), [], 0, 0, 0

        def full(size: int) -> pa.RecordBatch:
            row = {"part": part, "block": block, "start": start, "n_ids": size // WIDTH,
                   "planes": to_planes(bytes(held[:size])), "runs": runs}
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK)

        limit = block_ids * WIDTH
        for b in (whole.slice(i, BATCH_DOCS) for whole in batches for i in range(0, whole.num_rows, BATCH_DOCS)):
            texts = [t or "" for t in b.column("text").to_pylist()]
            for name, raw in zip(b.column("doc_id").to_pylist(), encoder.encode(texts)):
                raw += end
                at = piece = 0
                while at < len(raw):
                    take = min(len(raw) - at, limit - len(held))
                    held += raw[at:at + take]
                    at += take
                    runs.append({"doc": doc, "doc_id": name, "piece": piece, "last": at == len(raw), "n": take // WIDTH})
                    piece += 1
                    if len(held) == limit:
                        yield full(limit)
                        start, block, runs = start + block_ids, block + 1, []
                        held.clear()
                doc += 1
        if held:
            yield full(len(held))

    order = [F.col("doc_id"), F.col("text_hash")]
    dealt = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
             .repartitionByRange(*order).sortWithinPartitions(*order))
    (dealt.select("doc_id", "text").mapInArrow(run, _BLOCK_DDL)
     .write.option("compression", "uncompressed").parquet(path))


def crc_join(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of a concatenation from the (crc, bytes) of its parts.

    Appending n bytes multiplies the register by x^(8n) in the field of the CRC's polynomial.
    """
    def times(a: int, b: int) -> int:
        out = 0
        for k in range(31, -1, -1):
            if b >> k & 1:
                out ^= a
            a = a >> 1 ^ (0xEDB88320 if a & 1 else 0)
        return out

    total = 0
    for crc, size in parts:
        power, base, n = 1 << 31, 1 << 23, size  # 1 and x^8, lowest power in the highest bit
        while n:
            if n & 1:
                power = times(power, base)
            base, n = times(base, base), n >> 1
        total = times(total, power) ^ crc
    return total


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The stored blocks and their index, with the position of each part's first id."""
    rows = spark.read.schema(_BLOCK_DDL).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per written part
    parts = (rows.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")))
    return rows.join(checkpointed(parts), "part")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32.

    Blocks are read side by side. A document that lies in one block is finished there; of one that goes
    over the border the checksums of the pieces are joined.
    """
    names = ["part", "doc", "doc_id", "piece", "last", "start", "n", "crc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {k: [] for k in names}
            for row in b.to_pylist():
                raw, at = from_planes(row["planes"]), 0
                first = row["part_start"] + row["start"]
                for r in row["runs"]:
                    stop = at + r["n"] * WIDTH
                    for k, v in (("part", row["part"]), ("doc", r["doc"]), ("doc_id", r["doc_id"]), ("piece", r["piece"]),
                                 ("last", r["last"]), ("start", first + at // WIDTH), ("n", r["n"]), ("crc", zlib.crc32(raw[at:stop]))):
                        out[k].append(v)
                    at = stop
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("part", pa.int32()), *((k, pa.bool_() if k == "last" else pa.int64()) for k in names[1:])]))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crcs = [crc_join([(p["crc"], p["n"] * WIDTH) for p in pieces]) for pieces in b.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crcs, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    pieces = stored(blocks(spark, path).mapInArrow(
        run, "part int, doc long, doc_id long, piece long, last boolean, start long, n long, crc long"), "plane-runs")
    inside = (F.col("piece") == 0) & F.col("last")
    done = pieces.where(inside).select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    over = (pieces.where(~inside).groupBy("part", "doc", "doc_id")
            .agg(F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
                 F.sort_array(F.collect_list(F.struct("piece", "crc", "n"))).alias("pieces")))
    return done.union(over.select("doc_id", "start", "n_tokens", "pieces").mapInArrow(
        joined, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` and return what the files hold: doc_id, start, n_tokens, ids_crc32."""
    path = path or shared_folder(docs.sparkSession, "planes")
    write(docs, path, tokenizer, end_id)
    return read_documents(docs.sparkSession, path)
