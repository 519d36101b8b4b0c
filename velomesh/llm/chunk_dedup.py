"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text: each byte shifts the hash by one bit and adds its own random
number, so the hash depends on the last 32 bytes only. A chunk ends where the hash falls below a
threshold, not before a least length, nor inside a character. An insertion moves the borders near it
and leaves all others with their bytes. Chunks with equal digests are the same; the one in the document with
the least identity (of equal ones the least text hash), there the first, is kept. Of the others, neighbours with
neighbouring copies are joined to runs, and each run is extended byte by byte to both sides as far as it equals the
kept copy, up to ``WINDOW`` bytes. Short hashes of the ``NEAR`` and the ``FAR`` bytes beside each chunk bound how far a
run can grow, so that only runs that may become long enough are looked up, and only as many bytes as they may grow by.
Runs that then touch are one stretch; stretches of at least ``least_bytes`` are
cut out. Every byte cut equals one of an earlier place, so one copy always stays.

Each text is cut into chunks once, in the document of least identity that has it, its first. All chunks of the other
documents with that text have copies there or before, so they are cut as a whole if long enough.

Only counts of 64 digest bits go through the first shuffle, added up before it. Chunks then meet the digests counted more
than once in a semi-join, whose hot digests Spark can split; places and kept copies are settled, by the whole digest, among
what is left. Texts travel once, into a bucketed table; what is asked of the kept copies and what is cut goes to them there.

Defined results: a null text stays null, an empty one empty, both without chunks; rows of equal identity and equal
text are one document and get the same result; a null identity comes after all others, different texts of equal or
null identity in the order of their hashes; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velomesh.llm.common import stored

#: A chunk ends at about one byte in this many, but not before so many bytes.
SPREAD, LEAST_CHUNK = 24, 8
#: Repeated stretches shorter than this many bytes stay.
LEAST_BYTES = 96
#: Bytes hashed at once; a text's blocks overlap by the hash's reach.
BLOCK, REACH = 1 << 22, 32
#: Bytes beside a run that are compared with the kept copy; and beside a chunk, whose hashes travel with it.
WINDOW, FAR, NEAR = 512, 64, 16
#: Stands for a null identity, after all others.
LAST = (1 << 63) - 1

#: A digest of 96 bits.
DIGEST = np.dtype([("d1", "<i8"), ("d2", "<u4")])
_GEAR = np.random.default_rng(2016).integers(0, 1 << 32, 256, dtype=np.uint32)


def _beside() -> np.ndarray:
    """Odd weights of the ``FAR`` bytes on both sides of a border, for the hashes near and far before it, near and far after it."""
    odd = np.random.default_rng(2017).integers(0, 128, (2 * FAR, 4)) * 2 + 1
    odd[:FAR - NEAR, 0] = odd[FAR:, :2] = odd[:FAR, 2:] = odd[FAR + NEAR:, 2] = 0
    return odd.astype(np.float32)


_BESIDE = _beside()


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: the sum of the last 32 bytes' numbers, each shifted by its distance."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        moved = np.zeros_like(h)
        moved[step:] = h[:-step] << np.uint32(step)
        h = h + moved
    return h


def borders(raw: bytes) -> list[int]:
    """Ends of the chunks of a text in UTF-8, the last one included."""
    data = np.frombuffer(raw, np.uint8)
    found = []
    for at in range(0, len(data), BLOCK):
        start = max(0, at - REACH)
        low = np.flatnonzero(gear(data[start:at + BLOCK]) < (1 << 32) // SPREAD) + start + 1
        found.append(low[low > at])
    ends = np.concatenate(found) if found else np.empty(0, np.int64)
    ends = ends[ends < len(data)]
    ends = ends[(data[ends] & 0xC0) != 0x80]
    out, last = [], 0
    for e in ends.tolist():
        if e - last >= LEAST_CHUNK:
            out.append(e)
            last = e
    if last < len(raw):
        out.append(len(raw))
    return out


def _digests(raw: bytes, ends: list[int]) -> bytes:
    """Digests of a text's chunks, 96 bits each."""
    return b"".join([hashlib.blake2b(raw[s:e], digest_size=12).digest() for s, e in zip([0, *ends], ends)])


def beside(raw: bytes, at: np.ndarray) -> np.ndarray:
    """Hashes of the bytes beside some places of a text, 8 bits each: near and far before, near and far after."""
    around = np.lib.stride_tricks.sliding_window_view(np.frombuffer(bytes(FAR) + raw + bytes(FAR), np.uint8), 2 * FAR)
    # sums stay below 2 ** 24, so they are exact
    found = [around[at[k:k + 4096]].astype(np.float32) @ _BESIDE for k in range(0, len(at), 4096)]
    return np.concatenate(found).astype(np.int64) & 0xFF


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, place, two hashes of the text, its bytes and their number."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("place"),
                       F.xxhash64("text").alias("text_hash"), F.xxhash64(F.lit(2016), "text").alias("other"),
                       F.col("text").cast("string").cast("binary").alias("text")).withColumn("bytes", F.octet_length("text"))


def first_texts(docs: DataFrame) -> DataFrame:
    """Each text that isn't empty with its first document, bucketed by its hashes."""
    first = Window.partitionBy("text_hash", "other").orderBy("place", "doc_id")
    rows = _placed(docs).where("bytes > 0").withColumn("_row", F.row_number().over(first)).where("_row = 1").drop("_row")
    return stored(rows, "chunk-texts", release=True, by=("text_hash", "other"))


def heads(texts: DataFrame) -> DataFrame:
    """The first 64 bits of each chunk's digest, one row per chunk: all that is counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raws = b.column("text").to_pylist()
            for at in range(0, len(raws), 1000):
                found = np.frombuffer(b"".join(_digests(raw, borders(raw)) for raw in raws[at:at + 1000]), DIGEST)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found["d1"]))], ["d1"])

    return texts.select("text").mapInArrow(run, "d1 long")


def chunks(texts: DataFrame) -> DataFrame:
    """One row per chunk: place (identity), text_hash, at, d1, rest.

    ``at`` holds the start in its upper half, and below it 16 bits each of the hashes of the bytes before and after;
    ``d1`` the first 64 bits of the digest, ``rest`` the size in its upper half and the other 32 bits of the digest.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place, text_hash = b.column("place").to_numpy(), b.column("text_hash").to_numpy()
            raws = b.column("text").to_pylist()
            for first in range(0, len(raws), 1000):
                rows, ats, sizes, digests = [], [], [], []
                for k, raw in enumerate(raws[first:first + 1000], first):
                    ends = borders(raw)
                    at = np.array([0, *ends])
                    near, far, near_after, far_after = beside(raw, at).T
                    digests.append(_digests(raw, ends))
                    rows.append(np.full(len(ends), k, np.int64))
                    ats.append(at[:-1] << 32 | far[:-1] << 24 | near[:-1] << 16 | far_after[1:] << 8 | near_after[1:])
                    sizes.append(np.diff(at))
                found, row = np.frombuffer(b"".join(digests), DIGEST), np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[row]), pa.array(text_hash[row]), pa.array(np.concatenate(ats)),
                     pa.array(np.ascontiguousarray(found["d1"])), pa.array(np.concatenate(sizes) << 32 | found["d2"])],
                    ["place", "text_hash", "at", "d1", "rest"])

    return texts.select("place", "text_hash", "text").mapInArrow(
        run, "place long, text_hash long, at long, d1 long, rest long")


def repeats(texts: DataFrame) -> DataFrame:
    """Chunks that repeat an earlier one: (place, text_hash, at, size) and the kept copy's (kept_in, kept_hash, kept_at)."""
    often = heads(texts).groupBy("d1").agg(F.count("*").alias("n")).where("n > 1").select("d1")
    often = stored(often, "chunk-digests", release=True)
    found = stored(chunks(texts).join(often, "d1", "left_semi"), "chunk-repeats", release=True)
    copy = F.struct("place", "text_hash", "at")
    first = found.groupBy("d1", "rest").agg(F.min(copy).alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = stored(first, "chunk-first", release=True)
    return found.join(first, ["d1", "rest"]).where(copy > F.col("kept")).select(
        "place", "text_hash", "at", F.shiftright("rest", 32).cast("int").alias("size"), F.col("kept.place").alias("kept_in"),
        F.col("kept.text_hash").alias("kept_hash"), F.col("kept.at").alias("kept_at"))


def _reach(differ: np.ndarray) -> np.ndarray:
    """Bytes that a run may grow by where the hashes beside it differ so."""
    return np.where(differ & 0xFF, NEAR - 1, np.where(differ & 0xFF00, FAR - 1, WINDOW)).astype(np.int64)


def _long_enough(text: np.ndarray, low: np.ndarray, high: np.ndarray, least_bytes: int) -> np.ndarray:
    """Which runs of some texts lie in stretches that may reach ``least_bytes``; they may grow to reach from low to high."""
    # by the least start each may reach: runs that cannot meet are never in one stretch
    low, high = low + (text << 33), high + (text << 33)
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    begins = np.flatnonzero(np.append(True, low[1:] > high[:-1]))
    ends = np.append(begins[1:], len(low)) - 1
    return order[np.repeat(high[ends] - low[begins] >= least_bytes, ends - begins + 1)]


def runs(texts: DataFrame, copied: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Repeated chunks joined where both they and their kept copies are neighbours, if they may get long enough.

    One row per run: text_hash, other, start, end, the kept copy's kept_in, kept_hash, kept_start, kept_end, and how far it may
    grow, before and after. Texts of several documents (``copied``) also have a row with start -1 for each document that
    keeps chunks of theirs.
    """
    ids = texts.select("place", "text_hash", "other", "bytes").join(
        copied.select("text_hash", "other", F.lit(True).alias("copied")), ["text_hash", "other"], "left")
    found = repeats(texts).groupBy("place", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("at", "size", "kept_in", "kept_hash", "kept_at"))).alias("found")).join(
        ids, ["place", "text_hash"]).withColumn("copied", F.coalesce("copied", F.lit(False)))
    names = ["text_hash", "other", "start", "end", "kept_in", "kept_hash", "kept_start", "kept_end", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            place, text_hash, other, size = (b.column(c).to_numpy() for c in ("place", "text_hash", "other", "bytes"))
            copied = b.column("copied").to_numpy(zero_copy_only=False)
            at, length, kept_in, kept_hash, kept_at = (c.to_numpy() for c in b.column("found").flatten().flatten())
            text = np.repeat(np.arange(b.num_rows), b.column("found").value_lengths().to_numpy())
            start, kept_start, differ = at >> 32, kept_at >> 32, at ^ kept_at
            end, kept_end = start + length, kept_start + length
            on = (text[1:] == text[:-1]) & (start[1:] == end[:-1]) & (kept_start[1:] == kept_end[:-1])
            on &= (kept_in[1:] == kept_in[:-1]) & (kept_hash[1:] == kept_hash[:-1])
            i = np.flatnonzero(np.append(True, ~on))
            j = np.append(i[1:], len(at)) - 1
            before, after = _reach(differ[i] >> 16), _reach(differ[j])
            ok = _long_enough(text[i], np.maximum(start[i] - before, 0), np.minimum(end[j] + after, size[text[i]]), least_bytes)
            i, j = i[ok], j[ok]
            out = [text_hash[text[i]], other[text[i]], start[i], end[j], kept_in[i], kept_hash[i], kept_start[i], kept_end[j],
                   before[ok], after[ok]]
            own = np.flatnonzero(copied & (np.bincount(text, length, b.num_rows).astype(np.int64) < size))
            mine = copied[text]
            keeps = np.unique(np.stack([np.append(text[mine], own), np.append(kept_in[mine], place[own])]), axis=1)
            none = np.full(keeps.shape[1], -1)
            out = [np.append(x, y) for x, y in zip(out, [text_hash[keeps[0]], other[keeps[0]], none, none, keeps[1], *[none] * 5])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    return found.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def edges(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Both ends of each run: text_hash, other, start, end, kept_in, after (or before), beside (the kept copy's bytes there)."""
    ends = found.select("text_hash", "other", "start", "end", "kept_in", "kept_hash", F.explode(F.array(
        F.struct(F.col("kept_start").alias("at"), F.lit(False).alias("after"), F.col("before").cast("int").alias("width")),
        F.struct(F.col("kept_end").alias("at"), F.lit(True).alias("after"), F.col("after").cast("int").alias("width")))).alias("edge"))
    ends = ends.select("*", "edge.*").drop("edge")
    asked = ends.groupBy("kept_in", "kept_hash").agg(F.collect_set(F.struct("at", "after", "width")).alias("asked"))
    asked = asked.withColumnsRenamed({"kept_in": "place", "kept_hash": "text_hash"}).join(
        texts.select("place", "text_hash", "other"), ["place", "text_hash"]).select("text_hash", "other", "asked")
    asked = stored(asked, "chunk-asked", release=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place, text_hash, asked = b.column("place").to_numpy(), b.column("text_hash").to_numpy(), b.column("asked")
            at, after, width = asked.flatten().flatten()
            sizes, done = asked.value_lengths().to_numpy(), 0
            wanted = list(zip(at.to_pylist(), after.to_pylist(), width.to_pylist()))
            for k, raw in enumerate(b.column("text").to_pylist()):
                mine = slice(done, done := done + int(sizes[k]))
                found = [raw[x:x + w] if right else raw[max(0, x - w):x] for x, right, w in wanted[mine]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), place[k])), pa.array(np.full(len(found), text_hash[k])), at[mine], after[mine],
                     width[mine], pa.array(found, pa.binary())], ["kept_in", "kept_hash", "at", "after", "width", "beside"])

    given = texts.select("text_hash", "other", "place", "text").join(asked, ["text_hash", "other"]).drop("other").mapInArrow(
        run, "kept_in long, kept_hash long, at long, after boolean, width int, beside binary")
    given = stored(given, "chunk-beside", release=True)
    return ends.join(given, ["kept_in", "kept_hash", "at", "after", "width"]).select(
        "text_hash", "other", "start", "end", "kept_in", "after", "beside")


def _alike(one: bytes, other: bytes, order: str) -> int:
    """Bytes that two strings share from their start (order little) or from their end (big)."""
    n = min(len(one), len(other))
    one, other = (one[:n], other[:n]) if order == "little" else (one[len(one) - n:], other[len(other) - n:])
    differ = int.from_bytes(one, order) ^ int.from_bytes(other, order)
    return (differ & -differ).bit_length() - 1 >> 3 if differ else n


def extended(raw: bytes, cut: list[tuple]) -> list[list]:
    """Stretches [start, end, documents of the kept copies] of a text: its runs' ends moved outwards, whole characters only."""
    wide = []
    for start, end, kept_in, after, there in cut:
        if after:
            end += _alike(raw[end:end + len(there)], there, "little")
            while end < len(raw) and raw[end] & 0xC0 == 0x80:
                end -= 1
        else:
            start -= _alike(raw[max(0, start - len(there)):start], there, "big")
            while raw[start] & 0xC0 == 0x80:
                start += 1
        wide.append((start, end, kept_in))
    out: list[list] = []
    for start, end, kept_in in sorted(wide):
        if out and out[-1][1] >= start:
            out[-1][1] = max(out[-1][1], end)
            out[-1][2].add(kept_in)
        else:
            out.append([start, end, {kept_in}])
    return out


def _copies(keys: DataFrame, copied: DataFrame, found: DataFrame) -> DataFrame:
    """Results of the documents that have a text long enough, but not as its first: all of it has an earlier copy."""
    kept = found.where("start < 0").groupBy("text_hash", "other").agg(F.sort_array(F.collect_set("kept_in")).alias("kept_in"))
    kept = stored(copied.join(kept, ["text_hash", "other"], "left").select(
        "text_hash", "other", "first", F.coalesce("kept_in", F.array("first")).alias("kept_in")), "chunk-kept", release=True)
    return keys.join(kept, ["text_hash", "other"]).where("place <> first").select(
        "doc_id", F.lit("").alias("text"), F.col("bytes").cast("long").alias("removed_bytes"),
        F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("bytes").cast("long").alias("end"))).alias("spans"),
        F.transform("kept_in", lambda k: F.nullif(k, F.lit(LAST))).alias("kept_in"))


def deduplicate(docs: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """One row per document: doc_id, text without its repeated stretches, removed_bytes, spans, kept_in.

    ``spans`` are the stretches cut, in bytes of the UTF-8 text; ``kept_in`` lists the documents that
    keep what was cut.
    """
    texts = first_texts(docs)
    enough = F.coalesce(F.col("bytes") >= max(1, least_bytes), F.lit(False))
    keys = stored(_placed(docs).withColumn("text", F.when(~enough, F.col("text"))), "chunk-keys")
    longer, both = keys.where(enough).drop("text"), ["text_hash", "other"]
    copied = longer.groupBy(both).agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    copied = stored(copied, "chunk-copied", release=True)
    found = stored(runs(texts, copied, least_bytes), "chunk-runs", release=True)
    cuts = edges(texts, found.where("start >= 0")).groupBy(both).agg(
        F.collect_list(F.struct("start", "end", "kept_in", "after", "beside")).alias("cuts"))
    cuts = stored(cuts, "chunk-cuts", release=True)
    # rows of equal identity and equal text
    same = longer.join(copied, both).where("place = first").groupBy(both).agg(
        F.collect_list(F.struct("doc_id")).alias("same")).where(F.size("same") > 1)
    rows = texts.where(enough).join(cuts, both, "left").join(same, both, "left").select(
        F.explode(F.coalesce("same", F.array(F.struct("doc_id")))).alias("row"), "text", "cuts")
    rows = rows.select("row.doc_id", "text", "cuts").unionByName(
        keys.where(~enough).select("doc_id", "text"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            out, removed, spans, kept, done = [], [], [], [], 0
            cuts = list(zip(*(c.to_pylist() for c in b.column("cuts").flatten().flatten())))
            for raw, n in zip(b.column("text").to_pylist(), b.column("cuts").value_lengths().to_pylist()):
                cut = cuts[done:done + (n or 0)]
                done += n or 0
                stretches = [s for s in extended(raw, cut) if s[1] - s[0] >= least_bytes]
                if stretches:
                    ends = [0, *(s[1] for s in stretches)]
                    starts = [*(s[0] for s in stretches), len(raw)]
                    raw = b"".join(raw[x:y] for x, y in zip(ends, starts))
                out.append(None if raw is None else raw.decode("utf-8", "replace"))
                removed.append(sum(s[1] - s[0] for s in stretches))
                spans.append([{"start": s[0], "end": s[1]} for s in stretches])
                kept.append(sorted({None if k == LAST else k for s in stretches for k in s[2]}, key=lambda k: (k is None, k)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(out, pa.string()), pa.array(removed, pa.int64()), pa.array(spans, span),
                 pa.array(kept, pa.list_(pa.int64()))], ["doc_id", "text", "removed_bytes", "spans", "kept_in"])

    firsts = rows.mapInArrow(run, "doc_id long, text string, removed_bytes long, "
                                  "spans array<struct<start: long, end: long>>, kept_in array<long>")
    return firsts.unionByName(_copies(longer, copied, found))
