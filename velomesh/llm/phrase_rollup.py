"""Phrases of two to four words by top-order marginalisation.

Every word starts one window: itself and the words that lead behind it in its piece, padded to four with nulls. Only
these longest windows are counted; ``GROUP BY lang, ROLLUP (w1, w2, w3, w4)`` then sums them up over ever
shorter prefixes, which gives the count of every phrase, every word and every language at once.

Most windows of four words are seen once. A phrase that counts holds only pairs and triples that count, so sieves go
first: pairs are counted by a 64-bit hash, and the frequent ones set bits in a map of bounded size; then
triples whose pairs passed. A window is padded from the first word that surely makes it too rare. The
maps may let rare runs through, which costs work but changes no result: all counts come from the windows.

Defined results: a null text is empty, a null language ``und``; words are cut at blanks and tabs, pieces at
marks and line ends; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velomesh.llm.common import stored

#: Words of the longest phrase.
TOP = 4
COLUMNS = tuple(f"w{k}" for k in range(1, TOP + 1))
#: Text handled at once, in bytes; rows read and handed on at once.
BLOCK_BYTES, READ_ROWS, WRITE_ROWS = 1_000_000, 64, 20_000
#: Bits of a sieve for each frequent run of words, and at most (32 MB).
SIEVE_ROOM, SIEVE_BITS = 64, 1 << 28
#: Slices in which the best phrases of a language are found before they meet.
SLICES = 64
#: Bytes that end a piece, and bytes that end a word.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(BREAKS)] = 2


class Words:
    """The words of a block of texts in their order, as numbers of a list of distinct words.

    ``joined[i]`` says whether word i + 1 stands behind word i in one piece.
    """

    def __init__(self, texts: list[bytes], langs: np.ndarray):
        data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        kind = _KIND[data]
        inside = kind == 0
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        first = np.flatnonzero(starts)
        offsets = np.append(np.cumsum(inside)[first] - 1, inside.sum()).astype(np.int32)
        flat = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        coded = flat.dictionary_encode()
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.list = coded.dictionary
        piece = np.cumsum(kind == 2)[first]
        self.joined = piece[1:] == piece[:-1] if len(first) else np.empty(0, bool)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.lang = langs[np.searchsorted(ends, first, "right")]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """Words of blocks of whole texts, with the languages they are numbered by."""
    names: dict[str, int] = {}
    texts, langs, size = [], [], 0
    slices = (batch.slice(at, READ_ROWS) for batch in batches for at in range(0, batch.num_rows, READ_ROWS))
    for few in slices:
        for lang, text in zip(few.column("lang").to_pylist(), few.column("text").cast(pa.binary()).to_pylist()):
            if size and size + len(text) > BLOCK_BYTES:
                yield Words(texts, np.array(langs)), list(names)
                texts, langs, size = [], [], 0
            texts.append(text)
            langs.append(names.setdefault(lang, len(names)))
            size += len(text) + 1
    if texts:
        yield Words(texts, np.array(langs)), list(names)


def _runs(words: Words, names: list[str], sieves: Sequence[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For two, three, ... words on from each word: whether they may be a frequent run of one piece, and their hash.

    Runs of the lengths that have a sieve are tested by it; a longer one is possible where its two shorter ones are.
    """
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words.list.to_pylist()), np.uint64, len(words.list))
    tongue = np.fromiter((xxhash.xxh3_64_intdigest(n.encode()) for n in names), np.uint64, len(names))
    own = own[words.ids]
    with np.errstate(over="ignore"):
        run, open_ = own ^ tongue[words.lang], words.joined
        for k in range(1, min(TOP, len(own))):
            run = run[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[k:]
            run = (run ^ (run >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            run ^= run >> np.uint64(32)
            if k > 1:
                open_ = open_[:-1] & open_[1:]
            if k <= len(sieves):
                open_ = open_ & _passes(sieves[k - 1], run)
            yield open_, run


def _count_runs(sieves: Broadcast | None, length: int):
    """(run, n): hashes of runs of ``length`` words that the sieves of shorter runs let through."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, names in _blocks(batches):
            for open_, run in itertools.islice(_runs(words, names, sieves.value if sieves else []), length - 2, length - 1):
                runs, n = np.unique(run[open_], return_counts=True)
                for at in range(0, len(runs), WRITE_ROWS):
                    few = slice(at, at + WRITE_ROWS)
                    yield pa.RecordBatch.from_arrays([pa.array(runs[few].view(np.int64)), pa.array(n[few].astype(np.int64))],
                                                     names=["run", "n"])
    return count


def run_sieve(docs: DataFrame, length: int, least: int, shorter: Sequence[np.ndarray] = ()) -> np.ndarray:
    """Bits by hash of ``length`` words, as 64-bit words: set for all that occur ``least`` times, and by chance for few others.

    The map has ``SIEVE_ROOM`` bits for each frequent run, up to ``SIEVE_BITS`` altogether, whatever the
    input; it is put together by the tasks and at most that large when it reaches the driver.
    """
    known = docs.sparkSession.sparkContext.broadcast(list(shorter)) if shorter else None
    runs = docs.mapInArrow(_count_runs(known, length), "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))
    frequent = stored(runs.where(F.col("n") >= least).select("run"), "phrase-runs")
    bits = 1 << 12
    while bits < min(frequent.count() * SIEVE_ROOM, SIEVE_BITS):
        bits *= 2
    place = F.col("run").bitwiseAND(F.lit(bits - 1))
    cells = (frequent.groupBy(F.shiftright(place, 6).alias("cell"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast((run & {bits - 1}) & 63 AS INT))")).alias("bits")).toArrow())
    sieve = np.zeros(bits // 64, np.uint64)
    sieve[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return sieve


def _passes(sieve: np.ndarray, runs: np.ndarray) -> np.ndarray:
    place = runs & np.uint64(len(sieve) * 64 - 1)
    return (sieve[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _combine(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Number equal (left, right) alike: the number of each row, and one row of each number."""
    _, one, number = np.unique(left * width + right, return_index=True, return_inverse=True)
    return number, one


def _windows(sieves: Broadcast):
    """(lang, w1, w2, w3, w4, n): the padded windows of each block, counted."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, names in _blocks(batches):
            if not len(words.ids):
                continue
            pad, n = len(words.list), len(words.ids)
            leads = [words.ids]
            for k, (open_, _) in enumerate(_runs(words, names, sieves.value), 1):
                lead = np.full(n, pad, np.int64)
                lead[:n - k] = np.where(open_, words.ids[k:], pad)
                leads.append(lead)
            leads += [np.full(n, pad, np.int64)] * (TOP - len(leads))
            number, row = words.lang.astype(np.int64), None
            for lead in leads:
                number, row = _combine(number, lead, pad + 1)
            spelt = pa.concat_arrays([words.list.cast(pa.string()), pa.nulls(1, pa.string())])
            times, langs = np.bincount(number), pa.array(names)
            del number
            for at in range(0, len(row), WRITE_ROWS):
                few = row[at:at + WRITE_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(words.lang[few])), *[spelt.take(pa.array(x[few])) for x in leads],
                     pa.array(times[at:at + WRITE_ROWS])], names=["lang", *COLUMNS, "n"])
    return windows


def marginal_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, size, words, n): occurrences of phrases of ``size`` words, with size 0 for all words of a language.

    Phrases of two words and more are whole from ``least`` occurrences on and may be missing below; the result
    is cut there. The longest windows are counted first; the prefixes are sums of those counts.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    sieves: list[np.ndarray] = []
    for length in range(2, TOP):
        sieves.append(run_sieve(texts, length, least, sieves))
    schema = f"lang string, {', '.join(f'{c} string' for c in COLUMNS)}, n long"
    longest = texts.mapInArrow(_windows(spark.sparkContext.broadcast(sieves)), schema).groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))
    names = ", ".join(COLUMNS)
    summed = spark.sql(f"SELECT lang, {names}, {TOP} - bit_count(grouping_id()) AS size, sum(n) AS n "
                       f"FROM {{longest}} GROUP BY lang, ROLLUP ({names})", longest=longest)
    # a prefix that ends in padding is a shorter phrase, counted at its own length
    whole = F.coalesce(F.element_at(F.array(*COLUMNS), F.greatest(F.col("size"), F.lit(1))).isNotNull(), F.lit(False))
    kept = summed.where((F.col("size") == 0) | (whole & (F.col("n") >= least)))
    return kept.select("lang", F.col("size").cast("int").alias("size"),
                       F.filter(F.array(*COLUMNS), lambda w: w.isNotNull()).alias("words"), "n")


def _spelt(words) -> F.Column:
    return F.array_join(words, " ")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, size, words, phrase, a, l, r, score): every candidate with its lowest-scoring cut."""
    parts = counts.where("size BETWEEN 1 AND 3").select("lang", _spelt("words").alias("part"), "n")
    phrases = counts.where("size >= 2").select("lang", "size", "words", F.col("n").alias("a"))
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select("*", _spelt(F.slice("words", F.lit(1), F.col("k"))).alias("head"),
                     _spelt(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k"))).alias("rest"))
    for side, name in (("head", "l"), ("rest", "r")):
        cut = cut.join(parts.select("lang", F.col("part").alias(side), F.col("n").alias(name)), ["lang", side])
    wide = "cast({} AS DECIMAL(38, 0))"
    score = F.expr(f"(2000000 * cast(a AS DECIMAL(30, 0))) div ({wide.format('l')} + {wide.format('r')})")
    worst = cut.withColumn("score", score).groupBy("lang", "size", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return worst.select("lang", "size", "words", _spelt("words").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")


def uncovered(phrases: DataFrame, share: int) -> DataFrame:
    """Candidates that no longer candidate holds in ``share`` percent of their occurrences."""
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda at: _spelt(F.slice("words", at, m)))))
    longer = phrases.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("around"))
    most = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    wide = F.lit(0).cast("decimal(38,0)")
    held = (F.col("around") + wide) * 100 >= (F.col("a") + wide) * share
    return phrases.join(most, ["lang", "phrase"], "left").where(~F.coalesce(held, F.lit(False))).drop("around")


def best(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language with their ranks; slices of a language are cut first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    slices = Window.partitionBy("lang", "_slice").orderBy(*order)
    few = (phrases.withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
           .withColumn("rank", F.row_number().over(slices)).where(F.col("rank") <= top))
    return (few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top).drop("_slice"))


def collocations(docs: DataFrame, least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of each language."""
    counts = stored(marginal_counts(docs, least), "phrase-counts")
    phrases = stored(scored(counts), "phrases")
    words = counts.where("size = 0").select("lang", "n")
    return (best(uncovered(phrases, share), top).join(words, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


