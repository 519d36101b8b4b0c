"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 that depends on nothing but its code point. An n-gram is the
elementwise product of its letters' vectors, each rotated by its place; a text is the sum of its n-grams;
a language is the sum of its training texts, each scaled to length one. A text gets the language whose
prototype has the largest cosine with it.

Prototypes are fitted on a bounded sample: of each language about ``sample`` labelled rows, chosen by a
hash of the identity. They hold one vector per language, so what goes to the tasks is bounded by the number of
language codes.

Defined results: ``und`` with score 0 where the text is null or has no letter, or where nothing could be learned;
ties go to the smaller language code; a null identity is never trained on nor held out; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.session import checkpointed

UNKNOWN = "und"
#: Length of the vectors, letters in an n-gram, labelled rows per language to learn from.
DIM, GRAM, SAMPLE = 512, 3, 4_000
#: Cosines are spread by this factor before they are made to add up to one.
SHARPNESS = 20.0
#: Texts are taken in blocks of this many letters; letters and n-grams whose vectors a worker keeps.
BLOCK, KEPT_LETTERS, KEPT_GRAMS = 1 << 20, 20_000, 60_000
_SPACE = 0x20


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each stretch of other characters as one space; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    alpha = _is_letter()[points]
    if not alpha.any():
        return np.empty(0, np.uint32)
    points = np.where(alpha, points, _SPACE)
    points = points[alpha | np.concatenate(([False], alpha[:-1]))]
    return np.concatenate(([_SPACE], points, [_SPACE] * bool(alpha[-1]))).astype(np.uint32)


class Space:
    """The random vectors of letters and n-grams."""

    def __init__(self, dim: int = DIM, gram: int = GRAM):
        self.dim, self.gram = dim, gram
        self.letter: dict[int, np.ndarray] = {}
        self.keys, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.table = np.empty((KEPT_GRAMS, dim), np.int8)

    def _letter(self, point: int) -> np.ndarray:
        v = self.letter.get(point)
        if v is None:
            if len(self.letter) >= KEPT_LETTERS:
                self.letter.clear()
            bits = np.random.Generator(np.random.PCG64(point)).integers(0, 2, self.dim, np.int8)
            v = self.letter[point] = bits * 2 - 1
        return v

    def _bound(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of n-grams given as packed code points (21 bits each, first letter highest)."""
        out = np.ones((len(grams), self.dim), np.int8)
        for place in range(self.gram):
            points = (grams >> np.uint64(21 * place)) & np.uint64((1 << 21) - 1)
            kinds, at = np.unique(points, return_inverse=True)
            out *= np.stack([np.roll(self._letter(int(p)), place) for p in kinds])[at]
        return out

    def _counted(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The different n-grams of a stretch, packed, and how often each occurs."""
        wide = points.astype(np.uint64)
        n = len(points) - self.gram + 1
        packed = np.zeros(n, np.uint64)
        for k in range(self.gram):
            packed = (packed << np.uint64(21)) | wide[k:k + n]
        packed.sort()
        first = np.flatnonzero(np.concatenate(([True], packed[1:] != packed[:-1])))
        return packed[first], np.diff(np.append(first, n))

    def _rows(self, grams: np.ndarray) -> np.ndarray | None:
        """Rows of the kept table for these n-grams; None if they are too many to keep."""
        if len(grams) > KEPT_GRAMS:
            return None
        at = np.minimum(np.searchsorted(self.keys, grams), max(len(self.keys) - 1, 0))
        if len(self.keys):
            new = grams[self.keys[at] != grams]
            if not len(new):
                return self.at[at]
        else:
            new = grams
        if len(self.keys) + len(new) > KEPT_GRAMS:
            self.keys, self.at, new = self.keys[:0], self.at[:0], grams
        new = np.sort(new)
        rows = np.arange(len(self.keys), len(self.keys) + len(new))
        for s in range(0, len(new), 4096):
            self.table[rows[s:s + 4096]] = self._bound(new[s:s + 4096])
        keys, places = np.concatenate((self.keys, new)), np.concatenate((self.at, rows))
        order = np.argsort(keys)
        self.keys, self.at = keys[order], places[order]
        return self.at[np.searchsorted(self.keys, grams)]

    def bundle(self, text: str) -> np.ndarray | None:
        """Sum of the text's n-gram vectors; None without letters."""
        points = letters(text)
        if not len(points):
            return None
        total = np.zeros(self.dim, np.float64)
        for start in range(0, len(points) - self.gram + 1, BLOCK):
            grams, counts = self._counted(points[start:start + BLOCK + self.gram - 1])
            counts = counts.astype(np.float32)
            for s in range(0, len(grams), 8192):
                g, c = grams[s:s + 8192], counts[s:s + 8192]
                at = self._rows(g)
                total += c @ (self.table[at] if at is not None else self._bound(g)).astype(np.float32)
        return total


@lru_cache(maxsize=1)
def space(dim: int, gram: int) -> Space:
    return Space(dim, gram)


def held_out(identity: str = "doc_id", folds: int = 3, fold: int = 1):
    """Whether a row is kept from learning: the remainder of its identity's CRC-32."""
    return F.coalesce(F.crc32(F.col(identity).cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(labelled: DataFrame, dim: int = DIM, gram: int = GRAM, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Prototype of each language, of length one, from rows (doc_id, text, lang).

    About ``sample`` rows per language are read: those whose hash lies below a share that follows from
    the language's count.
    """
    rows = labelled.where("lang is not null and text is not null and doc_id is not null")
    share = checkpointed(rows.groupBy("lang").agg((F.lit(float(sample)) / F.count("*")).alias("share")))
    place = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    chosen = rows.join(F.broadcast(share), "lang").where(place < F.col("share")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = space(dim, gram), {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                v = own.bundle(text)
                if v is not None and v.any():
                    sums[lang] = sums.get(lang, 0.0) + v / np.linalg.norm(v)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])], ["lang", "v"])

    parts = chosen.mapInArrow(run, "lang string, v array<double>")
    summed = (parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")))
    # one vector of fixed length per language
    found = {r["lang"]: np.array([p["x"] for p in r["v"]]) for r in summed.collect()}
    return {k: found[k] / np.linalg.norm(found[k]) for k in sorted(found) if found[k].any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dim: int = DIM, gram: int = GRAM) -> DataFrame:
    """Per row: doc_id, lang_pred, score (0 to 1), similarity (the cosine)."""
    names, matrix = list(prototypes), np.array(list(prototypes.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = space(dim, gram)
        for b in batches:
            langs, scores, cosines = [], [], []
            for text in b.column("text").to_pylist():
                v = own.bundle(text) if text and names else None
                if v is None or not v.any():
                    langs.append(UNKNOWN), scores.append(0.0), cosines.append(0.0)
                    continue
                near = np.round(matrix @ v / np.linalg.norm(v), 9)
                best = int(near.argmax())
                spread = np.exp(SHARPNESS * (near - near[best]))
                langs.append(names[best]), scores.append(float(1 / spread.sum())), cosines.append(float(near[best]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(cosines, pa.float64())],
                ["doc_id", "lang_pred", "score", "similarity"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, lang_pred string, score double, similarity double"))


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, similarity; learned from rows that are not held out."""
    prototypes = fit(docs.where(~held_out()).select("doc_id", "text", "lang"), sample=sample)
    return predict(docs, prototypes).withColumn("held_out", held_out()).select(
        "doc_id", "held_out", "lang_pred", "score", "similarity")


def keep_known(docs: DataFrame, floor: float, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without those that have no letter or are less like every learned language than ``floor``.

    Each row is judged where it lies, so rows of equal identity do not share a fate.
    """
    names = docs.columns
    prototypes = fit(docs.where(~held_out()).select("doc_id", "text", "lang"), sample=sample)
    matrix = np.array(list(prototypes.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = space(DIM, GRAM)
        at = names.index("text")
        for b in batches:
            keep = []
            for text in b.column(at).to_pylist():
                v = own.bundle(text) if text and len(matrix) else None
                keep.append(v is not None and bool(v.any()) and float((matrix @ v).max() / np.linalg.norm(v)) >= floor)
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
