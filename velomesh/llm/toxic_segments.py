"""Toxic passages by maximum-scoring segments.

Words get log-odds between toxic and clean training documents, shrunk by a Dirichlet prior whose shape is
the pooled counts. A word whose log-odds stand out from their error scores what is left of them; every other word
costs a little, so that the expected score of clean text is negative. One linear scan per text finds all
maximal scoring segments. Their scores are calibrated by extreme-value statistics: with the decay
``lam`` of the clean word scores and the factor ``k`` fitted to the best segments of clean documents,
a segment of score S in a text of n words has about k n exp(-lam S) equals by chance. A logistic curve
over the best segment's and the significant segments' evidence gives the document's score.

The classifier is fitted on a bounded sample: about ``sample`` labelled documents, chosen by a hash of the
identity. The curve is fitted on scores from words learned on the other half of the sample. Only words that
stand out come to the driver; each occurs in at least three sampled documents.

Defined results: a null or empty text has no segment and gets the score of a text without evidence; rows of equal
identity are scored one by one; a label that is neither 0 nor 1 or has no document is ignored; without
both labels to learn from, every score is 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.llm.common import stored

#: Labelled documents to learn from, about.
SAMPLE = 30_000
#: Strength of the prior as a share of the training documents; standard errors taken off a word's log-odds, and what
#: must then be left for the word to count; documents it must occur in.
PRIOR, ERRORS, LEFT, LEAST_DOCS = 0.25, 2.0, 0.5, 3
#: What a word without evidence costs.
COST = 0.05
#: Segments expected this seldom by chance in a text count as significant.
RARE = 0.01
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def held_out(identity: str = "doc_id", folds: int = 5, fold: int = 0):
    """Whether a row is kept from learning: the remainder of its identity's CRC-32."""
    return F.coalesce(F.crc32(F.col(identity).cast("string").cast("binary")) % folds == fold, F.lit(False))


def segments(scored: list[tuple[int, float]], cost: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score), in order.

    ``scored`` holds (position, score) of the words that have a score of their own; each word between
    costs ``cost``. Every candidate keeps the running sums at its ends; a new one is merged back over
    those it continues. Each candidate is pushed and removed once, so the scan is linear.
    """
    kept: list[list[float]] = []  # first, last, sum before, sum after
    link: list[int] = []  # for each kept candidate, the nearest earlier one whose sum before is smaller
    total, at = 0.0, -1
    for position, score in scored:
        total -= cost * (position - at - 1)
        at, before = position, total
        total += score
        if score <= 0:
            continue
        new = [position, position, before, total]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= new[2]:
                j = link[j]
            if j < 0 or kept[j][3] >= new[3]:
                break
            new = [kept[j][0], position, kept[j][2], total]
            del kept[j:], link[j:]
        kept.append(new)
        link.append(j)
    return [(int(a), int(b), y - x) for a, b, x, y in kept]


@dataclass(frozen=True)
class Model:
    """What scoring needs: word scores, their cost, the calibration, and the curve."""

    weights: dict[str, float]
    lam: float
    k: float
    curve: tuple[float, ...] = ()

    def evidence(self, text: str | None) -> tuple[int, list[tuple[int, int, float]], float, float]:
        """Words, segments, evidence of the best segment, and of the significant ones together.

        Evidence is the negative logarithm of the number expected by chance.
        """
        seq = words(text)
        get = self.weights.get
        scored = [(i, s) for i, s in enumerate(map(get, seq)) if s is not None]
        found = segments(scored, COST)
        base = math.log(self.k * max(len(seq), 1))
        each = [self.lam * s - base for _, _, s in found]
        return (len(seq), found, max([0.0, *each]), sum(e for e in each if e > -math.log(RARE)))

    def score(self, best: float, together: float) -> float:
        if not self.curve:
            return 0.0
        a, b, c = self.curve
        z = a + b * math.log1p(best) + c * math.log1p(together)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of documents having a word, and their standard errors, under the Dirichlet prior; counts above 0."""
    strength = PRIOR * (n_toxic + n_clean)
    share = (toxic + clean) / (n_toxic + n_clean)
    a, b = toxic + strength * share, clean + strength * share
    odds = np.log(a / (n_toxic + strength - a + 0.5)) - np.log(b / (n_clean + strength - b + 0.5))
    return odds, np.sqrt(1 / a + 1 / b)


def _weights(names: list[str], toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> dict[str, float]:
    """Words that stand out, each with its log-odds less the error taken off."""
    at = np.flatnonzero(toxic + clean >= LEAST_DOCS)
    if not len(at) or not n_toxic or not n_clean:
        return {}
    odds, error = log_odds(toxic[at], clean[at], n_toxic, n_clean)
    left = odds - ERRORS * error
    return {names[at[i]]: float(left[i]) for i in np.flatnonzero(left > LEFT)}


def _decay(values: np.ndarray, chances: np.ndarray) -> float:
    """The positive root of sum(chance * exp(lam * value)) = 1, for values with a negative mean."""
    if not len(values) or values.max() <= 0:
        return 1.0
    low, high = 0.0, 1.0
    total = lambda x: float((chances * np.exp(np.minimum(x * values, 700))).sum())
    while total(high) < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) < 1 else (low, mid)
    return high


def _calibrated(weights: dict[str, float], clean_share: dict[str, float]) -> Model:
    """Model with the decay of the clean word scores; ``clean_share`` is each word's share of clean words."""
    values = np.array([*weights.values(), -COST])
    chances = np.array([clean_share.get(w, 0.0) for w in weights])
    chances = np.append(chances, max(0.0, 1 - chances.sum()))
    if float(values @ chances) >= 0:
        return Model(weights, 1.0, 1.0)
    return Model(weights, _decay(values, chances), 1.0)


def _with_factor(model: Model, best: list[tuple[int, float]]) -> Model:
    """Fit the factor to clean documents' (words, best segment score): maximum likelihood for a given decay."""
    pairs = [(n, s) for n, s in best if n]
    if not pairs:
        return model
    total = sum(n * math.exp(-model.lam * s) for n, s in pairs)
    return Model(model.weights, model.lam, max(len(pairs) / total, 1e-12))


def _curve(best: np.ndarray, together: np.ndarray, label: np.ndarray) -> tuple[float, ...]:
    """Logistic fit over the two evidences, lightly ridged, slopes not below zero."""
    x = np.stack([np.ones(len(label)), np.log1p(best), np.log1p(together)], 1)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (label - p) - 0.01 * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3), grad)
        w[1:] = np.maximum(w[1:], 0.0)
    return tuple(float(v) for v in w)


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic, half) of about ``sample`` labelled documents, stored."""
    marked = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marked = marked.where(~held_out())
    share = sample / max(marked.count(), 1)
    spot = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 40) - 1))
    chosen = marked.where(spot / float(1 << 40) < share).withColumn("half", F.xxhash64("doc_id", F.lit(1)) % 2 == 0)
    # the sample is bounded, so its identities can go to every task
    return stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "toxic-sample")


def fit(sample: DataFrame) -> Model | None:
    """The model from stored rows (doc_id, text, toxic, half)."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[tuple[str, bool], list[int]] = {}
            for text, toxic, half in zip(*(b.column(c).to_pylist() for c in ("text", "toxic", "half"))):
                seq = words(text)
                for w in set(seq):
                    found.setdefault((w, half), [0, 0, 0])[toxic] += 1
                if not toxic:
                    for w in seq:
                        found[w, half][2] += 1
            keys = list(found)
            yield pa.RecordBatch.from_pydict({
                "word": [w for w, _ in keys], "half": [h for _, h in keys], "clean": [found[x][0] for x in keys],
                "toxic": [found[x][1] for x in keys], "times": [found[x][2] for x in keys]}, schema=pa.schema(
                    [("word", pa.string()), ("half", pa.bool_()), ("clean", pa.int64()), ("toxic", pa.int64()), ("times", pa.int64())]))

    sizes = {(r["half"], r["toxic"]): r["count"] for r in sample.groupBy("half", "toxic").count().collect()}
    n = lambda toxic, half=None: sum(v for (h, t), v in sizes.items() if t == toxic and half in (None, h))
    if not n(0) or not n(1):
        return None
    counts = sample.mapInArrow(counted, "word string, half boolean, clean long, toxic long, times long")
    by_half = lambda c, h: F.coalesce(F.sum(F.when(F.col("half") == h, F.col(c))), F.lit(0)).alias(f"{c}{int(h)}")
    table = stored(counts.groupBy("word").agg(*(by_half(c, h) for c in ("clean", "toxic", "times") for h in (False, True))), "toxic-words")
    total_words = table.agg(F.sum("times0"), F.sum("times1")).first()
    # a word can only stand out if it is more frequent in toxic documents, with its prior, in one of the three counts
    ahead = " or ".join(f"(({t}) >= 2 and ({t}) * {n(0, h)}D > ({c}) * {n(1, h)}D)"
                        for t, c, h in (("toxic0", "clean0", False), ("toxic1", "clean1", True), ("toxic0 + toxic1", "clean0 + clean1", None)))
    rows = table.where(f"toxic0 + toxic1 + clean0 + clean1 >= {LEAST_DOCS}").where(ahead).toPandas()
    names = rows["word"].tolist()
    col = lambda c, h: rows[f"{c}{int(h)}"].to_numpy(float)

    def model(halves: tuple[bool, ...]) -> Model:
        toxic, clean = (sum(col(c, h) for h in halves) for c in ("toxic", "clean"))
        weights = _weights(names, toxic, clean, sum(n(1, h) for h in halves), sum(n(0, h) for h in halves))
        times = sum(col("times", h) for h in halves)
        size = max(sum(total_words[int(h)] or 0 for h in halves), 1)
        return _calibrated(weights, {w: t / size for w, t in zip(names, times) if w in weights})

    crossed = {True: model((False,)), False: model((True,))}

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, half in zip(b.column("text").to_pylist(), b.column("half").to_pylist()):
                seq = words(text)
                get = crossed[half].weights.get
                found = segments([(i, s) for i, s in enumerate(map(get, seq)) if s is not None], COST)
                rows.append((len(seq), [s for _, _, s in found]))
            yield pa.RecordBatch.from_arrays([b.column("toxic"), b.column("half"), pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.list_(pa.float64()))], ["toxic", "half", "n", "scores"])

    found = sample.mapInArrow(best, "toxic int, half boolean, n long, scores array<double>").toPandas()  # one row per sampled document
    for half in crossed:
        part = found[(found["half"] == half) & (found["toxic"] == 0)]
        crossed[half] = _with_factor(crossed[half], [(int(a), max([0.0, *s])) for a, s in zip(part["n"], part["scores"])])
    top, together = [], []
    for size, scores, half in zip(found["n"], found["scores"], found["half"]):
        m = crossed[half]
        base = math.log(m.k * max(int(size), 1))
        each = [m.lam * s - base for s in scores]
        top.append(max([0.0, *each]))
        together.append(sum(e for e in each if e > -math.log(RARE)))
    whole = model((False, True))
    factors = [m.k for m in crossed.values()]
    curve = _curve(np.array(top), np.array(together), found["toxic"].to_numpy(float))
    return Model(whole.weights, whole.lam, math.sqrt(factors[0] * factors[1]), curve)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row: doc_id, score, segments (first word, last word, score) that are significant."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, spans = [], []
            for text in b.column("text").to_pylist():
                if model is None:
                    scores.append(0.0), spans.append([])
                    continue
                n, found, best, together = model.evidence(text)
                base = math.log(model.k * max(n, 1))
                scores.append(model.score(best, together))
                spans.append([{"first": x, "last": y, "score": s} for x, y, s in found if model.lam * s - base > -math.log(RARE)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64()), pa.array(
                spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])))],
                ["doc_id", "score", "segments"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, score double, segments array<struct<first: long, last: long, score: double>>"))


def detect(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 from 0.5 on), segments."""
    model = fit(sampled(docs, labels, sample))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"), "segments")
