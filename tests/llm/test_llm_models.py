"""Language identification, toxicity and neighbour search: properties, brute force and held-out quality."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from velomesh.llm import language_id, prefix_forest, toxic_segments
from velomesh.llm.queries import QUERIES

SMALL, MIDDLE, LARGE = (f"/root/testdata/sf{k}" for k in ("0.001", "0.01", "0.1"))


def test_vectors_bind_and_bundle():
    space = language_id.Space(256, 3)
    want = np.zeros(256)
    text = " ab b "
    for x, y, z in zip(text, text[1:], text[2:]):
        want += np.roll(space._letter(ord(x)), 2) * np.roll(space._letter(ord(y)), 1) * space._letter(ord(z))
    assert (space.bundle("AB, 7b!") == want).all()
    assert space.bundle("12 .,") is None and space.bundle("") is None


def test_bundle_in_blocks_and_with_few_kept(monkeypatch):
    text = "".join(random.Random(1).choices("abcdeéß ", k=4000))
    whole = language_id.Space(128).bundle(text)
    monkeypatch.setattr(language_id, "BLOCK", 101)
    assert (language_id.Space(128).bundle(text) == whole).all()
    monkeypatch.setattr(language_id, "KEPT_GRAMS", 50)
    assert (language_id.Space(128).bundle(text) == whole).all()
    monkeypatch.setattr(language_id, "KEPT_LETTERS", 2)
    assert (language_id.Space(128).bundle(text) == whole).all()


def test_language_query_learns_and_holds_out(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    got = QUERIES["op1_language_id"](spark, MIDDLE).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(docs[r.doc_id].lang == r.lang_pred for r in held) >= 0.99 * len(held)


def test_language_of_odd_rows(spark):
    rows = [(k, "the cat sat on the mat", "en") for k in range(20)] + [(20 + k, "der Hund lief über die Straße", "de") for k in range(20)]
    rows += [(50, None, "en"), (51, "", "en"), (52, "123 !!", None), (53, "the mat " * 40_000, None), (None, "die Straße", "de"), (53, "Hund", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit("x"), "share": F.lit(1)})
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(docs).collect()}
    assert {(50, "und"), (51, "und"), (52, "und"), (53, "en"), (53, "de"), (None, "de")} <= got
    kept = language_id.keep_known(docs, 0.05)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {*range(40), 53, None}
    assert {r.lang_pred for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_prediction_does_not_see_labels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    fake = F.when(language_id.held_out(), F.lit("xx")).otherwise(F.col("lang"))
    changed = docs.withColumns({"lang": fake, "source": F.lit("s")})
    assert sorted(map(tuple, language_id.identify(docs).collect())) == sorted(map(tuple, language_id.identify(changed).collect()))


def plain_segments(x):
    """Maximal segments by their definition: the best one, then left and right of it."""
    out = []

    def rec(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += x[j]
                if total > 1e-9 and (best is None or total > best[2] + 1e-9):
                    best = (i, j, total)
        if best:
            rec(a, best[0]), out.append(best), rec(best[1] + 1, b)

    rec(0, len(x))
    return out


def test_segments_are_maximal():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(0, 25)
        scored = [(i, rng.choice([1.37, 2.11, 0.53, -0.71, 0.31])) for i in range(n) if rng.random() < 0.4]
        x = [-0.4] * n
        for i, s in scored:
            x[i] = s
        got = [(a, b, round(s, 6)) for a, b, s in toxic_segments.segments(scored, 0.4)]
        assert got == [(a, b, round(s, 6)) for a, b, s in plain_segments(x)]


def test_toxicity_is_learned(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    got = QUERIES["op9_toxicity"](spark, LARGE).collect()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    for r in got[:500]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    toxic = [r for r in held if labels[r.doc_id]]
    clean = [r for r in held if not labels[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.04 * len(clean)


def test_toxicity_of_odd_rows(spark):
    rows = [(k, "calm words here " * 5 + ("vile " * 3 if k % 4 == 0 else "kind")) for k in range(200)]
    rows += [(500, None), (501, ""), (502, "calm " * 50_000 + "vile vile vile"), (503, "vile"), (503, "vile"), (None, "vile")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"toxic": F.lit("x"), "half": F.lit(2)})
    labels = spark.createDataFrame([(k, 0, int(k % 4 == 0)) for k in range(200)] + [(9000, 0, 1), (None, 0, 1), (3, 0, 7), (4, 0, None)],
                                   "doc_id long, quality int, toxic int")
    got = toxic_segments.detect(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[8].predicted == 1 and by[9].predicted == 0 and by[503].predicted == by[None].predicted == 1
    assert by[500].score == by[501].score < 0.5 and by[502].segments
    assert {r.score for r in toxic_segments.detect(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert toxic_segments.detect(docs.where("false"), labels).count() == 0


def plain_neighbours(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            good.setdefault(i, np.array(v, float))
    ids = sorted(good)
    out = {}
    for q in ids:
        if q % 20 == 0:
            near = sorted((-(good[q] * good[i]).sum(), i) for i in ids if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"entry": F.lit(1), "ids": F.lit("x")})


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_search_of_odd_rows_is_exact(spark):
    """Small tables are searched from the root, so results are exact, ties and copies included."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6))]) for i in range(50)]
    rows += [(60 + i, rows[3][1]) for i in range(40)] + [(200, None), (220, []), (240, [0.0] * 6), (260, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
                                                          (280, [float("nan")] * 6), (300, [float("inf")] * 6), (320, [1.0, 2.0]), (None, rows[0][1]), rows[0]]
    got = found(prefix_forest.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=20))
    want = plain_neighbours([r for r in rows if r[1] is None or len(r[1]) != 2], 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    for q, near in got.items():
        assert np.allclose([s for _, s in near], [s for _, s in want[q]], rtol=0, atol=1e-12)
    assert found(prefix_forest.search(vectors(spark, rows[:4]), F.col("vec_id") % 20 == 0)) .keys() == {0}
    assert not found(prefix_forest.search(vectors(spark, rows[:4]).where("false"), F.col("vec_id") % 20 == 0))


@pytest.mark.parametrize("cut", [None, 64])
def test_search_recall(spark, cut, monkeypatch):
    """Recall on rows in and between tight groups, of unequal lengths; also where cells are cut."""
    if cut:
        monkeypatch.setattr(prefix_forest, "CELL_ROWS", cut)
        monkeypatch.setattr(prefix_forest, "CELL_QUERIES", 8)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(5, 16))
    points = [centres[i % 5] * 2 + rng.normal(size=16) * 0.05 if i % 3 else rng.normal(size=16) for i in range(2000)]
    rows = [(i, [float(x) for x in np.float32(p * (1 + i % 4))]) for i, p in enumerate(points)]
    got = found(prefix_forest.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=20))
    want = plain_neighbours(rows, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert np.mean(hits) >= 0.9 * 20


def test_registered_search_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{LARGE}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = found(QUERIES["op10_prefix_forest"](spark, LARGE)), plain_neighbours(rows, 20)
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]) >= 0.9 * 20


def test_rows_of_one_identity_are_different_rows(spark):
    """Two vectors under one identity: two queries with ranks of their own, each a candidate of the other."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6))]) for i in [*range(40), 20, 5]]
    got = sorted(tuple(r) for r in prefix_forest.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=20, recall=1.0).collect())
    want = []
    for at, (q, v) in enumerate(rows):
        if q % 20 == 0:
            near = sorted((-float(np.dot(np.array(v), np.array(w))), i) for k, (i, w) in enumerate(rows) if k != at)[:20]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    assert [r[:3] for r in got] == [r[:3] for r in sorted(want)] and np.allclose([r[3] for r in got], [r[3] for r in sorted(want)])


def test_cuts_let_every_query_meet_every_vector_once():
    cuts = prefix_forest._Cuts.of(pd.DataFrame({"tree": [3, 0], "length": [1, 0], "prefix": [7, 0], "ask_cuts": [2, 1], "row_cuts": [5, 3]}))
    asks, rows = np.arange(20), np.arange(100, 150)

    def placed(entry, side, cell):
        where = [np.full(len(entry), c) for c in cell]
        at, first, second = cuts.blocks(*where, entry, side)
        return list(zip(entry[at].tolist(), first.tolist(), second.tolist()))

    for cell, n in (((3, 1, 7), 10), ((0, 0, 0), 3), ((3, 1, 8), 1)):
        left, right = placed(asks, prefix_forest.ASKS, cell), placed(rows, prefix_forest.ROWS, cell)
        met = [(q, r) for q, *a in left for r, *b in right if a == b]
        assert len(met) == len(set(met)) == 1000 and len({tuple(b) for _, *b in right}) <= n
