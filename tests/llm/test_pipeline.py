"""The corpus pipeline against a brute-force version of all its stages."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from test_llm_near import plain_components, plain_fingerprint
from velomesh.llm import language_id
from velomesh.llm.queries import tokenizer

SMALL = "/root/testdata/sf0.001"


def language(rows):
    space, sums = language_id.Space(), {}
    unit = lambda v: None if v is None or not v.any() else v / np.linalg.norm(v)
    for r in rows:
        v = unit(space.bundle(r.text or ""))
        if v is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            sums[r.lang] = sums.get(r.lang, 0) + v
    langs = [unit(v) for v in sums.values()]
    near = [unit(space.bundle(r.text or "")) for r in rows]
    return [r for r, v in zip(rows, near) if v is not None and max(float(p @ v) for p in langs) >= corpus_pipeline.FLOOR]


def exact(rows):
    seen = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        seen.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r)
    return list(seen.values())


def near(rows):
    rows = sorted(rows, key=lambda r: r.doc_id)
    return [r for k, (r, c) in enumerate(zip(rows, plain_components([plain_fingerprint(r.text) for r in rows]))) if k == c]


def mix(rows):
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    names = sorted({r.source for r in rows if r.source is not None}) + [None] * any(r.source is None for r in rows)
    have = {s: sum(size[r.doc_id] for r in rows if r.source == s) for s in names}
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    full, goal = set(), {}
    while True:
        free = [s for s in names if s not in full]
        left = sum(have.values()) - 3 * sum(have[s] for s in full)
        goal = {s: Fraction(3 * have[s]) if s in full else Fraction(left * weight[s], sum(weight[x] for x in free)) for s in names}
        over = {s for s in free if goal[s] > 3 * have[s]}
        if not over:
            break
        full |= over
    out = []
    for s in names:
        if not have[s]:
            continue
        passes, rest = divmod(goal[s], have[s])
        own = sorted((int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16), r.doc_id, r) for r in rows if r.source == s)
        total = 0
        for _, i, r in own:
            n = size[i]
            extra = total + n <= rest or (total <= rest and 2 * (rest - total) > n)
            total += n
            out += [r] * (int(passes) + extra if n else 0)
    return out


def test_pipeline_is_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    library = Tokenizer.from_file(tokenizer())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for (name, stage), plain in zip(corpus_pipeline.STAGES, (language, exact, near, mix)):
        columns = docs.columns
        docs = stage(spark, docs, SMALL)
        rows = plain(rows)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, rows)), name
    want = []
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(want)


def test_pipeline_of_odd_rows(spark, tmp_path):
    rows = [(k, f"some words of text number {k % 7} and more of them", "en", None if k % 2 else "s", 1) for k in range(30)]
    rows += [(40, None, "en", "s", None), (41, "", None, None, 0), (42, "12 34", "en", "s", 1), (43, "some words " * 30_000, None, "t", 1),
             (None, "some words without a name", "en", "t", 1), (5, rows[5][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.selectExpr("*", "1 AS _doc", "'x' AS threshold").write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and not {40, 41, 42} & {r.doc_id for r in got}
    docs.where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_stages_call_the_dealt_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "source_mixing", "pair_bpe"]
