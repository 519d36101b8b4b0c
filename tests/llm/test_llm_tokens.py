"""Token operators against the tokenizers library, byte for byte."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from velomesh.llm import pair_bpe, plane_files
from velomesh.llm.queries import tokenizer
from velomesh.llm.tokens import TextEncoder

ODD = ["", None, "a<|endoftext|> b ÀÉ 'Tis IT'S don't 12 ǅ İ ΑΣ ΣΑΣ. Σ", "x\x1cy\x1d z\x85w v　u​q r", "é á ́b J̌",
       "<|startoftext|><|endoftext|>x<|endof", "日本語 ٣٤ ½ aaaaaaaaa aaa aa a", "we're I'LL 'S's 'rex ''t", "ſ K Å ẞ", "  \n ", "...a, b!? c;d e:. . ,",
       "İstanbul ŒUVRE ǅ \U00010400", "a᠎b﻿c⁠d", "١٢٣ⅧⅦ", "word " * 60_000, "z" * 5000, "same", "same"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer())


def random_texts(n=300):
    rng = random.Random(3)
    letters = "abcdeéêüßñ'AÀ.,!? \n\t<|>12́ \x1d日"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(n)]


@pytest.mark.parametrize("held", [1, 400_000])
def test_encoders_agree_with_the_library(library, held):
    texts = [t or "" for t in ODD] + random_texts()
    bpe, _ = pair_bpe.load(tokenizer())
    own = TextEncoder(bpe.encode_runs, bpe.encode_others, held)
    lib = plane_files.library_encoder(tokenizer())
    for text, a, b in zip(texts, own.encode(texts), lib.encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(a, "<u4").tolist() == ids, repr(text[:80])
        assert a == b
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_encode_decode_query(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "same"), (None, "no name")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "n_tokens": F.lit("x")})
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids))
    got = pair_bpe.encode_decode(docs, tokenizer(), with_ids=True).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert pair_bpe.encode_decode(docs.where("false"), tokenizer()).count() == 0


def test_planes_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 7, 65_536):
        raw = rng.integers(0, 1 << 32, n, dtype=np.uint32).astype("<u4").tobytes()
        assert plane_files.from_planes(plane_files.to_planes(raw)) == raw


def test_checksums_join():
    parts = [random.Random(k).randbytes(n) for k, n in enumerate((0, 1, 1000, 70_000, 3))]
    assert plane_files.crc_join([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


@pytest.mark.parametrize("block_ids", [16, 65_536])
def test_plane_files_hold_every_document(spark, library, tmp_path, block_ids):
    rows = [(100 - 3 * i, t) for i, t in enumerate(ODD)] + [(None, "no name")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit("p"), "start": F.lit(-1)}).repartition(5)
    path = str(tmp_path / "planes")
    plane_files.write(docs, path, tokenizer(), 2, block_ids)
    got = plane_files.read_documents(spark, path).collect()
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    stored = spark.read.parquet(path)
    assert stored.agg(F.max("n_ids")).first()[0] <= block_ids and stored.agg(F.sum("n_ids")).first()[0] == start


def test_plane_files_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert plane_files.encode_documents(none, tokenizer()).count() == 0


def test_equal_identities_lie_side_by_side(spark):
    docs = spark.createDataFrame([(1, "b c"), (1, "a"), (1, "b c"), (0, "d")], "doc_id long, text string")
    got = sorted((r.start, r.n_tokens) for r in plane_files.encode_documents(docs, tokenizer()).collect())
    assert [s for s, _ in got] == [sum(n for _, n in got[:k]) for k in range(4)]


def test_few_texts_are_split_at_once():
    """A worker splits no more characters at once than it is told to, and the ids do not change by that."""
    seen = []

    def raw(words):
        seen.append(len(words))
        return [w.encode() for w in words]
    texts = [f"word{chr(97 + i)} other{chr(97 + i)}, {i}" for i in range(20)]
    whole = list(TextEncoder(raw, raw).encode(texts))
    most = max(seen)
    seen.clear()
    assert list(TextEncoder(raw, raw, block_chars=40).encode(texts)) == whole
    assert max(seen) * 5 < most


def test_marks_behind_letters_are_learnt_apart(library):
    texts = ["ab cd,%% ab%% é)]. ab).", "don't' x'. 'y' a1% <|endoftext|>. b<|endoftext|>% %% ab", "x#", "ÉÀ*** Σ@ ǆ_ e\u0301% ab%%"]
    asked = []
    lib = plane_files.library_encoder(tokenizer())
    own = TextEncoder(lambda w: lib.runs(w), lambda w: (asked.extend(w), lib.others(w))[1])
    for text, raw in zip(texts, own.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    # each run of marks is asked for once, whatever stands before it
    assert not {"cd,%%", "ab%%", "é)].", "ab).", "x#"} & set(asked)
    assert len(asked) == len(set(asked)) and {",%%", "%%", ")].", ").", "#"} <= set(asked)
