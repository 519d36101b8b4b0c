"""Phrase counts, the Merkle manifest and the line index: oracle SQL on odd rows, plain versions, and their structures."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from velomesh.llm import line_index, manifest_tree, phrase_rollup
from velomesh.llm.queries import ORACLE_SQL, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows(seed):
    rng = random.Random(seed)
    words = ["the", "cat", "Sat", "on", "mat", "ÉTÉ", "a\x0bb", "x", "İ", "of"]
    line = lambda: rng.choice([" ", "\t"]).join(rng.choice(words) for _ in range(rng.randint(0, 7))) + rng.choice([".", "", "!", " \r", ","])
    rows = [(k, "\n".join(line() for _ in range(rng.randint(1, 6))), rng.choice(["en", "en", None, "fr"]),
             rng.choice(["s", "s", "t", None, "Ü"]), rng.choice([None, k])) for k in range(150)]
    rows += [(k, "The cat sat on the mat.\nOf course\n\n", "en", "s", 1) for k in range(200, 260)]
    rows += [(None, None, None, None, None), (None, "a\nb", "en", "s", 2), (7, None, "en", "s", 0), (8, "", "und", "", 0),
             (-5, "below\nzero", "en", "lone", 3), (9, ("word " * 300 + "\n") * 150 + "\n" * 500, "fr", "s", 1), rows[3], rows[3], rows[200]]
    return rows


def run(spark, tmp_path, name, rows):
    docs = spark.createDataFrame(rows, DOCS)
    # columns of other names, among them such as the operators use inside
    docs.selectExpr("*", "1 AS block", "'x' AS leaf", "2 AS w1", "'p' AS phrase", "3 AS pos").write.parquet(str(tmp_path / "documents.parquet"))
    return QUERIES[name](spark, str(tmp_path))


NEW = ("op11_phrase_rollup", "op12_manifest_tree", "op13_line_index")


@pytest.mark.parametrize("name", NEW)
def test_odd_rows_match_oracle(spark, tmp_path, name):
    rows = odd_rows(4)
    got = run(spark, tmp_path, name, rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert got.count() and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("name", NEW)
def test_empty_table(spark, tmp_path, name):
    assert run(spark, tmp_path, name, []).count() == 0


def plain_counts(rows):
    counts = Counter()
    for _, text, lang, *_ in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for mark in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(mark, "\n")
        for piece in text.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            counts[lang or "und", ()] += len(words)
            for n in range(1, 5):
                counts.update((lang or "und", tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    return counts


@pytest.mark.parametrize("least", [2, 30])
def test_marginals_lose_no_phrase(spark, least):
    rows = odd_rows(5)
    got = {(r.lang, tuple(r.words)): r.n for r in phrase_rollup.marginal_counts(spark.createDataFrame(rows, DOCS), least).collect()}
    plain = plain_counts(rows)
    want = {k: n for k, n in plain.items() if n >= least or (not k[1] and n)}
    assert {k: n for k, n in got.items() if n} == want


def test_saturated_sieve_changes_no_count(spark, monkeypatch):
    monkeypatch.setattr(phrase_rollup, "SIEVE_BITS", 64)
    rows = odd_rows(6)
    monkeypatch.setattr(phrase_rollup, "BLOCK_BYTES", 2_000)
    docs = spark.createDataFrame(rows, DOCS)
    assert len(phrase_rollup.run_sieve(docs.selectExpr("coalesce(lang, 'und') lang", "coalesce(text, '') text"), 2, 1)) <= 64
    got = {(r.lang, tuple(r.words)): r.n for r in phrase_rollup.marginal_counts(docs, 3).collect() if r.n}
    assert got == {k: n for k, n in plain_counts(rows).items() if n >= 3 or (not k[1] and n)}


def test_scores_beyond_64_bits(spark):
    big = 9 * 10 ** 18
    counts = spark.createDataFrame([("en", 1, ["a"], big), ("en", 1, ["b"], big), ("en", 2, ["a", "b"], big - 1), ("en", 0, [], big)],
                                   "lang string, size int, words array<string>, n long")
    (row,) = phrase_rollup.scored(counts).collect()
    assert (row.score, row.l, row.r) == (2_000_000 * (big - 1) // (2 * big), big, big)


def test_words_of_a_block():
    words = phrase_rollup.Words([b"", b"A b\tb.c", b"", b"c  \xc3\x89"], np.array([0, 1, 0, 2]))
    assert [words.list[i].as_py() for i in words.ids] == [b"a", b"b", b"b", b"c", b"c", b"\xc3\x89"]
    assert words.joined.tolist() == [True, True, False, False, True] and words.lang.tolist() == [1, 1, 1, 1, 2, 2]


def merkle(level):
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[k:k + 3]).encode()).hexdigest() for k in range(0, len(level), 3)]
    return level[0]


@given(st.integers(1, 120), st.data())
@settings(max_examples=60, deadline=None)
def test_versions_share_what_they_do_not_touch(n, data):
    leaves = [hashlib.sha256(str(k).encode()).hexdigest() for k in range(n)]
    tree = manifest_tree.PathTree(leaves, None)
    assert tree.digest[tree.root] == merkle(leaves)
    before = list(tree.digest)
    for at in data.draw(st.lists(st.integers(0, n - 1), max_size=5)):
        size = len(tree.kids)
        root = tree.version(at, "ff" * 32)
        assert tree.digest[root] == merkle([*leaves[:at], "ff" * 32, *leaves[at + 1:]])
        assert len(tree.kids) - size == len(tree.rows)
        reached, todo = set(), [root]
        while todo:
            node = todo.pop()
            reached.add(node)
            todo += tree.kids[node]
        # all but the copied path are nodes of the first version
        assert sum(k >= size for k in reached) == len(tree.rows)
        assert manifest_tree.climb(leaves[at], tree.siblings(at)) == merkle(leaves)
    assert tree.digest[:len(before)] == before


def test_many_blocks_and_levels(spark, monkeypatch):
    monkeypatch.setattr(manifest_tree, "HEIGHT", 1)
    rows = [(k, f"t{k}\n", "en", "s" if k % 3 else f"u{k % 7}", k) for k in range(140)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = {r.doc_id: r for r in manifest_tree.manifest(docs).collect()}
    monkeypatch.undo()
    want = {r.doc_id: r for r in manifest_tree.manifest(docs).collect()}
    for doc, r in want.items():
        assert got[doc].asDict() | {"copied": 0} == r.asDict() | {"copied": 0}
        assert r.verified == (r.copied == 0)


@given(st.sets(st.binary(max_size=6), max_size=400))
@settings(max_examples=40, deadline=None)
def test_hash_is_minimal_and_perfect(found):
    keys = np.frombuffer(b"".join(sorted(map(line_index._digest, found))), line_index.KEY)
    counts = np.arange(len(keys)) * 700
    shard = line_index.Shard.unpack(line_index.Shard.build(keys, counts).pack())
    assert sorted(shard.numbers(keys).tolist()) == list(range(len(keys)))
    assert shard.count(keys).tolist() == np.minimum(counts, line_index.MOST).tolist()
    other = np.frombuffer(b"".join(line_index._digest(b"other" + k) for k in found), line_index.KEY)
    assert not shard.count(other).any()


def test_index_is_small():
    keys = np.random.default_rng(1).integers(0, 2 ** 63, (50_000, 2)).astype("<u8").view(line_index.KEY).ravel()
    data = line_index.Shard.build(keys, np.ones(len(keys), int)).pack()
    assert len(data) < 7 * len(keys)


def test_index_serves_new_documents(spark):
    old = spark.createDataFrame([(k, f"Same line\nown {k}", "en", "s", 1) for k in range(12)], DOCS)
    marks = line_index.line_marks(line_index.in_blocks(old), 1)
    index = line_index.LineIndex.over(marks, 1, shard_lines=2)
    assert index.shards >= 7
    new = spark.createDataFrame([(50, " same LINE\t\nown 3\nnever seen", "en", "s", 1), (51, None, "en", "s", 1)], DOCS)
    got = {r.row.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_index.drop_common_lines(new, 10, index=index).collect()}
    assert got == {50: ("own 3\nnever seen", 3, 1), 51: ("", 1, 0)}
    with pytest.raises(ValueError):
        index.too_common(marks, 70_000)


def test_least_characters_count_code_points(spark):
    docs = spark.createDataFrame([(k, "éé\nééé\n", "en", "s", 1) for k in range(10)], DOCS)
    got = line_index.drop_common_lines(docs.withColumn("n_lines", F.lit("own")), 10, 3).collect()
    assert {(r.text, r.n_dropped, r.row.n_lines) for r in got} == {("éé\n", 1, "own")}


def test_texts_cross_arrow_types():
    assert list(line_index._texts(pa.chunked_array([["é", None, ""]]))) == ["é".encode(), b"", b""]
