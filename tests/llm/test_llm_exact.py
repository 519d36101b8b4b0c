"""Exact deduplication, mixing, and the corpus pipeline's filters: hand cases and oracle SQL."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from velomesh.llm import digest_index, language_id, mixing
from velomesh.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)


def oracle(name, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, 'en', ?, 0)", [(i, t, s) for i, t, s in rows])
    return con.execute(ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_registered_query_matches_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = QUERIES[name](spark, SMALL)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


ODD = [(5, "a  b", "x"), (2, "a\tb", "x"), (9, "a\r\n b", None), (3, None, "y"), (7, "", None), (4, "long " * 30_000, "y"),
       (1, "unlike", "z"), (2, "a\tb", "x"), (8, "a b", "z"), (6, " a b", "z")]


def test_equal_texts_keep_the_smallest(spark):
    got = sorted(map(tuple, digest_index.deduplicate(docs_of(spark, ODD)).collect()))
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in ODD]
    for doc, keep, size, kept, sha in got:
        same = [i for (i, _, _), p in zip(ODD, plain) if hashlib.sha256(p.encode()).hexdigest() == sha]
        assert doc in same and keep == min(same) and size == len(same)
        assert kept <= (doc == keep)
    # of two equal rows one stays
    assert sum(k for *_, k, _ in got) == len({s for *_, s in got})
    assert len(got) == len(ODD)


def test_digest_index_outlives_and_repeats(spark, tmp_path):
    path = str(tmp_path / "index")
    first = docs_of(spark, [(10, "one", "x"), (11, "two", "x")])
    digest_index.deduplicate(first, digest_index.DigestIndex(spark, path, 4))
    again = digest_index.DigestIndex(spark, path, 4)
    assert again.rows().count() == 2
    second = docs_of(spark, [(1, "one", "x"), (2, "three", "x")])
    got = {r.doc_id: (r.keep_id, r.kept) for r in digest_index.deduplicate(second, again).collect()}
    assert got == {1: (10, False), 2: (2, True)}
    digest_index.deduplicate(second, again)
    assert again.rows().count() == 3
    plan = again.unseen(spark.table(again.name).select("digest"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan


def test_keep_first_has_own_columns_and_nulls(spark):
    docs = docs_of(spark, ODD).withColumns({"_digest": F.lit(1), "kept": F.lit("k"), "_doc": F.lit(2)})
    got = digest_index.keep_first(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 3, 4, 6, 8]
    assert digest_index.keep_first(docs_of(spark, [(None, "a", "x"), (3, "a", "x"), (None, "b", "x")])).count() == 2


def test_empty_tables(spark):
    none = docs_of(spark, [(1, "a", "x")]).where("false")
    assert digest_index.deduplicate(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0
    assert language_id.identify(none).count() == 0 and language_id.keep_known(none, 0.05).count() == 0


def mixed_rows(seed, n=400):
    rng = random.Random(seed)
    names = [None, "a", "b", "é", "Z", "zz", "\U00010400"]
    return [(i, " ".join("w" * rng.randint(0, 40)) or None, rng.choice(names[:rng.randint(2, 7)])) for i in range(n)]


@pytest.mark.parametrize("rows", [ODD, mixed_rows(1), mixed_rows(2), [(1, "", "a"), (2, None, None)], [(1, "a b c", None)],
                                  [(i, "w " * (1000 if i < 5 else 3), "big" if i < 300 else f"s{i}") for i in range(320)]])
def test_mix_matches_oracle(spark, rows):
    df = mixing.mix(docs_of(spark, rows)).select("doc_id", "size", "source_size", "target", "taken")
    cur = oracle("op3_source_mixing", rows)
    want = [tuple(r) for r in cur.fetchall()]
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_mix_keeps_its_promises(spark):
    rows = [(i, "w " * random.Random(i).randint(1, 60), f"s{i % 7 if i % 3 else 0}") for i in range(3000)]
    docs = docs_of(spark, rows)
    got = mixing.mix(docs).collect()
    total = sum(r["size"] for r in got)
    assert abs(sum({r.source: r.target for r in got}.values()) - total) < 1e-6 * total
    for source in {r.source for r in got}:
        part = [r for r in got if r.source == source]
        assert all(0 <= r.taken <= 3 * r["size"] for r in part)
        assert abs(sum(r.taken for r in part) - part[0].target) <= max(r["size"] for r in part)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    written = mixing.mixed(docs.withColumn("passes", F.lit("x")).withColumn("_doc", F.lit(0)))
    assert written.columns == [*docs.columns, "passes", "_doc"]
    assert written.count() == sum(r.copies for r in got)


def test_nested_budgets(spark):
    """A larger budget takes a superset."""
    rows = spark.range(500).selectExpr("id doc_id", "'a' source", "1 + id % 5 size")
    rows = rows.select("*", mixing.unit_hash().alias("hash"))
    taken = []
    for rest in (0.5, 100.0, 101.0, 700.0, 1499.0):
        goals = spark.createDataFrame([("a", rest)], "source string, rest double")
        (limit,) = mixing.thresholds(rows, goals).collect()
        taken.append({r.doc_id for r in rows.where(F.col("hash") < limit.threshold).collect()})
        assert abs(sum(1 + i % 5 for i in taken[-1]) - rest) <= 5
    assert all(a <= b for a, b in zip(taken, taken[1:]))
