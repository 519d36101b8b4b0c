"""Registered queries of the training-data operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomesh.llm import (chunk_dedup, digest_index, language_id, line_index, manifest_tree, mixing, pair_bpe,
                          phrase_rollup, plane_files, prefix_forest, simhash_trie, surrogates, toxic_segments)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_table(spark, folder, "documents"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return digest_index.deduplicate(_table(spark, folder, "documents"))


def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_plane_files(spark: SparkSession, folder: str) -> DataFrame:
    return plane_files.encode_documents(_table(spark, folder, "documents"), tokenizer(), end_id=2)


def op5_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    replaced, _ = surrogates.replace(_table(spark, folder, "documents").select("doc_id", "text"))
    return replaced


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_dedup.deduplicate(_table(spark, folder, "documents"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_trie.near_duplicates(_table(spark, folder, "documents"), shingle=3, distance=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op8_pair_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return pair_bpe.encode_decode(_table(spark, folder, "documents"), tokenizer())


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxic_segments.detect(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_forest.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_phrase_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_rollup.collocations(_table(spark, folder, "documents"), least=30, share=80, top=2000)


def op12_manifest_tree(spark: SparkSession, folder: str) -> DataFrame:
    return manifest_tree.manifest(_table(spark, folder, "documents")).drop("copied")


def op13_line_index(spark: SparkSession, folder: str) -> DataFrame:
    found = line_index.drop_common_lines(_table(spark, folder, "documents"), least_docs=10, least_chars=1)
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""

# The level that the weights rise to: of the sources in order of the level at which they reach three times
# their size, the first that does not reach it decides.
OP3_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS w
  FROM docs GROUP BY source),
ordered AS (
  SELECT *, CAST(sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY s / w, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS num,
         CAST(sum(w) OVER (ORDER BY s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS den,
         row_number() OVER (ORDER BY s / w, source NULLS LAST) AS k
  FROM sources),
level AS (SELECT num, den FROM ordered WHERE 3 * s * den >= w * num ORDER BY k LIMIT 1),
goals AS (
  SELECT source, s, CASE WHEN 3 * s * den < w * num THEN CAST(3 * s AS DOUBLE)
                         ELSE CAST(w * num AS DOUBLE) / CAST(den AS DOUBLE) END AS target,
         CASE WHEN s = 0 THEN 0 WHEN 3 * s * den < w * num THEN 3 ELSE (w * num) // (den * s) END AS passes
  FROM sources, level),
sums AS (
  SELECT d.doc_id, d.size, g.s AS source_size, g.target, g.passes,
         g.target - CAST(g.passes * g.s AS DOUBLE) AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS own
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (passes + CASE WHEN upto <= rest OR (upto - own <= rest AND 2 * (rest - (upto - own)) > own)
                                  THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sums
"""

OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\n-\r]') AS pieces
  FROM documents),
pieces AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\t]+') AS w FROM docs),
counts AS (
  SELECT lang, m, w[i:i + m - 1] AS words, CAST(count(*) AS HUGEINT) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, unnest(range(1, 5)) AS t(m))
  GROUP BY lang, m, words),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang),
cuts AS (
  SELECT c.lang, c.m, c.words, c.f AS a, c.k, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM counts WHERE m >= 2 AND f >= 30) c
       JOIN counts x ON x.lang = c.lang AND x.words = c.words[1:c.k]
       JOIN counts y ON y.lang = c.lang AND y.words = c.words[c.k + 1:c.m]),
candidates AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, words[i:i + s - 1] AS words, max(a) AS around
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM candidates, unnest(range(2, 4)) AS t(s) WHERE s < m)
  GROUP BY ALL),
left_ AS (
  SELECT c.*, array_to_string(c.words, ' ') AS phrase FROM candidates c LEFT JOIN inner_ i ON i.lang = c.lang AND i.words = c.words
  WHERE i.around IS NULL OR 100 * i.around < 80 * c.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

# CRC-32 bit by bit: only its lowest bit matters. Trees grow level by level; a proof is what stands beside the path.
OP12_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, * FROM documents),
fields AS (
  SELECT r, doc_id, source, doc_id IS NOT NULL AND (
           list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                                   list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
             lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
               lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) & 1 = 1) AS touched,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         text, replace(text, chr(10), '') AS flat
  FROM rows),
hashed AS (
  SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || CASE WHEN touched THEN coalesce(strlen(flat) || ':' || flat, '-')
                             ELSE coalesce(strlen(text) || ':' || text, '-') END) AS shown
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM hashed),
nodes AS (
  SELECT source, 0 AS lvl, pos, leaf AS digest, n FROM placed
  UNION ALL
  SELECT source, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY source, lvl, pos // 3, n),
subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
  FROM tops WHERE n > 1 GROUP BY lvl, pos // 3, n),
sides AS (
  SELECT p.r, m.lvl, coalesce(string_agg(m.digest, '' ORDER BY m.pos) FILTER (m.pos < p.pos // CAST(3 ** m.lvl AS BIGINT)), '') AS l,
         coalesce(string_agg(m.digest, '' ORDER BY m.pos) FILTER (m.pos > p.pos // CAST(3 ** m.lvl AS BIGINT)), '') AS g
  FROM placed p JOIN nodes m ON m.source IS NOT DISTINCT FROM p.source AND m.n > 1
       AND m.pos // 3 = p.pos // CAST(3 ** (m.lvl + 1) AS BIGINT)
  GROUP BY p.r, m.lvl
  UNION ALL
  SELECT p.r, 1000 + m.lvl, coalesce(string_agg(m.digest, '' ORDER BY m.pos) FILTER (m.pos < s.pos // CAST(3 ** m.lvl AS BIGINT)), ''),
         coalesce(string_agg(m.digest, '' ORDER BY m.pos) FILTER (m.pos > s.pos // CAST(3 ** m.lvl AS BIGINT)), '')
  FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
       JOIN tops m ON m.n > 1 AND m.pos // 3 = s.pos // CAST(3 ** (m.lvl + 1) AS BIGINT)
  GROUP BY p.r, m.lvl),
steps AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY lvl) AS step FROM sides),
folds AS (
  SELECT r, 0 AS step, shown AS digest FROM placed
  UNION ALL
  SELECT f.r, s.step, sha256(s.l || f.digest || s.g) FROM folds f JOIN steps s ON s.r = f.r AND s.step = f.step + 1),
proofs AS (SELECT r, max(step) AS last, sha256(string_agg(l || g, '' ORDER BY step)) AS proof FROM steps GROUP BY r)
SELECT p.doc_id, p.leaf, s.subroot, t.digest AS root, coalesce(q.proof, sha256('')) AS proof_sha256, f.digest AS folded_root,
       f.digest = t.digest AS verified
FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN tops t ON t.n = 1
     LEFT JOIN proofs q ON q.r = p.r JOIN folds f ON f.r = p.r AND f.step = coalesce(q.last, 0)
"""

OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM docs),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
kept AS (
  SELECT r, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n
  FROM keyed WHERE k NOT IN (SELECT k FROM common) GROUP BY r)
SELECT doc_id, len(lines) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept ON kept.r = docs.r
"""

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {f.__name__: f for f in (
    op1_language_id, op2_exact_dedup, op3_source_mixing, op4_plane_files, op5_surrogates, op6_substring_dedup,
    op7_simhash, op8_pair_bpe, op9_toxicity, op10_prefix_forest, op11_phrase_rollup, op12_manifest_tree, op13_line_index)}
ORACLE_SQL: dict[str, str] = {"op2_exact_dedup": OP2_SQL, "op3_source_mixing": OP3_SQL, "op11_phrase_rollup": OP11_SQL, "op12_manifest_tree": OP12_SQL,
                              "op13_line_index": OP13_SQL}
