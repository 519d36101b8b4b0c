"""The corpus pipeline: identify, deduplicate, mix, tokenise.

Each stage takes the documents its predecessor kept. Its result is written as Parquet and read back as the
next one's documents, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from velomesh.llm import digest_index, language_id, mixing, pair_bpe, simhash_trie
from velomesh.llm.common import stored
from velomesh.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents less like every learned language than this are rejected; unrelated vectors reach it by chance.
FLOOR = 0.05


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that could be learned; those without letters or like none of them go."""
    return language_id.keep_known(docs, FLOOR)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return digest_index.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: three-word shingles, two bits."""
    return simhash_trie.keep_one(docs, shingle=3, distance=2)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: each document as often as it is taken."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return pair_bpe.encode_decode(docs, tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language), ("exact_dedup", exact_dedup), ("simhash_near_dedup", near_dedup),
    ("source_mixing", source_mix), ("pair_bpe", tokens)]

#: Fingerprints, language prototypes and byte-pair merges are beyond SQL; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
