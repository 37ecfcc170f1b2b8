"""Five operators in a row over ``documents``: what a training run would read.

Language identification drops texts without a language, near duplicates are reduced to
one document each, documents with benchmark items go, sources are mixed to their target
weights (documents may repeat) and the result is dealt to shards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import decontam, lang_id, mixing, sharding, simhash
from ledgermill.llm.common import documents, learnable, store


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    found = lang_id.identify_language(docs, learn=learnable("doc_id", 5, 0))
    return found.filter(F.col("lang_pred") != lang_id.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group: three-word shingles, at most three bits apart."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, shard after shard in shuffled order."""
    return mixing.in_shards(mixing.mix_sources(docs)).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    return sharding.shard_rows(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read back before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Networks, alignments and seeded hashes cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None
