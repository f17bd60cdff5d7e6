"""Corpus pipeline: documents in, decided and sharded training rows out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored and read
again as the next stage's docs. All stages but the last return the columns of documents.
No stage but the last changes a row; they drop rows or, when mixing, repeat them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verdigris.llm import decontaminate, language_id, mixing, sharding, simhash
from verdigris.llm.common import fold, table
from verdigris.session import materialize

LEAST_SCORE = 0.5
# Nearly equal texts only; the README gives the recall by similarity.
SHINGLE, RADIUS = 3, 3
SHARDS = 8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without letters or with an unclear language go."""
    model = language_id.fit(docs.filter(fold("doc_id", 3) != 1), by_prior=True)
    return language_id.keep_confident(docs, model, LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id."""
    return simhash.keep_one(docs, shingle=SHINGLE, radius=RADIUS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark passages."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights; documents are left out or repeated."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, with the shard and slot of each row."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The stages train a model, follow links and hash rows in ways DuckDB has no functions for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
