"""Corpus pipeline: toxicity, near-dedup, decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes every
stage's rows as Parquet below the shared checkpoint folder and the next stage reads them, so
a lost executor never repeats an earlier stage.  All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerlake.llm import decontaminate, minhash_dedup, mixing, sharding, toxicity
from offerlake.llm.common import stored, table

SHARDS = 24


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), spark)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash_dedup.drop_near_duplicates(docs, spark)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), spark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; documents of small sources repeat, at most twice as often as
    those of the largest."""
    return mixing.mix_documents(docs, spark, mixing.Mixture(max_repeats=2.0))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed rows with their shard and slot; equal texts share a shard."""
    return sharding.add_shards(docs, spark, SHARDS)


STAGES = [("toxicity", toxicity_filter), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mix), ("sharding", shard)]

#: The learnt, hashed and iterated stages have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), spark, f"pipeline-{name}")
    return docs
