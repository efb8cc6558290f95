"""The corpus pipeline: five stages over ``documents``, each calling one operator of ``cairn.llm``.

Each stage takes what the one before it kept. All but the last return the columns of documents;
the last adds the shard of each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairn.llm import decontamination, mixing, sharding, simhash, toxicity
from cairn.llm.tables import read, written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    slim = mixing.sizes(docs)
    return mixing.mixed(docs, mixing.plan_mix(slim, mixing.ranked_weights(slim, (5, 2, 1))))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [("toxicity", reject_toxic), ("simhash_near_dedup", drop_near_duplicates),
          ("benchmark_decontamination", decontaminate), ("source_mixing", mix_sources), ("sharding", shard)]

# Models and fingerprints have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
