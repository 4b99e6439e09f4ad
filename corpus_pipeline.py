"""The corpus pipeline: language ID, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``, which has the columns of ``documents``; what it
returns is written as Parquet and read again as the next stage's docs. All but the last return those columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import bigru, decontaminate, mixing, shards, simhash
from corpusloom.llm.common import free_names, shared_folder, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those of no language that was learned, go."""
    return bigru.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, a similarity of 0.8 or more."""
    return simhash.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The spans of benchmark windows are cut out of the texts."""
    return decontaminate.remove_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix takes it, with the part of it that is taken once more."""
    return mixing.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard, its bytes and the manifest version that hold them, under names that they don't have."""
    names = free_names(docs.columns, "shard", "shard_bytes", "manifest_version")
    return shards.compacted(docs, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", names=names)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
    ("sharding", sharding),
]

#: The recurrent network and the near-duplicate groups can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            folder = f"{shared_folder(spark)}/stage-{k}-{uuid.uuid4().hex}"
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
