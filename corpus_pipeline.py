"""A corpus pipeline over ``documents``: each stage works on what the one before it kept.

Stages: documents that score as toxic go; one document of each near-duplicate group stays; documents with a
benchmark item go; sources are mixed to their weights, as whole copies; copies are dealt into shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import decontaminate, mixing, sharding, simhash, toxicity
from panelcast.llm.common import stored

SHARDS = 24


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; all if there is no toxic label to learn from."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints (four-word shingles) that link at 4 or fewer bits: the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=4, radius=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, verbatim or with other names, numbers or units."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat_by_copies(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each copy."""
    return sharding.assign_shards(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Fitted models and connected components are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
