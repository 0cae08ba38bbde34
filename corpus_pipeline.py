"""Corpus pipeline: quality, SimHash near-dedup, benchmark decontamination, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, mixing, quality, sharding, simhash
from tessera.llm.common import materialise, read


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier (operator 10) keeps."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (operator 5)."""
    return simhash.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark (operator 2)."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or thinned to the target weights of their sources (operator 3)."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard the K-d tree (operator 8) gives them."""
    return sharding.assign_shards(docs)


STAGES = [("quality", good_quality), ("simhash", one_of_each), ("decontamination", uncontaminated), ("mixing", mixed), ("sharding", sharded)]

#: The fitted classifier and the 64-bit shingle hashes have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
