"""Registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, divergence, langid, licences, mixing, neardup_vectors, outliers, pii, preference, quality, sharding, simhash, vector_codes
from tessera.llm.common import read

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.materialise(mixing.measured(read(spark, sf_dir, "documents")))
    return mixing.plan_mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = pii.pii_spans(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda x: x["kind"].isin(*pii.BASE))
    return s.select("doc_id", *[count(k) for k in pii.BASE], F.sha2(pii.span_text(base), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = simhash.simhash_components(read(spark, sf_dir, "documents"))
    return c.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.pair_summary(preference.preference_segments(preference.borrowed_rejections(read(spark, sf_dir, "conversations"))))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_records(read(spark, sf_dir, "documents"))


@query
def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"), licences.template_table(spark))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("text_hash")


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings")).drop("label")


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(read(spark, sf_dir, "documents")).drop("n_lines", "distance")
