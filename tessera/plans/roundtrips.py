"""Sources and sinks over the given tables: written to the shared folder, read back, compared with the table itself."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions.exprs import md5_bucket, r6, word_tokens
from tessera.operators import basic, features, profile
from tessera.plans.registry import register
from tessera.session import checkpoint_dir
from tessera.sources import files
from tessera.sources.tables import table


def _folder(spark) -> str:
    """A new folder in the shared place that checkpoints go to."""
    return f"{checkpoint_dir(spark).rstrip('/')}/roundtrip-{uuid.uuid4().hex}"


@register("S01_csv_round_trip", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def q_s01(spark, sf):
    o, path = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), _folder(spark)
    o.write.option("header", True).csv(path)
    return files.read_csv(spark, path, o.schema)


@register("S02_json_documents", "SELECT CAST(item_id AS VARCHAR) AS doc_key, 'text' AS section, text FROM benchmark")
def q_s02(spark, sf):
    b, path = table(spark, sf, "benchmark"), _folder(spark)
    one = F.to_json(F.struct(F.col("item_id").cast("string").alias("id"), F.col("text")))
    b.select(one.alias("value")).write.text(path)
    return files.read_json_documents(spark, path, "id", lines=True)


@register("S03_read_splits", """
SELECT o_orderkey, CASE WHEN b < 7000 THEN 'train' WHEN b < 8500 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT o_orderkey, CAST(('0x' || substring(md5(concat_ws('|', '42', o_orderkey)), 1, 8))::BIGINT % 10000 AS BIGINT) AS b FROM orders)""")
def q_s03(spark, sf):
    o, path = table(spark, sf, "orders").select("o_orderkey"), _folder(spark)
    b = md5_bucket(42, 10000, "o_orderkey")
    parts = {"train": b < 7000, "validation": (b >= 7000) & (b < 8500), "test": b >= 8500}
    for name, rule in parts.items():
        files.write_dataset(o.filter(rule), f"{path}/{name}")
    return files.read_splits(spark, {name: f"{path}/{name}" for name in parts}).select("o_orderkey", "split")


@register("S04_file_inventory", """
SELECT 'o_orderstatus=' || o_orderstatus AS directory, CAST(1 AS BIGINT) AS n_files, CAST(1 AS BIGINT) AS n_named FROM orders GROUP BY o_orderstatus""")
def q_s04(spark, sf):
    o, path = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), _folder(spark)
    files.write_dataset(o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).coalesce(1), path, ["o_orderstatus"])
    inv = files.file_inventory(spark, path)
    return inv.select(F.regexp_extract("directory", "([^/]+)$", 1).alias("directory"), "n_files", F.size("first_names").cast("long").alias("n_named"))


@register("S05_write_dataset", """
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type""")
def q_s05(spark, sf):
    e, path = table(spark, sf, "events").select("event_type", "user_id"), _folder(spark)
    files.write_dataset(e, path, ["event_type"])
    d = spark.read.parquet(path)
    return d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("n_users"))


@register("S06_embeddings_csv", """
SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS dims, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total FROM embeddings""")
def q_s06(spark, sf):
    e, path = table(spark, sf, "embeddings"), _folder(spark)
    files.write_embeddings_csv(e, path)
    d = files.read_csv_quoted(spark, path, "vec_id long, embedding string, label int")
    v = F.from_json("embedding", "array<float>")
    total = F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double"))
    return d.select("vec_id", "label", F.size(v).cast("long").alias("dims"), r6(total).alias("total"))


@register("S07_report_with_average", r"""
WITH r AS (SELECT source, avg(len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))) AS words, avg(length(text)) AS chars FROM documents GROUP BY source)
SELECT source, round(words, 6) AS words, round(chars, 6) AS chars FROM r
UNION ALL SELECT 'AVERAGE', round(avg(words), 6), round(avg(chars), 6) FROM r""")
def q_s07(spark, sf):
    d, path = table(spark, sf, "documents"), _folder(spark)
    r = d.groupBy("source").agg(F.avg(F.size(word_tokens("text"))).alias("words"), F.avg(F.length("text")).alias("chars"))
    files.write_report(r, path, "source", ["words", "chars"])
    got = files.read_csv(spark, path, "source string, words double, chars double")
    return got.select("source", r6("words").alias("words"), r6("chars").alias("chars"))


@register("P03_split_features_target", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def q_p03(spark, sf):
    x, y = basic.split_xy(table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey"), "c_nationkey")
    assert y.columns == ["c_nationkey"]
    return x


@register("E17_length_report", r"""
SELECT 'text' AS "column", round(avg(CASE WHEN trim(text) = '' THEN 0 ELSE len(regexp_split_to_array(trim(text), '\s+')) END), 6) AS mean_words,
       CAST(max(CASE WHEN trim(text) = '' THEN 0 ELSE len(regexp_split_to_array(trim(text), '\s+')) END) AS BIGINT) AS max_words FROM conversations
UNION ALL
SELECT 'role', round(avg(CASE WHEN trim(role) = '' THEN 0 ELSE len(regexp_split_to_array(trim(role), '\s+')) END), 6),
       CAST(max(CASE WHEN trim(role) = '' THEN 0 ELSE len(regexp_split_to_array(trim(role), '\s+')) END) AS BIGINT) FROM conversations""")
def q_e17(spark, sf):
    r = profile.length_report(table(spark, sf, "conversations"), ["text", "role"])
    return r.select("column", r6("mean_words").alias("mean_words"), "max_words")


@register("F07_attach_vectors", """
SELECT p_partkey, CAST(coalesce(len(embedding), 0) AS BIGINT) AS dims, round(CAST(embedding[1] AS DOUBLE), 6) AS first
FROM part LEFT JOIN embeddings ON vec_id = p_partkey""")
def q_f07(spark, sf):
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("p_partkey"), "embedding")
    j = features.attach_vectors(table(spark, sf, "part").select("p_partkey"), v, "p_partkey")
    return j.select("p_partkey", F.coalesce(F.size("embedding"), F.lit(0)).cast("long").alias("dims"), r6(F.get("embedding", F.lit(0)).cast("double")).alias("first"))
