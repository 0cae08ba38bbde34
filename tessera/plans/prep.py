"""Projection, joins, splits and feature-preparation queries (P*, J01-J03, L*, F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import r6
from tessera.operators import basic, features as fe, splits
from tessera.operators.profile import value_counts
from tessera.plans.profiling import STRAT_SQL, stratified_clicks
from tessera.plans.registry import register
from tessera.sources.tables import table


@register("P02_select_prefix_lineitem", """
SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem""")
def q_p02(spark, sf):
    return basic.select_prefix(table(spark, sf, "lineitem"), ["l_quantity", "l_extended"], keep=["l_orderkey"])


@register("P05_case_when_filter_clicks", "WITH " + STRAT_SQL.split(",\nstrat AS")[0] + """
SELECT row_id,
       CASE WHEN score >= 0.6 THEN 'high' WHEN score >= 0.3 THEN 'mid' ELSE 'low' END AS band,
       CAST(score >= 0.3 AS INTEGER) AS pred,
       round(l_extendedprice * (1 - l_discount), 6) AS revenue
FROM clicks WHERE l_quantity > 10 AND l_discount < 0.05""")
def q_p05(spark, sf):
    from tessera.plans.standins import click_rows
    d = click_rows(spark, sf).filter((F.col("l_quantity") > 10) & (F.col("l_discount") < 0.05))
    band = basic.case_when([(F.col("score") >= 0.6, "high"), (F.col("score") >= 0.3, "mid")], "low")
    d = basic.predict(d, 0.3).withColumns({"band": band, "revenue": r6(F.col("l_extendedprice") * (1 - F.col("l_discount")))})
    return d.select("row_id", "band", "pred", "revenue")


@register("P06_fill_missing_segment", """
SELECT c_custkey, coalesce(CAST(nullif(c_mktsegment, 'HOUSEHOLD') AS VARCHAR), 'MISSING') AS c_mktsegment,
       coalesce(CAST(nullif(c_nationkey, 3) AS VARCHAR), 'MISSING') AS c_nationkey FROM customer""")
def q_p06(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.expr("nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment"),
                                            F.expr("nullif(c_nationkey, 3) AS c_nationkey"))
    return basic.fill_missing(c, ["c_mktsegment", "c_nationkey"])


@register("P07_dropna_subset", """
SELECT c_custkey FROM customer WHERE nullif(c_mktsegment, 'HOUSEHOLD') IS NOT NULL AND nullif(c_nationkey, 3) IS NOT NULL""")
def q_p07(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.expr("nullif(c_mktsegment, 'HOUSEHOLD') AS seg"),
                                            F.expr("nullif(c_nationkey, 3) AS nat"))
    return basic.dropna_subset(c, ["seg", "nat"]).select("c_custkey")


@register("J01_lookup_nation_default", """
SELECT c_custkey, coalesce(n_name, 'UNKNOWN') AS n_name
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey""")
def q_j01(spark, sf):
    from tessera.operators.pairs import lookup
    nat = table(spark, sf, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), nat, "c_nationkey",
                  {"n_name": "UNKNOWN"}).select("c_custkey", "n_name")


@register("J02_semi_customers_with_urgent", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def q_j02(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return splits.semi_filter(table(spark, sf, "customer").select("c_custkey", "c_name"), o, "c_custkey")


@register("J03_anti_parts_never_ordered", """
SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)""")
def q_j03(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf, "part").select("p_partkey").join(li, "p_partkey", "left_anti")


@register("L02_stratified_split_clicks", "WITH " + STRAT_SQL + """
SELECT row_id, label, split FROM strat""")
def q_l02(spark, sf):
    return stratified_clicks(spark, sf, []).select("row_id", "label", "split")


@register("L03_head_100_orders", """
SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100""")
def q_l03(spark, sf):
    return splits.head_subset(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 100).select("o_orderkey")


SAMPLE_SQL = """sampled AS (
  SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders)
  ORDER BY md5(concat_ws('|', '7', o_custkey)) LIMIT 50)"""


def _sampled(spark, sf):
    return splits.sample_distinct(table(spark, sf, "orders"), "o_custkey", 50, seed=7)


@register("L04_sample_50_customers", "WITH " + SAMPLE_SQL + " SELECT o_custkey FROM sampled")
def q_l04(spark, sf):
    return _sampled(spark, sf)


@register("L05_orders_of_sampled_customers", "WITH " + SAMPLE_SQL + """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM sampled)""")
def q_l05(spark, sf):
    return splits.semi_filter(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), _sampled(spark, sf), "o_custkey")


NESTED_SQL = """
SELECT doc_id, rn AS sample_rank, CAST(rn <= 100 AS INTEGER) AS in_100, CAST(rn <= 250 AS INTEGER) AS in_250,
       CAST(rn <= 500 AS INTEGER) AS in_500
FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(concat_ws('|', '42', doc_id))) AS rn FROM documents)"""


@register("L06_nested_subsets_documents", NESTED_SQL)
def q_l06(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return splits.nested_subsets(d, "doc_id", [100, 250, 500])


GROUP_SPLIT_SQL = """
CASE WHEN b < 7000 THEN 'train' WHEN b < 8500 THEN 'validation' ELSE 'test' END"""


@register("L07_split_by_source", """
SELECT doc_id, source, CASE WHEN b < 7000 THEN 'train' WHEN b < 8500 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT doc_id, source, CAST(('0x' || substring(md5(concat_ws('|', '42', source)), 1, 8))::BIGINT % 10000 AS BIGINT) AS b
      FROM documents)""")
def q_l07(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    return splits.split_by_group(d, "source", {"train": 0.7, "validation": 0.15, "test": 0.15})


@register("L08_leakage_sources_row_split", """
SELECT source, array_to_string(list_sort(list(DISTINCT split)), ',') AS splits
FROM (SELECT source, CASE WHEN b < 7000 THEN 'train' WHEN b < 8500 THEN 'validation' ELSE 'test' END AS split
      FROM (SELECT source, CAST(('0x' || substring(md5(concat_ws('|', '42', doc_id)), 1, 8))::BIGINT % 10000 AS BIGINT) AS b
            FROM documents))
GROUP BY source HAVING count(DISTINCT split) > 1""")
def q_l08(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    s = splits.split_by_group(d, "doc_id", {"train": 0.7, "validation": 0.15, "test": 0.15})
    return splits.leakage_report(s, "source").select("source", F.array_join("splits", ",").alias("splits"))


@register("L10_poison_split_embeddings", """
SELECT vec_id, CASE WHEN p = 1 THEN 0 ELSE label END AS label, p AS poisoned
FROM (SELECT vec_id, label,
             CASE WHEN label <> 0 AND row_number() OVER (PARTITION BY label <> 0 ORDER BY md5(concat_ws('|', '42', vec_id))) <= 20
                  THEN 1 ELSE 0 END AS p
      FROM embeddings)""")
def q_l10(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    return splits.poison_split(e, "vec_id", "label", 0, 20)


@register("L11_scaling_grid_embeddings", """
SELECT vec_id, rn AS sample_rank, CAST(rn <= 50 AS INTEGER) AS in_50, CAST(rn <= 150 AS INTEGER) AS in_150
FROM (SELECT vec_id, row_number() OVER (ORDER BY md5(concat_ws('|', '42', vec_id))) AS rn
      FROM embeddings WHERE label <> 9)""")
def q_l11(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    ev = e.filter("label = 9").select("vec_id")
    return splits.scaling_grid(e.select("vec_id"), "vec_id", ev, [50, 150])


# ---- features: fit on the stratified train part, apply to every row ----

NULLED_SQL = STRAT_SQL + """,
nulled AS (SELECT row_id, split, nullif(l_quantity, 25) AS l_quantity, nullif(p_size, 10) AS p_size,
                  l_extendedprice, c_acctbal, c_mktsegment, nullif(p_brand, 'Brand#1') AS p_brand, o_orderpriority
           FROM strat)"""


NULLED = {"l_quantity": "25", "p_size": "10", "p_brand": "'Brand#1'"}


def _nulled(spark, sf, *cols):
    """Split rows with the columns a query asks for, some of whose values are null."""
    return stratified_clicks(spark, sf, list(cols)).select(
        "row_id", "split", *[F.expr(f"nullif({c}, {NULLED[c]}) AS {c}") if c in NULLED else F.col(c) for c in cols])


@register("F01_median_impute", "WITH " + NULLED_SQL + """,
med AS (SELECT quantile_cont(l_quantity, 0.5) AS mq, quantile_cont(p_size, 0.5) AS ms FROM nulled WHERE split = 'train')
SELECT row_id, round(coalesce(l_quantity, mq), 6) AS l_quantity, round(coalesce(CAST(p_size AS DOUBLE), ms), 6) AS p_size
FROM nulled, med""")
def q_f01(spark, sf):
    d = _nulled(spark, sf, "l_quantity", "p_size")
    m = fe.fit_median(d.filter("split = 'train'"), ["l_quantity", "p_size"])
    a = fe.apply_median(d, m, ["l_quantity", "p_size"])
    return a.select("row_id", r6("l_quantity").alias("l_quantity"), r6("p_size").alias("p_size"))


@register("F02_standardise", "WITH " + NULLED_SQL + """,
st AS (SELECT avg(l_extendedprice) AS m1, CASE WHEN stddev_pop(l_extendedprice) = 0 THEN 1 ELSE stddev_pop(l_extendedprice) END AS s1,
              avg(c_acctbal) AS m2, CASE WHEN stddev_pop(c_acctbal) = 0 THEN 1 ELSE stddev_pop(c_acctbal) END AS s2
       FROM nulled WHERE split = 'train')
SELECT row_id, round((l_extendedprice - m1) / s1, 6) AS l_extendedprice, round((c_acctbal - m2) / s2, 6) AS c_acctbal
FROM nulled, st""")
def q_f02(spark, sf):
    cols = ["l_extendedprice", "c_acctbal"]
    d = _nulled(spark, sf, *cols)
    s = fe.apply_standard(d, fe.fit_standard(d.filter("split = 'train'"), cols), cols)
    return s.select("row_id", *[r6(c).alias(c) for c in cols])


VOCAB_SQL = NULLED_SQL + """,
vocab AS (
  SELECT 'p_brand' AS "column", value, row_number() OVER (ORDER BY value) AS id
  FROM (SELECT DISTINCT coalesce(p_brand, 'MISSING') AS value FROM nulled WHERE split = 'train')
  UNION ALL
  SELECT 'c_mktsegment', value, row_number() OVER (ORDER BY value)
  FROM (SELECT DISTINCT coalesce(c_mktsegment, 'MISSING') AS value FROM nulled WHERE split = 'train'))"""


def _vocab(spark, sf, rows=None):
    d = (_nulled(spark, sf, "p_brand", "c_mktsegment") if rows is None else rows).filter("split = 'train'")
    return fe.fit_vocabs(d, ["p_brand", "c_mktsegment"])


@register("F03_fit_category_vocab", "WITH " + VOCAB_SQL + """
SELECT "column", value, CAST(id AS BIGINT) AS id FROM vocab""")
def q_f03(spark, sf):
    return _vocab(spark, sf).select("column", "value", "id")


@register("F04_encode_test_rows", "WITH " + VOCAB_SQL + """
SELECT row_id, CAST(coalesce(vb.id, 0) AS BIGINT) AS p_brand_id, CAST(coalesce(vs.id, 0) AS BIGINT) AS c_mktsegment_id
FROM nulled n
LEFT JOIN vocab vb ON vb."column" = 'p_brand' AND vb.value = coalesce(n.p_brand, 'MISSING')
LEFT JOIN vocab vs ON vs."column" = 'c_mktsegment' AND vs.value = coalesce(n.c_mktsegment, 'MISSING')
WHERE split = 'test'""")
def q_f04(spark, sf):
    rows = _nulled(spark, sf, "p_brand", "c_mktsegment")
    v, t = _vocab(spark, sf, rows), rows.filter("split = 'test'")
    t = fe.encode(fe.encode(t, v, "p_brand"), v, "c_mktsegment")
    return t.select("row_id", "p_brand_id", "c_mktsegment_id")


@register("F05_embedding_plan", "WITH " + VOCAB_SQL + """
SELECT "column", count(*) + 1 AS vocab_size, CAST(least(50, greatest(4, floor((count(*) + 1) / 2))) AS BIGINT) AS width
FROM vocab GROUP BY 1""")
def q_f05(spark, sf):
    return fe.embedding_plan(_vocab(spark, sf))


@register("F06_l2_normalise_long", """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim, round(CAST(embedding[i] AS DOUBLE) * 3 / nrm, 6) AS value
FROM (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: (CAST(x AS DOUBLE) * 3) * (CAST(x AS DOUBLE) * 3)))) AS nrm,
             generate_series(1, len(embedding)) AS ii FROM embeddings), unnest(ii) AS t(i)""")
def q_f06(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * 3).alias("v"))
    n = fe.l2_normalise(e, "v")
    return n.select("vec_id", F.posexplode("v").alias("dim", "value")).select("vec_id", "dim", r6("value").alias("value"))


@register("F08_pairwise_field_interactions", """
WITH f AS (SELECT vec_id, embedding[1:16] AS f0, embedding[17:32] AS f1, embedding[33:48] AS f2, embedding[49:64] AS f3
           FROM embeddings),
d AS (SELECT vec_id, [list_sum(list_transform(list_zip(f0, f1), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))),
                      list_sum(list_transform(list_zip(f0, f2), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))),
                      list_sum(list_transform(list_zip(f0, f3), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))),
                      list_sum(list_transform(list_zip(f1, f2), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))),
                      list_sum(list_transform(list_zip(f1, f3), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))),
                      list_sum(list_transform(list_zip(f2, f3), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))] AS xs
      FROM f)
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pair, round(xs[i], 6) AS value FROM d, range(1, 7) AS t(i)""")
def q_f08(spark, sf):
    e = table(spark, sf, "embeddings")
    f = e.select("vec_id", *[F.slice("embedding", 16 * i + 1, 16).alias(f"f{i}") for i in range(4)])
    x = fe.pairwise_interactions(f, ["f0", "f1", "f2", "f3"])
    return x.select("vec_id", F.posexplode("interactions").alias("pair", "value")).select("vec_id", "pair", r6("value").alias("value"))


@register("F10_cross_feature_vocab", "WITH " + NULLED_SQL + """
SELECT value, CAST(row_number() OVER (ORDER BY value) AS BIGINT) AS id
FROM (SELECT DISTINCT concat_ws('|', coalesce(c_mktsegment, 'MISSING'), coalesce(o_orderpriority, 'MISSING')) AS value
      FROM nulled WHERE split = 'train')""")
def q_f10(spark, sf):
    d = fe.cross_features(_nulled(spark, sf, "c_mktsegment", "o_orderpriority").filter("split = 'train'"), [("c_mktsegment", "o_orderpriority")])
    return fe.fit_vocab(d, "c_mktsegment_x_o_orderpriority").select("value", "id")


@register("F11_index_customer_keys", """
SELECT o_custkey, CAST(row_number() OVER (ORDER BY o_custkey) - 1 AS BIGINT) AS "index"
FROM (SELECT DISTINCT o_custkey FROM orders)""")
def q_f11(spark, sf):
    return fe.index_keys(table(spark, sf, "orders"), "o_custkey")


@register("F12_event_time_gaps", """
SELECT event_id, round(epoch_us(ts) / 1e6 - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6, 6) AS gap_seconds
FROM events""")
def q_f12(spark, sf):
    g = fe.time_gaps(table(spark, sf, "events"), "user_id", "ts", "event_id")
    return g.select("event_id", r6("gap_seconds").alias("gap_seconds"))


@register("S08_parse_json_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def q_s08(spark, sf):
    from tessera.sources.files import parse_json_col
    e = parse_json_col(table(spark, sf, "events"), "props", "k int", "p")
    return e.select("event_id", F.col("p.k").alias("k"))


@register("J08_first_order_per_customer", """
SELECT o_custkey, o_orderkey FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
WHERE r = 1""")
def q_j08(spark, sf):
    from tessera.operators.pairs import first_per_key
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return first_per_key(o, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@register("F09_assemble_features", "WITH " + NULLED_SQL + r""",
a AS (SELECT n.row_id, [CAST(n.l_extendedprice AS DOUBLE), CAST(n.c_acctbal AS DOUBLE)] || [CAST(coalesce(n.l_quantity, 0) AS DOUBLE)] AS f
      FROM nulled n)
SELECT row_id, CAST(len(f) AS INTEGER) AS n_features,
       array_to_string(list_transform(f, lambda x: CAST(round(x, 2) AS VARCHAR)), ',') AS features FROM a""")
def q_f09(spark, sf):
    d = _nulled(spark, sf, "l_extendedprice", "c_acctbal", "l_quantity").select("row_id", F.array(F.col("l_extendedprice").cast("double"), F.col("c_acctbal")).alias("pair"),
                                  F.coalesce(F.col("l_quantity"), F.lit(0.0)).alias("q"))
    a = fe.assemble(d, ["pair", "q"], "f")
    return a.select("row_id", F.size("f").alias("n_features"),
                    F.array_join(F.transform("f", lambda x: F.round(x, 2).cast("string")), ",").alias("features"))


@register("L09_shuffle_positions", """
SELECT doc_id, CAST(row_number() OVER (ORDER BY md5(concat_ws('|', '9', doc_id))) - 1 AS BIGINT) AS position FROM documents""")
def q_l09(spark, sf):
    from tessera.functions.exprs import md5_order
    from tessera.functions.skew import dense_index
    d = table(spark, sf, "documents").select("doc_id").withColumn("__o", md5_order(9, "doc_id"))
    return dense_index(d, ["__o"], "position").select("doc_id", "position")
