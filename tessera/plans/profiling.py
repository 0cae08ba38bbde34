"""Profiling queries (E01-E20, E22) over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import r6, r6_robust
from tessera.operators import profile as pr
from tessera.operators import splits
from tessera.plans.registry import register
from tessera.plans.standins import CLICK_SQL, LISTINGS_SQL, RATINGS_SQL, click_rows, listings, ratings
from tessera.sources.tables import table

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@register("E01_shape_lineitem", """
SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem""")
def q_e01(spark, sf):
    return pr.shape(table(spark, sf, "lineitem"))


@register("E02_schema_orders", """
UNPIVOT (SELECT count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey,
                count(nullif(o_orderstatus, 'P')) AS o_orderstatus, count(o_totalprice) AS o_totalprice,
                count(o_orderpriority) AS o_orderpriority FROM orders)
ON o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority INTO NAME "column" VALUE non_null""")
def q_e02(spark, sf):
    o = table(spark, sf, "orders").select(*ORDER_COLS).withColumn(
        "o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
    return pr.schema_report(o).select("column", "non_null")


@register("E03_null_counts_orders", """
UNPIVOT (SELECT CAST(sum(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS o_orderkey,
                CAST(sum(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS o_custkey,
                CAST(sum(CASE WHEN nullif(o_orderstatus, 'P') IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS o_orderstatus,
                CAST(sum(CASE WHEN nullif(o_totalprice, 'NaN'::DOUBLE) IS NULL OR isnan(o_totalprice) THEN 1 ELSE 0 END) AS BIGINT) AS o_totalprice,
                CAST(sum(CASE WHEN nullif(o_orderpriority, '5-LOW') IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS o_orderpriority
         FROM orders)
ON o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority INTO NAME "column" VALUE n_null""")
def q_e03(spark, sf):
    o = (table(spark, sf, "orders").select(*ORDER_COLS)
         .withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
         .withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, '5-LOW')")))
    return pr.null_counts(o)


@register("E04_distinct_counts_lineitem", """
UNPIVOT (SELECT count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_partkey) AS l_partkey,
                count(DISTINCT l_suppkey) AS l_suppkey, count(DISTINCT l_returnflag) AS l_returnflag
         FROM lineitem)
ON l_orderkey, l_partkey, l_suppkey, l_returnflag INTO NAME "column" VALUE n_distinct""")
def q_e04(spark, sf):
    return pr.distinct_counts(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"])


@register("E05_value_counts_event_type", """
SELECT event_type, count(*) AS count FROM events GROUP BY event_type""")
def q_e05(spark, sf):
    return pr.value_counts(table(spark, sf, "events"), "event_type")


@register("E06_describe_lineitem", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, floor(round(avg({c}), 9) * 1000000 + 0.5) / 1000000 AS mean,
       floor(round(stddev_samp({c}), 9) * 1000000 + 0.5) / 1000000 AS std,
       round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount")))
def q_e06(spark, sf):
    d = pr.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    # mean / std are float sums of short decimals: round them tie-safely
    return d.select("column", "count", r6_robust("mean").alias("mean"), r6_robust("std").alias("std"),
                    *[r6(c).alias(c) for c in ("min", "p25", "p50", "p75", "max")])


@register("E07_histogram_quantity", """
SELECT CAST(floor(l_quantity) AS BIGINT) AS bin, count(*) AS count FROM lineitem GROUP BY 1""")
def q_e07a(spark, sf):
    return pr.histogram(table(spark, sf, "lineitem"), "l_quantity")


@register("E07_histogram_price_10bins", """
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((l_extendedprice - lo) / ((hi - lo) / 10)), 9) END AS BIGINT) AS bin,
       count(*) AS count, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
FROM lineitem, mm WHERE l_extendedprice IS NOT NULL GROUP BY 1""")
def q_e07b(spark, sf):
    return pr.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 10)


@register("E08_group_size_distribution", "WITH " + LISTINGS_SQL + """
SELECT size, count(*) AS n_groups FROM (SELECT label_group, count(*) AS size FROM listings GROUP BY 1) GROUP BY size""")
def q_e08(spark, sf):
    return pr.group_size_distribution(listings(spark, sf), "label_group")


@register("E09_group_size_buckets", "WITH " + LISTINGS_SQL + """
SELECT CAST(sum(CASE WHEN size = 1 THEN 1 ELSE 0 END) AS BIGINT) AS size_1,
       CAST(sum(CASE WHEN size = 2 THEN 1 ELSE 0 END) AS BIGINT) AS size_2,
       CAST(sum(CASE WHEN size = 3 THEN 1 ELSE 0 END) AS BIGINT) AS size_3,
       CAST(sum(CASE WHEN size = 4 THEN 1 ELSE 0 END) AS BIGINT) AS size_4,
       CAST(sum(CASE WHEN size >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS size_5plus
FROM (SELECT label_group, count(*) AS size FROM listings GROUP BY 1)""")
def q_e09(spark, sf):
    return pr.group_size_buckets(listings(spark, sf), "label_group")


@register("E10_duplicate_document_texts", """
SELECT count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT text FROM documents)) AS n_duplicates
FROM documents""")
def q_e10(spark, sf):
    return pr.duplicate_count(table(spark, sf, "documents"), ["text"])


@register("E11_top5_brands", """
SELECT p_brand, count(*) AS count FROM part GROUP BY p_brand ORDER BY count DESC, p_brand LIMIT 5""")
def q_e11(spark, sf):
    return pr.top_values(table(spark, sf, "part"), "p_brand", 5)


@register("E12_hash_group_consistency", "WITH " + LISTINGS_SQL + """
SELECT count(*) AS n_image_phash, CAST(sum(CASE WHEN nb > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_inconsistent,
       max(nb) AS max_distinct
FROM (SELECT image_phash, count(DISTINCT label_group) AS nb FROM listings GROUP BY 1)""")
def q_e12(spark, sf):
    return pr.key_consistency(listings(spark, sf), "image_phash", "label_group")


@register("E13_type_variation_in_groups", "WITH " + LISTINGS_SQL + """
SELECT CAST(sum(CASE WHEN nd = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_uniform,
       CAST(sum(CASE WHEN nd > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_varied, max(nd) AS max_distinct
FROM (SELECT label_group, count(DISTINCT p_type) AS nd FROM listings GROUP BY 1)""")
def q_e13(spark, sf):
    return pr.group_variation(listings(spark, sf), "label_group", "p_type")


@register("E14_example_groups", "WITH " + LISTINGS_SQL + """,
top AS (SELECT label_group, count(*) AS size FROM listings GROUP BY 1 HAVING count(*) >= 2
        ORDER BY size DESC, label_group LIMIT 3)
SELECT l.label_group, l.posting_id, l.title, t.size FROM listings l JOIN top t USING (label_group)""")
def q_e14(spark, sf):
    return pr.example_groups(listings(spark, sf), "label_group", 2, 3).select("label_group", "posting_id", "title", "size")


@register("E15_groups_with_3plus", "WITH " + LISTINGS_SQL + """
SELECT posting_id, label_group FROM listings
WHERE label_group IN (SELECT label_group FROM listings GROUP BY 1 HAVING count(*) >= 3)""")
def q_e15(spark, sf):
    return pr.filter_groups(listings(spark, sf), "label_group", 3).select("posting_id", "label_group")


@register("E16_document_lengths", """
SELECT doc_id,
       CAST(CASE WHEN trim(text) = '' THEN 0 ELSE len(regexp_split_to_array(trim(text), '\\s+')) END AS BIGINT) AS text_words,
       CAST(length(text) AS BIGINT) AS text_chars
FROM documents""")
def q_e16(spark, sf):
    return pr.text_lengths(table(spark, sf, "documents"), "text").select("doc_id", "text_words", "text_chars")


@register("E18_rating_sparsity", "WITH " + RATINGS_SQL + """
SELECT count(*) AS observed, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       count(DISTINCT user_id) * count(DISTINCT item_id) AS possible,
       round(count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 6) AS share_observed,
       round(1 - count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 6) AS share_unobserved
FROM ratings""")
def q_e18(spark, sf):
    s = pr.sparsity(ratings(spark, sf), "user_id", "item_id")
    return s.select("observed", "n_users", "n_items", "possible", r6("share_observed").alias("share_observed"),
                    r6("share_unobserved").alias("share_unobserved"))


STRAT_SQL = CLICK_SQL + """,
strat AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', row_id)))
                      <= (count(*) OVER (PARTITION BY label) * 2000 + 9999) // 10000
            THEN 'test' ELSE 'train' END AS split
  FROM clicks)"""


def stratified_clicks(spark, sf, cols=None):
    """Stratified split of the click rows, which are written once: fits read the train part, applies every row.

    ``cols`` names the columns a query reads beside row_id and label; nothing
    else is written (pruning cannot cross a checkpoint).
    """
    from tessera.session import store
    rows = click_rows(spark, sf)
    if cols is not None:
        rows = rows.select("row_id", "label", *cols)
    return splits.split_stratified(store(rows)[0], "label", ["row_id"], 0.2, 42)


@register("E19_class_balance_by_split", "WITH " + STRAT_SQL + """
SELECT split, label, n, round(n / sum(n) OVER (PARTITION BY split), 6) AS share
FROM (SELECT split, label, count(*) AS n FROM strat GROUP BY 1, 2)""")
def q_e19(spark, sf):
    b = pr.class_balance(stratified_clicks(spark, sf, []), "label", "split")
    return b.select("split", "label", "n", r6("share").alias("share"))


@register("E20_interaction_stats", "WITH " + RATINGS_SQL + """,
sizes AS (SELECT 'user' AS entity, count(*) AS size FROM ratings GROUP BY user_id
          UNION ALL SELECT 'item', count(*) FROM ratings GROUP BY item_id)
SELECT entity, count(*) AS n, round(avg(size), 6) AS mean, min(size) AS min,
       round(quantile_cont(size, 0.25), 6) AS p25, round(quantile_cont(size, 0.5), 6) AS p50,
       round(quantile_cont(size, 0.75), 6) AS p75, max(size) AS max
FROM sizes GROUP BY entity""")
def q_e20(spark, sf):
    s = pr.interaction_stats(ratings(spark, sf), "user_id", "item_id")
    return s.select("entity", "n", r6("mean").alias("mean"), "min", r6("p25").alias("p25"), r6("p50").alias("p50"),
                    r6("p75").alias("p75"), "max")


@register("E22_document_noise_flags", """
SELECT doc_id, text IS NULL AS is_null, trim(text) = '' AS is_blank, length(trim(text)) < 5 AS is_short,
       count(*) OVER (PARTITION BY text) > 1 AS is_repeated
FROM documents""")
def q_e22(spark, sf):
    return pr.noise_flags(table(spark, sf, "documents"), "doc_id", "text", "text")
