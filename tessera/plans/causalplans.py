"""Effect-estimate queries on orders as units.

Unit = order; treatment = urgent priority; covariates = the customer's balance,
segment and region; true per-unit effect tau = 50 + balance / 100 and outcome
y = total price / 1000 + t * tau, so estimates can be checked against truth.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import md5_bucket
from tessera.operators import causal as ca
from tessera.plans.common import round_doubles
from tessera.plans.registry import register
from tessera.sources.tables import table

STRATA = ["c_mktsegment", "region"]

UNITS_SQL = """units AS (
  SELECT o_orderkey AS id, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS t, c_acctbal, c_mktsegment,
         n_regionkey AS region, 50 + c_acctbal / 100 AS tau,
         o_totalprice / 1000 + CAST(o_orderpriority = '1-URGENT' AS INTEGER) * (50 + c_acctbal / 100) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
prop AS (SELECT u.*, s.e FROM units u JOIN (SELECT c_mktsegment, region, avg(CAST(t AS DOUBLE)) AS e FROM units GROUP BY 1, 2) s
         USING (c_mktsegment, region))"""


def units(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    t = (F.col("o_orderpriority") == "1-URGENT").cast("int")
    tau = 50 + F.col("c_acctbal") / 100
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.col("o_orderkey").alias("id"), t.alias("t"), "c_acctbal", "c_mktsegment",
                     F.col("n_regionkey").alias("region"), tau.alias("tau"),
                     (F.col("o_totalprice") / 1000 + t * tau).alias("y")))


def prop(spark, sf):
    return ca.propensity_strata(units(spark, sf), STRATA)


@register("K01_naive_ate", "WITH " + UNITS_SQL + """
SELECT round(avg(CASE WHEN t = 1 THEN y END) - avg(CASE WHEN t = 0 THEN y END), 6) AS naive_ate,
       CAST(sum(t) AS BIGINT) AS n_treated, CAST(sum(1 - t) AS BIGINT) AS n_control FROM units""")
def q_k01(spark, sf):
    return round_doubles(ca.naive_ate(units(spark, sf)))


@register("K02_propensity_strata", "WITH " + UNITS_SQL + " SELECT id, round(e, 6) AS e FROM prop")
def q_k02(spark, sf):
    return round_doubles(prop(spark, sf).select("id", "e"))


@register("K03_ipw_ate", "WITH " + UNITS_SQL + """,
c AS (SELECT t, y, least(greatest(e, 0.01), 0.99) AS ec FROM prop)
SELECT round(avg(t * y / ec) - avg((1 - t) * y / (1 - ec)), 6) AS ipw_ate,
       round(sum(t * y / ec) / sum(t / ec) - sum((1 - t) * y / (1 - ec)) / sum((1 - t) / (1 - ec)), 6) AS ipw_ate_normalised
FROM c""")
def q_k03(spark, sf):
    return round_doubles(ca.ipw_ate(prop(spark, sf)))


PSM_SQL = UNITS_SQL + """,
ctrl AS (SELECT e, min(id) AS cid FROM prop WHERE t = 0 GROUP BY e),
m AS (SELECT p.id, arg_min(c.cid, (abs(p.e - c.e), c.cid)) AS control_id, min(abs(p.e - c.e)) AS distance
      FROM prop p JOIN ctrl c ON abs(p.e - c.e) <= 0.05 WHERE p.t = 1 GROUP BY p.id)"""


@register("K04_psm_matches", "WITH " + PSM_SQL + " SELECT id, control_id, round(distance, 6) AS distance FROM m")
def q_k04m(spark, sf):
    return round_doubles(ca.psm_matches(prop(spark, sf), "id", caliper=0.05))


@register("K04_psm_att", "WITH " + PSM_SQL + """
SELECT count(*) AS n_matched, round(avg(a.y - b.y), 6) AS psm_att
FROM m JOIN prop a ON a.id = m.id JOIN prop b ON b.id = m.control_id""")
def q_k04(spark, sf):
    p = prop(spark, sf)
    return round_doubles(ca.psm_ate(p, ca.psm_matches(p, "id", caliper=0.05), "id"))


@register("K05_ite_forest_error", "WITH " + UNITS_SQL + """,
h AS (SELECT * FROM units WHERE CAST(('0x' || substring(md5(concat_ws('|', '42', id)), 1, 8))::BIGINT % 2 AS BIGINT) = 1)
SELECT count(*) AS n_scored, round(avg(tau), 6) AS mean_true_effect, TRUE AS mean_within_a_third FROM h""")
def q_k05(spark, sf):
    """Fitted on one half of the units (by md5), scored on the other; the mean estimate is held to the mean true effect."""
    u = units(spark, sf).withColumn("half", md5_bucket(42, 2, "id"))
    f = ca.ite_forest(u.filter("half = 0"), u.filter("half = 1"), ["c_acctbal", "region", "c_mktsegment"], num_trees=10)
    m = f.agg(F.count(F.lit(1)).alias("n_scored"), F.avg("tau").alias("mean_true_effect"), F.avg("ite").alias("e"))
    return round_doubles(m.select("n_scored", "mean_true_effect", (F.abs(F.col("e") - F.col("mean_true_effect")) < F.col("mean_true_effect") / 3).alias("mean_within_a_third")))


@register("K02_propensity_logistic", "WITH " + UNITS_SQL + """
SELECT count(*) AS n, round(avg(CAST(t AS DOUBLE)), 3) AS mean_propensity, round(avg(CASE WHEN t = 1 THEN c_acctbal ELSE 0 END) / 1000, 3) AS mean_weighted_balance FROM units""")
def q_k02l(spark, sf):
    """Logistic propensities on balance and region. At the maximum of the likelihood they add up to the treated units, and
    weighted by a covariate to that covariate over the treated units, which SQL can state."""
    p = ca.propensity_logistic(units(spark, sf).withColumn("c_acctbal", F.col("c_acctbal") / 1000), ["c_acctbal", "region"])
    return p.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("e"), 3).alias("mean_propensity"), F.round(F.avg(F.col("e") * F.col("c_acctbal")), 3).alias("mean_weighted_balance"))


@register("K06_effect_error_strata", "WITH " + UNITS_SQL + """,
s AS (SELECT c_mktsegment, region, avg(CASE WHEN t = 1 THEN y END) - avg(CASE WHEN t = 0 THEN y END) AS ite FROM units GROUP BY 1, 2),
j AS (SELECT u.tau, s.ite FROM units u JOIN s USING (c_mktsegment, region))
SELECT round(avg(ite) - avg(tau), 6) AS ate_error, round(sqrt(avg((ite - tau) * (ite - tau))), 6) AS rmse,
       round(corr(ite, tau), 6) AS correlation FROM j""")
def q_k06(spark, sf):
    return round_doubles(ca.effect_error(ca.ite_strata(units(spark, sf), STRATA), "ite", "tau"))


@register("K07_overlap", "WITH " + UNITS_SQL + """,
sup AS (SELECT max(lo) AS lo, min(hi) AS hi FROM (SELECT t, min(e) AS lo, max(e) AS hi FROM prop GROUP BY t)),
h AS (SELECT t AS arm, CAST(least(floor(e * 10), 9) AS BIGINT) AS bin, count(*) AS n FROM prop GROUP BY 1, 2),
o AS (SELECT t AS arm, avg(CASE WHEN e < lo OR e > hi THEN 1.0 ELSE 0.0 END) AS share_outside_support FROM prop, sup GROUP BY 1)
SELECT arm, bin, n, round(share_outside_support, 6) AS share_outside_support FROM h JOIN o USING (arm)""")
def q_k07(spark, sf):
    return round_doubles(ca.overlap(prop(spark, sf)))


@register("K08_covariate_balance", "WITH " + UNITS_SQL + """,
w AS (SELECT *, CASE WHEN t = 1 THEN 1 / least(greatest(e, 0.01), 0.99) ELSE 1 / (1 - least(greatest(e, 0.01), 0.99)) END AS w FROM prop),
a AS (SELECT 'c_acctbal' AS covariate, CAST(c_acctbal AS DOUBLE) AS x, t, w FROM w
      UNION ALL SELECT 'region', CAST(region AS DOUBLE), t, w FROM w),
s AS (SELECT covariate, avg(CASE WHEN t = 1 THEN x END) AS m1, avg(CASE WHEN t = 0 THEN x END) AS m0,
             var_samp(CASE WHEN t = 1 THEN x END) AS v1, var_samp(CASE WHEN t = 0 THEN x END) AS v0,
             sum(CASE WHEN t = 1 THEN w * x END) / sum(CASE WHEN t = 1 THEN w END) AS wm1,
             sum(CASE WHEN t = 0 THEN w * x END) / sum(CASE WHEN t = 0 THEN w END) AS wm0 FROM a GROUP BY 1)
SELECT covariate, round(CASE WHEN sqrt((v1 + v0) / 2) = 0 THEN 0 ELSE (m1 - m0) / sqrt((v1 + v0) / 2) END, 6) AS smd_before,
       round(CASE WHEN sqrt((v1 + v0) / 2) = 0 THEN 0 ELSE (wm1 - wm0) / sqrt((v1 + v0) / 2) END, 6) AS smd_after FROM s""")
def q_k08(spark, sf):
    return round_doubles(ca.balance(prop(spark, sf), ["c_acctbal", "region"]))
