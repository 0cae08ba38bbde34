"""Evaluation and fusion queries over click-like score rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import md5_order, r6, r6_ieee
from tessera.operators import evaluate as ev
from tessera.operators import scoring as sc
from tessera.operators.basic import predict
from tessera.operators.recommend import pick_best
from tessera.plans.common import round_doubles
from tessera.plans.profiling import STRAT_SQL, stratified_clicks
from tessera.plans.registry import register
from tessera.plans.standins import CLICK_SQL, click_rows

T = 0.3
GRID = list(range(5, 96))

RATES_SQL = """round(CASE WHEN tp + tn + fp + fn = 0 THEN 0 ELSE (tp + tn) / (tp + tn + fp + fn) END, 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1"""

CONF_SQL = """CAST(sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
       CAST(sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp"""

PRED_SQL = CLICK_SQL + """,
preds AS (SELECT *, CAST(score >= 0.3 AS INTEGER) AS pred, CAST(score2 >= 0.3 AS INTEGER) AS pred_b FROM clicks)"""


def _preds(spark, sf):
    d = predict(click_rows(spark, sf), T)
    return predict(d, T, "score2", "pred_b")


@register("V02_confusion_matrix", "WITH " + PRED_SQL + " SELECT " + CONF_SQL + " FROM preds")
def q_v02(spark, sf):
    return ev.confusion(_preds(spark, sf))


@register("V03_classification_report", "WITH " + PRED_SQL + ", c AS (SELECT " + CONF_SQL + " FROM preds) SELECT tn, fp, fn, tp, " + RATES_SQL + " FROM c")
def q_v03(spark, sf):
    return round_doubles(ev.classification_report(_preds(spark, sf)))


SWEEP_SQL = CLICK_SQL + """,
sweep AS (
  SELECT t.g, t.g / 100.0 AS threshold,
         CAST(sum(CASE WHEN score >= t.g / 100.0 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN score >= t.g / 100.0 AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN score < t.g / 100.0 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN score < t.g / 100.0 AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM clicks, range(5, 96) AS t(g) GROUP BY t.g),
rated AS (
  SELECT g, threshold, tp, fp, fn, tn,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_raw, """ + RATES_SQL + """
  FROM sweep)"""


def _sweep(spark, sf):
    return ev.threshold_sweep(click_rows(spark, sf), GRID)


@register("V04_threshold_sweep", "WITH " + SWEEP_SQL + """
SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn, accuracy, precision, recall, f1 FROM rated""")
def q_v04(spark, sf):
    return round_doubles(_sweep(spark, sf).drop("g"))


@register("V05_best_threshold", "WITH " + SWEEP_SQL + """
SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn, accuracy, precision, recall, f1
FROM rated ORDER BY f1_raw DESC, threshold LIMIT 1""")
def q_v05(spark, sf):
    return round_doubles(ev.best_threshold(_sweep(spark, sf)).drop("g"))


@register("C10_pick_best_patience3", "WITH " + SWEEP_SQL + """,
h AS (SELECT g AS epoch, f1_raw AS value FROM rated),
p AS (SELECT epoch, value, max(value) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best FROM h),
l AS (SELECT epoch, max(CASE WHEN prev_best IS NULL OR value > prev_best THEN epoch END)
                  OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_imp FROM p),
s AS (SELECT min(epoch) AS stop_epoch FROM l WHERE epoch - last_imp >= 3),
b AS (SELECT epoch, value FROM h, s WHERE s.stop_epoch IS NULL OR epoch <= s.stop_epoch ORDER BY value DESC, epoch LIMIT 1)
SELECT CAST(b.epoch AS BIGINT) AS best_epoch, round(b.value, 6) AS best_value, CAST(s.stop_epoch AS BIGINT) AS stop_epoch FROM b, s""")
def q_c10(spark, sf):
    h = _sweep(spark, sf).select(F.col("g").alias("epoch"), F.col("f1").alias("value"))
    b = pick_best(h, "value", "max", 3)
    return b.select(F.col("best_epoch").cast("long"), r6("best_value").alias("best_value"),
                    F.col("stop_epoch").cast("long"))


@register("V06_roc_auc", "WITH " + CLICK_SQL + """,
g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM clicks GROUP BY score),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS negb FROM g)
SELECT round((sum(pos * negb) + 0.5 * sum(pos * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM c""", headline=True)
def q_v06(spark, sf):
    return round_doubles(ev.roc_auc(click_rows(spark, sf)))


@register("V07_average_precision", "WITH " + CLICK_SQL + """,
g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM clicks GROUP BY score),
c AS (SELECT pos, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp, sum(pos) OVER () AS p FROM g)
SELECT round(sum(pos / p * (tp / (tp + fp))), 6) AS average_precision FROM c""")
def q_v07(spark, sf):
    return round_doubles(ev.average_precision(click_rows(spark, sf)))


@register("V08_log_loss", "WITH " + CLICK_SQL + """
SELECT round(avg(-(label * ln(least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
                 + (1 - label) * ln(1 - least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16)))), 6) AS log_loss
FROM clicks""")
def q_v08(spark, sf):
    return round_doubles(ev.log_loss(click_rows(spark, sf)))


@register("V09_brier", "WITH " + CLICK_SQL + """
SELECT round(avg((score - label) * (score - label)), 6) AS brier FROM clicks""")
def q_v09(spark, sf):
    return round_doubles(ev.brier(click_rows(spark, sf)))


@register("V10_calibration_uniform", "WITH " + CLICK_SQL + """
SELECT CAST(greatest(ceil(score * 10) - 1, 0) AS BIGINT) AS bin, count(*) AS n,
       round(avg(score), 6) AS mean_predicted, round(avg(CAST(label AS DOUBLE)), 6) AS fraction_positive
FROM clicks GROUP BY 1""")
def q_v10(spark, sf):
    return round_doubles(ev.calibration_uniform(click_rows(spark, sf), 10))


@register("V11_calibration_quantile", "WITH " + CLICK_SQL + """,
e AS (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM clicks)
SELECT CAST(len(list_filter(edges, lambda x: x < score)) AS BIGINT) AS bin, count(*) AS n,
       round(avg(score), 6) AS mean_predicted, round(avg(CAST(label AS DOUBLE)), 6) AS fraction_positive
FROM clicks, e GROUP BY 1""")
def q_v11(spark, sf):
    return round_doubles(ev.calibration_quantile(click_rows(spark, sf), 10))


@register("V18_error_type_counts", "WITH " + PRED_SQL + """
SELECT CASE WHEN label = pred THEN 'Correct' WHEN pred = 1 THEN 'False Positive' ELSE 'False Negative' END AS error_type,
       count(*) AS count FROM preds GROUP BY 1""")
def q_v18(spark, sf):
    return ev.error_types(_preds(spark, sf)).groupBy("error_type").agg(F.count(F.lit(1)).alias("count"))


@register("V19_worst_errors", "WITH " + PRED_SQL + """
(SELECT row_id, round(score, 6) AS score, 'False Positive' AS error_type FROM preds WHERE pred = 1 AND label = 0
 ORDER BY score DESC, row_id LIMIT 5)
UNION ALL
(SELECT row_id, round(score, 6), 'False Negative' FROM preds WHERE pred = 0 AND label = 1 ORDER BY score, row_id LIMIT 5)""")
def q_v19(spark, sf):
    w = ev.worst_errors(_preds(spark, sf), 5, "row_id")
    return w.select("row_id", r6("score").alias("score"), "error_type")


@register("V20_model_disagreement", "WITH " + PRED_SQL + """
SELECT CASE WHEN pred <> label AND pred_b = label THEN 'rescued' WHEN pred = label AND pred_b <> label THEN 'hurt'
            WHEN pred = label THEN 'both right' ELSE 'both wrong' END AS change, count(*) AS count
FROM preds GROUP BY 1""")
def q_v20(spark, sf):
    d = ev.model_disagreement(_preds(spark, sf), "label", "pred", "pred_b")
    return d.groupBy("change").agg(F.count(F.lit(1)).alias("count"))


@register("V21_compare_outputs_sample", "WITH " + PRED_SQL + """
SELECT row_id, label, pred, pred_b FROM preds ORDER BY md5(concat_ws('|', '5', row_id)) LIMIT 20""")
def q_v21(spark, sf):
    d = _preds(spark, sf).select("row_id", "label", "pred", "pred_b")
    return d.orderBy(md5_order(5, "row_id")).limit(20)


@register("V22_split_gap", "WITH " + STRAT_SQL + """,
p AS (SELECT split, label, CAST(score >= 0.3 AS INTEGER) AS pred FROM strat),
c AS (SELECT split, """ + CONF_SQL + """ FROM p GROUP BY split),
r AS (SELECT split, CASE WHEN tp + tn + fp + fn = 0 THEN 0 ELSE (tp + tn) / (tp + tn + fp + fn) END AS accuracy,
             CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM c)
SELECT round(a.accuracy, 6) AS accuracy_train, round(a.f1, 6) AS f1_train, round(b.accuracy, 6) AS accuracy_test,
       round(b.f1, 6) AS f1_test, round(a.accuracy - b.accuracy, 6) AS accuracy_gap, round(a.f1 - b.f1, 6) AS f1_gap
FROM r a, r b WHERE a.split = 'train' AND b.split = 'test'""")
def q_v22(spark, sf):
    d = predict(stratified_clicks(spark, sf, ["score"]), T)
    m = ev.classification_report(d, by=["split"])
    return round_doubles(ev.split_gap(m, "split", "train", "test", ["accuracy", "f1"]).drop())


@register("V23_sliced_report_by_segment", "WITH " + PRED_SQL + """,
c AS (SELECT c_mktsegment, """ + CONF_SQL + """ FROM preds GROUP BY c_mktsegment)
SELECT c_mktsegment, tn, fp, fn, tp, """ + RATES_SQL + " FROM c")
def q_v23(spark, sf):
    return round_doubles(ev.classification_report(_preds(spark, sf), by=["c_mktsegment"]))


@register("V24_agreement_auto_manual", """
WITH j AS (SELECT CAST(n_chars > 2000 AS INTEGER) AS auto, quality AS manual FROM documents JOIN labels USING (doc_id)),
o AS (SELECT count(*) AS n, avg(CAST(auto = manual AS DOUBLE)) AS observed FROM j),
e AS (SELECT sum(na * nb) AS ab FROM (SELECT auto AS v, count(*) AS na FROM j GROUP BY 1)
      JOIN (SELECT manual AS v, count(*) AS nb FROM j GROUP BY 1) USING (v))
SELECT n, round(observed, 6) AS observed, round(ab / (n * n), 6) AS expected,
       round(CASE WHEN ab / (n * n) = 1 THEN 1 ELSE (observed - ab / (n * n)) / (1 - ab / (n * n)) END, 6) AS kappa
FROM o, e""")
def q_v24(spark, sf):
    from tessera.sources.tables import table
    j = (table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
         .select((F.col("n_chars") > 2000).cast("int").alias("auto"), F.col("quality").alias("manual")))
    return round_doubles(ev.agreement(j, "auto", "manual"))


@register("M02_fuse_scores", "WITH " + CLICK_SQL + """
SELECT row_id, floor((0.75 * score + 0.25 * score2) * 1000000 + 0.5) / 1000000 AS fused FROM clicks""")
def q_m02(spark, sf):
    return sc.fuse(click_rows(spark, sf), "score", "score2", 0.75).select("row_id", r6_ieee("fused").alias("fused"))


@register("M03_fuse_many", "WITH " + CLICK_SQL + """
SELECT row_id, floor((0.5 * score + 0.3 * score2 + 0.2 * l_discount) * 1000000 + 0.5) / 1000000 AS fused FROM clicks""")
def q_m03(spark, sf):
    d = sc.fuse_many(click_rows(spark, sf), {"score": 0.5, "score2": 0.3, "l_discount": 0.2})
    return d.select("row_id", r6_ieee("fused").alias("fused"))


@register("M04_fusion_grid_best", "WITH " + CLICK_SQL + """,
f AS (SELECT label, w.k / 4 AS weight, (w.k / 4) * score + (1 - w.k / 4) * score2 AS fused
      FROM clicks, range(0, 5) AS w(k)),
s AS (SELECT weight, t.g / 100.0 AS threshold,
             sum(CASE WHEN fused >= t.g / 100.0 AND label = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN fused >= t.g / 100.0 AND label = 0 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN fused < t.g / 100.0 AND label = 1 THEN 1 ELSE 0 END) AS fn
      FROM f, range(5, 96, 5) AS t(g) GROUP BY weight, t.g),
r AS (SELECT weight, threshold, tp, fp, fn, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
             row_number() OVER (PARTITION BY weight ORDER BY CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END DESC, threshold) AS rn
      FROM s)
SELECT round(weight, 6) AS weight, round(threshold, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(fn AS BIGINT) AS fn, round(f1, 6) AS f1 FROM r WHERE rn = 1""")
def q_m04(spark, sf):
    g = sc.fusion_grid(click_rows(spark, sf), "score", "score2", [0, 1, 2, 3, 4], list(range(5, 96, 5)))
    return round_doubles(g.select("weight", "threshold", "tp", "fp", "fn", "f1"))


@register("M07_rank_fusion", "WITH " + CLICK_SQL + """
SELECT row_id, round((rank() OVER (ORDER BY score DESC) + rank() OVER (ORDER BY score2 DESC)) / 2, 6) AS mean_rank
FROM clicks""")
def q_m07(spark, sf):
    r = sc.rank_fusion(click_rows(spark, sf), "row_id", ["score", "score2"])
    return r.select("row_id", r6("mean_rank").alias("mean_rank"))


@register("V23_sliced_report_cube", "WITH " + PRED_SQL + """,
c AS (SELECT c_mktsegment, o_orderpriority, CAST(grouping_id(c_mktsegment, o_orderpriority) AS BIGINT) AS level, """ + CONF_SQL + """
      FROM preds GROUP BY CUBE (c_mktsegment, o_orderpriority))
SELECT c_mktsegment, o_orderpriority, level, tn, fp, fn, tp, """ + RATES_SQL + " FROM c")
def q_v23c(spark, sf):
    return round_doubles(ev.cube_report(_preds(spark, sf), ["c_mktsegment", "o_orderpriority"]))


@register("V12_multi_label_report", r"""
WITH d AS (SELECT list_filter([CASE WHEN lang <> 'en' THEN 'foreign' END, CASE WHEN n_chars > 2000 THEN 'long' END, CASE WHEN contains(text, '@') THEN 'address' END], lambda x: x IS NOT NULL) AS l,
                  list_filter([CASE WHEN NOT contains(lower(text), 'the') THEN 'foreign' END, CASE WHEN length(text) - length(replace(text, ' ', '')) > 300 THEN 'long' END,
                               CASE WHEN contains(text, '.com') THEN 'address' END], lambda x: x IS NOT NULL) AS q FROM documents),
r AS (SELECT c.cls, list_contains(l, c.cls) AS t, list_contains(q, c.cls) AS p FROM d, (VALUES ('foreign'), ('long'), ('address')) c(cls)),
t AS (SELECT cls, sum((t AND p)::INT) AS tp, sum(p::INT) AS np, sum(t::INT) AS nt FROM r WHERE t OR p GROUP BY cls),
per AS (SELECT cls, CASE WHEN np = 0 THEN 0 ELSE tp / np END AS precision, CASE WHEN nt = 0 THEN 0 ELSE tp / nt END AS recall, 2 * tp / (np + nt) AS f1 FROM t),
al AS (SELECT * FROM per UNION ALL SELECT 'macro', avg(precision), avg(recall), avg(f1) FROM per
       UNION ALL SELECT 'micro', sum(tp) / sum(np), sum(tp) / sum(nt), 2 * sum(tp) / (sum(np) + sum(nt)) FROM t)
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM al""")
def q_v12m(spark, sf):
    """Labels from the tables' columns against rules that only read the text."""
    from tessera.sources.tables import table
    tags = lambda **rules: F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    d = table(spark, sf, "documents").filter("text is not null").select(
        tags(foreign=F.col("lang") != "en", long=F.col("n_chars") > 2000, address=F.contains("text", F.lit("@"))).alias("labels"),
        tags(foreign=~F.contains(F.lower("text"), F.lit("the")), long=F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) > 300,
             address=F.contains("text", F.lit(".com"))).alias("preds"))
    return round_doubles(ev.multi_label_report(d))


@register("V24_agreement_matrix", """
WITH j AS (SELECT CAST(n_chars > 2000 AS INTEGER) AS auto, quality AS manual FROM documents JOIN labels USING (doc_id))
SELECT CAST(auto AS VARCHAR) AS a, CAST(manual AS VARCHAR) AS b, count(*) AS n, round(count(*) / (SELECT count(*) FROM j), 6) AS share FROM j GROUP BY 1, 2""")
def q_v24m(spark, sf):
    from tessera.sources.tables import table
    j = (table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
         .select((F.col("n_chars") > 2000).cast("int").alias("auto"), F.col("quality").alias("manual")))
    return round_doubles(ev.agreement_matrix(j, "auto", "manual"))
