"""Frame, mask and image-as-table queries (I01-I09) and attack / robustness summaries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import frames as fr
from tessera.operators import robustness as rb
from tessera.operators import similarity as sim
from tessera.plans.common import round_doubles
from tessera.plans.registry import register
from tessera.sources.tables import table

FRAMES_SQL = """frames AS (
  SELECT user_id AS sequence, rn + rn // 7 AS frame, event_type AS instance, value AS area, event_id
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events))"""


def frames(spark, sf):
    from tessera.functions.skew import running_in_group
    e = table(spark, sf, "events")
    return (running_in_group(e, "user_id", [F.col("ts"), F.col("event_id")], out="__rn")
             .select(F.col("user_id").alias("sequence"), (F.col("__rn") + F.floor(F.col("__rn") / 7)).cast("long").alias("frame"),
                     F.col("event_type").alias("instance"), F.col("value").alias("area"), "event_id"))


@register("I01_consecutive_frames", "WITH " + FRAMES_SQL + """
SELECT a.sequence, a.frame, b.frame AS prev_frame FROM frames a JOIN frames b ON a.sequence = b.sequence AND b.frame = a.frame - 1""")
def q_i01(spark, sf):
    c = fr.consecutive(frames(spark, sf).select("sequence", "frame"), "sequence", "frame")
    return c.select("sequence", "frame", (F.col("frame") - 1).alias("prev_frame"))


@register("I03_temporal_stability", "WITH " + FRAMES_SQL + """
SELECT a.sequence, count(*) AS n_pairs, round(avg(abs(a.area - b.area)), 6) AS mean_change, round(max(abs(a.area - b.area)), 6) AS max_change
FROM frames a JOIN frames b ON a.sequence = b.sequence AND a.instance = b.instance AND b.frame = a.frame - 1 GROUP BY a.sequence""")
def q_i03(spark, sf):
    return round_doubles(fr.temporal_stability(frames(spark, sf), "area"))


PRED_FRAMES_SQL = FRAMES_SQL + """,
pf AS (SELECT sequence, frame, instance, area * (1 + ((event_id % 7) - 3) / 100) AS area FROM frames),
tf AS (SELECT sequence, frame, instance, area FROM frames WHERE event_id % 11 <> 0)"""


def _pred_truth(spark, sf):
    f = frames(spark, sf)
    pred = f.select("sequence", "frame", "instance", (F.col("area") * (1 + ((F.col("event_id") % 7) - 3) / 100)).alias("area"))
    truth = f.filter(F.col("event_id") % 11 != 0).select("sequence", "frame", "instance", "area")
    return pred, truth


@register("I04_excess_change", "WITH " + PRED_FRAMES_SQL + """,
j AS (SELECT p.sequence, p.frame, p.instance, p.area AS p, t.area AS t FROM pf p JOIN tf t USING (sequence, frame, instance))
SELECT a.sequence, count(*) AS n_pairs, round(avg(abs(a.p - b.p) - abs(a.t - b.t)), 6) AS mean_excess
FROM j a JOIN j b ON a.sequence = b.sequence AND a.instance = b.instance AND b.frame = a.frame - 1 GROUP BY a.sequence""")
def q_i04(spark, sf):
    p, t = _pred_truth(spark, sf)
    return round_doubles(fr.excess_change(p, t, "area"))


@register("I04_excess_change_by_precision", "WITH " + FRAMES_SQL + """,
v AS (SELECT * FROM (VALUES ('FP32', 1000.0::DOUBLE), ('FP16', 10.0::DOUBLE), ('INT8', 1.0::DOUBLE)) t(precision, step)),
tf AS (SELECT sequence, frame, instance, area FROM frames WHERE event_id % 11 <> 0),
j AS (SELECT f.sequence, f.frame, f.instance, precision, floor(f.area * (1 + ((f.event_id % 7) - 3) / 100.0::DOUBLE) * step) / step AS p, t.area AS t
      FROM frames f JOIN tf t ON f.sequence = t.sequence AND f.frame = t.frame AND f.instance = t.instance, v)
SELECT a.sequence, a.precision, count(*) AS n_pairs, round(avg(abs(a.p - b.p) - abs(a.t - b.t)), 6) AS mean_excess
FROM j a JOIN j b ON a.sequence = b.sequence AND a.instance = b.instance AND a.precision = b.precision AND b.frame = a.frame - 1 GROUP BY 1, 2""")
def q_i04p(spark, sf):
    """The same model at three precisions: its areas cut to steps of 1/1000, 1/10 and 1."""
    f = frames(spark, sf)
    area = F.col("area") * (1 + ((F.col("event_id") % 7) - 3) / 100)
    steps = F.array(*[F.struct(F.lit(n).alias("precision"), F.lit(x).alias("step")) for n, x in (("FP32", 1000.0), ("FP16", 10.0), ("INT8", 1.0))])
    pred = f.select("sequence", "frame", "instance", area.alias("area"), F.inline(steps)).withColumn("area", F.floor(F.col("area") * F.col("step")) / F.col("step"))
    truth = f.filter(F.col("event_id") % 11 != 0).select("sequence", "frame", "instance", "area")
    return round_doubles(fr.excess_change(pred, truth, "area", variant="precision"))


@register("I06_variant_reports", "WITH " + FRAMES_SQL + """,
n AS (SELECT sequence, count(*) AS k FROM frames GROUP BY 1),
b AS (SELECT f.sequence, f.area, CASE WHEN area < 10 THEN 'small' WHEN area < 50 THEN 'medium' ELSE 'large' END AS size, CASE WHEN k < 40 THEN 'sparse' ELSE 'dense' END AS density
      FROM frames f JOIN n USING (sequence)),
v AS (SELECT size, density, sequence, 'FP32' AS variant, 0.0::DOUBLE AS err FROM b UNION ALL SELECT size, density, sequence, 'FP16', abs(floor(area * 10) / 10 - area) FROM b
      UNION ALL SELECT size, density, sequence, 'INT8', abs(floor(area) - area) FROM b),
s AS (SELECT 'size' AS condition, size AS slice, variant, err FROM v UNION ALL SELECT 'density', density, variant, err FROM v UNION ALL SELECT 'sequence', CAST(sequence AS VARCHAR), variant, err FROM v)
SELECT condition, slice, count(*) AS n, round(avg(CASE WHEN variant = 'FP32' THEN err END), 6) AS FP32, round(avg(CASE WHEN variant = 'FP16' THEN err END), 6) AS FP16,
       round(avg(CASE WHEN variant = 'INT8' THEN err END), 6) AS INT8 FROM s GROUP BY 1, 2""")
def q_i06s(spark, sf):
    from tessera.session import cut_lineage
    f = cut_lineage(frames(spark, sf))
    f = f.join(f.groupBy("sequence").agg(F.count(F.lit(1)).alias("k")), "sequence")
    size = F.when(F.col("area") < 10, "small").when(F.col("area") < 50, "medium").otherwise("large")
    err = lambda n, e: F.struct(F.lit(n).alias("variant"), e.alias("err"))
    v = f.select(size.alias("size"), F.when(F.col("k") < 40, "sparse").otherwise("dense").alias("density"), "sequence", F.inline(F.array(
        err("FP32", F.lit(0.0)), err("FP16", F.abs(F.floor(F.col("area") * 10) / 10 - F.col("area"))), err("INT8", F.abs(F.floor("area") - F.col("area"))))))
    return round_doubles(fr.variant_reports(v, ["size", "density", "sequence"], "variant", "err", ["FP32", "FP16", "INT8"]))


@register("I05_instance_churn", "WITH " + FRAMES_SQL + """,
fs AS (SELECT DISTINCT sequence, frame FROM frames),
pairs AS (SELECT a.sequence, a.frame FROM fs a JOIN fs b ON a.sequence = b.sequence AND b.frame = a.frame + 1),
cur AS (SELECT DISTINCT f.sequence, f.frame, f.instance FROM frames f JOIN pairs USING (sequence, frame)),
nxt AS (SELECT DISTINCT f.sequence, f.frame - 1 AS frame, f.instance FROM frames f JOIN pairs p ON p.sequence = f.sequence AND p.frame = f.frame - 1),
j AS (SELECT coalesce(c.sequence, n.sequence) AS sequence, c.instance AS ci, n.instance AS ni
      FROM cur c FULL JOIN nxt n ON c.sequence = n.sequence AND c.frame = n.frame AND c.instance = n.instance)
SELECT sequence, CAST(sum(CASE WHEN ci IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS appeared,
       CAST(sum(CASE WHEN ni IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS disappeared FROM j GROUP BY sequence""")
def q_i05(spark, sf):
    return fr.instance_churn(frames(spark, sf))


@register("I06_variant_report", "WITH " + FRAMES_SQL + """,
v AS (SELECT CASE WHEN area < 10 THEN 'small' WHEN area < 50 THEN 'medium' ELSE 'large' END AS size_bucket,
             'FP32' AS variant, 0.0 AS err FROM frames
      UNION ALL SELECT CASE WHEN area < 10 THEN 'small' WHEN area < 50 THEN 'medium' ELSE 'large' END, 'FP16', abs(round(area, 1) - area) FROM frames
      UNION ALL SELECT CASE WHEN area < 10 THEN 'small' WHEN area < 50 THEN 'medium' ELSE 'large' END, 'INT8', abs(round(area) - area) FROM frames)
SELECT size_bucket, round(avg(CASE WHEN variant = 'FP32' THEN err END), 6) AS FP32,
       round(avg(CASE WHEN variant = 'FP16' THEN err END), 6) AS FP16, round(avg(CASE WHEN variant = 'INT8' THEN err END), 6) AS INT8
FROM v GROUP BY size_bucket""")
def q_i06(spark, sf):
    f = frames(spark, sf)
    bucket = F.when(F.col("area") < 10, "small").when(F.col("area") < 50, "medium").otherwise("large")
    v = f.select(bucket.alias("size_bucket"), F.explode(F.array(
        F.struct(F.lit("FP32").alias("variant"), F.lit(0.0).alias("err")),
        F.struct(F.lit("FP16").alias("variant"), F.abs(F.round("area", 1) - F.col("area")).alias("err")),
        F.struct(F.lit("INT8").alias("variant"), F.abs(F.round("area") - F.col("area")).alias("err")))).alias("x"))
    v = v.select("size_bucket", "x.variant", "x.err")
    return round_doubles(fr.variant_report(v, "size_bucket", "variant", "err", ["FP32", "FP16", "INT8"]))


PIX_SQL = """px AS (SELECT vec_id AS image, i - 1 AS pixel, CAST(embedding[i] AS DOUBLE) AS a,
                    CAST(embedding[i] AS DOUBLE) + (((i - 1) % 5) - 2) * 0.02 AS b
             FROM embeddings, range(1, 65) AS t(i))"""


def pixels(spark, sf):
    e = table(spark, sf, "embeddings")
    p = e.select(F.col("vec_id").alias("image"), F.posexplode("embedding").alias("pixel", "a"))
    p = p.withColumn("a", F.col("a").cast("double")).withColumn("b", F.col("a") + ((F.col("pixel") % 5) - 2) * 0.02)
    return p.select("image", "pixel", F.col("a").alias("value")), p.select("image", "pixel", F.col("b").alias("value"))


@register("I02_mask_metrics", "WITH " + PIX_SQL + """,
ign AS (SELECT image, pixel FROM px WHERE pixel % 16 = 15),
lab AS (SELECT DISTINCT image FROM px WHERE image % 10 <> 9),
p AS (SELECT image, pixel FROM px WHERE b > 0 AND pixel % 16 <> 15 AND image % 10 <> 9),
t AS (SELECT image, pixel FROM px WHERE a > 0 AND pixel % 16 <> 15 AND image % 10 <> 9),
j AS (SELECT coalesce(p.image, t.image) AS image, p.pixel AS pp, t.pixel AS tp FROM p FULL JOIN t ON p.image = t.image AND p.pixel = t.pixel),
c AS (SELECT l.image, coalesce(sum(CASE WHEN pp IS NOT NULL AND tp IS NOT NULL THEN 1 ELSE 0 END), 0) AS tp,
             coalesce(sum(CASE WHEN pp IS NOT NULL AND tp IS NULL THEN 1 ELSE 0 END), 0) AS fp,
             coalesce(sum(CASE WHEN pp IS NULL AND tp IS NOT NULL THEN 1 ELSE 0 END), 0) AS fn
      FROM lab l LEFT JOIN j USING (image) GROUP BY l.image)
SELECT image, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
       round(CASE WHEN tp + fp + fn = 0 THEN 1.0 ELSE tp / (tp + fp + fn) END, 6) AS iou,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 1.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS dice,
       round(CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp / (tp + fn) END, 6) AS recall FROM c""")
def q_i02(spark, sf):
    a, b = pixels(spark, sf)
    ign = a.filter(F.col("pixel") % 16 == 15).select("image", "pixel")
    lab = a.filter(F.col("image") % 10 != 9).select("image").distinct()
    m = fr.mask_metrics(b.filter("value > 0"), a.filter("value > 0"), ign, lab)
    return round_doubles(m)


@register("I02_mask_metrics_by_instance", "WITH " + PIX_SQL + """,
pi AS (SELECT image, pixel, pixel // 16 AS instance, a, b FROM px),
lab AS (SELECT DISTINCT image, instance FROM pi WHERE image % 10 <> 9),
c AS (SELECT image, instance, sum((a > 0 AND b > 0 AND pixel % 16 <> 15)::INT) AS tp, sum((a <= 0 AND b > 0 AND pixel % 16 <> 15)::INT) AS fp, sum((a > 0 AND b <= 0 AND pixel % 16 <> 15)::INT) AS fn
      FROM pi JOIN lab USING (image, instance) GROUP BY 1, 2)
SELECT image, instance, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
       round(CASE WHEN tp + fp + fn = 0 THEN 1.0 ELSE tp / (tp + fp + fn) END, 6) AS iou,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 1.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS dice,
       round(CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp / (tp + fn) END, 6) AS recall FROM c""")
def q_i02i(spark, sf):
    """Each image's four rows of sixteen pixels are its instances."""
    a, b = (x.withColumn("instance", F.floor(F.col("pixel") / 16).cast("long")) for x in pixels(spark, sf))
    ign = a.filter(F.col("pixel") % 16 == 15).select("image", "pixel")
    lab = a.filter(F.col("image") % 10 != 9).select("image", "instance").distinct()
    return round_doubles(fr.mask_metrics(b.filter("value > 0"), a.filter("value > 0"), ign, lab, instance="instance"))


@register("I07_difference_mask", "WITH " + PIX_SQL + """
SELECT image, CAST(sum(CASE WHEN abs(a - b) > 0.03 THEN 1 ELSE 0 END) AS BIGINT) AS n_changed,
       round(avg(CASE WHEN abs(a - b) > 0.03 THEN 1.0 ELSE 0.0 END), 6) AS share_changed FROM px GROUP BY image""")
def q_i07(spark, sf):
    a, b = pixels(spark, sf)
    return round_doubles(fr.difference_mask(a, b, 0.03))


@register("I08_psnr", "WITH " + PIX_SQL + """
SELECT image, round(avg((a - b) * (a - b)), 6) AS mse,
       round(CASE WHEN avg((a - b) * (a - b)) = 0 THEN NULL ELSE 10 * log10(4.0 / avg((a - b) * (a - b))) END, 6) AS psnr
FROM px GROUP BY image""")
def q_i08(spark, sf):
    a, b = pixels(spark, sf)
    return round_doubles(fr.psnr(a, b, 2.0))


@register("I08_psnr_average", "WITH " + PIX_SQL + """,
m AS (SELECT CAST(image AS VARCHAR) AS image, avg((a - b) * (a - b)) AS mse FROM px GROUP BY image),
p AS (SELECT image, mse, CASE WHEN mse = 0 THEN NULL ELSE 10 * log10(4.0 / mse) END AS psnr FROM m)
SELECT image, round(mse, 6) AS mse, round(psnr, 6) AS psnr FROM p UNION ALL SELECT 'average', round(avg(mse), 6), round(avg(psnr), 6) FROM p""")
def q_i08a(spark, sf):
    a, b = pixels(spark, sf)
    return round_doubles(fr.psnr_with_average(a, b, 2.0))


@register("I09_ssim_global", "WITH " + PIX_SQL + """,
m AS (SELECT image, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS cab FROM px GROUP BY image)
SELECT image, round(((2 * ma * mb + 0.0004) * (2 * cab + 0.0036)) / ((ma * ma + mb * mb + 0.0004) * (va + vb + 0.0036)), 6) AS ssim FROM m""")
def q_i09(spark, sf):
    a, b = pixels(spark, sf)
    return round_doubles(fr.ssim_global(a, b, 2.0))


# ------------------------------------------------------------ attacks, robustness
def _centroid_sql(elem: str) -> str:
    """Nearest clean-class centroid for vectors whose element i (1-based) is ``elem``."""
    return f"""el AS (SELECT vec_id, label, CAST(embedding[i] AS DOUBLE) AS v, i - 1 AS dim FROM embeddings, range(1, 65) AS t(i)),
cent AS (SELECT label AS cls, dim, avg(v) AS cv FROM el GROUP BY 1, 2),
cn AS (SELECT cls, sqrt(sum(cv * cv)) AS n FROM cent GROUP BY cls),
q AS (SELECT vec_id, label, {elem} AS v, i - 1 AS dim FROM embeddings, range(1, 65) AS t(i)),
sc AS (SELECT q.vec_id, cent.cls, sum(q.v * cent.cv) / cn.n AS score FROM q JOIN cent USING (dim) JOIN cn USING (cls)
       GROUP BY q.vec_id, cent.cls, cn.n),
pred AS (SELECT vec_id, cls AS predicted FROM (
           SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 9) DESC, cls) AS r FROM sc) WHERE r = 1),
lp AS (SELECT e.vec_id, e.label, p.predicted FROM embeddings e JOIN pred p USING (vec_id))"""


TRIG_ELEM = "CASE WHEN i <= 4 THEN 0.5 ELSE CAST(embedding[i] AS DOUBLE) END"
NOISE_ELEM = "CAST(embedding[i] AS DOUBLE) + (((i - 1) % 5) - 2) * 0.05"
CLEAN_ELEM = "CAST(embedding[i] AS DOUBLE)"


def _centroid_preds(spark, sf, vec_expr=None):
    e = table(spark, sf, "embeddings")
    cent = sim.class_centroids(e, "label")
    q = e if vec_expr is None else e.withColumn("embedding", vec_expr)
    p = sim.nearest_centroid(q, cent, "vec_id", "label")
    return e.select("vec_id", "label").join(p, "vec_id")


@register("X01_trigger_success_rate", "WITH " + _centroid_sql(TRIG_ELEM) + """
SELECT count(*) AS n_triggered, round(avg(CASE WHEN predicted = 0 THEN 1.0 ELSE 0.0 END), 6) AS attack_success_rate
FROM lp WHERE vec_id % 10 = 0 AND label <> 0""")
def q_x01(spark, sf):
    trig = F.transform("embedding", lambda v, i: F.when(i < 4, F.lit(0.5)).otherwise(v))  # trigger: first 4 dims set
    p = _centroid_preds(spark, sf, trig).withColumn("triggered", F.col("vec_id") % 10 == 0)
    return round_doubles(rb.attack_success(p, 0))


def _member_losses(spark, sf):
    from tessera.functions.exprs import md5_bucket
    e = table(spark, sf, "embeddings").withColumn("member", md5_bucket(42, 2, "vec_id") == 0)
    cent = sim.class_centroids(e.filter("member"), "label")
    lv = e.select("vec_id", "label", "member", F.posexplode("embedding").alias("dim", "v"))
    cn = cent.groupBy("label").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("cn"))
    s = (lv.join(cent, ["label", "dim"]).groupBy("vec_id", "label", "member")
           .agg(F.sum(F.col("v").cast("double") * F.col("value")).alias("dot")).join(cn, "label"))
    return s.select("vec_id", "member", (1 - F.col("dot") / F.col("cn")).alias("loss"))


@register("X02_membership_attack", """
WITH e AS (SELECT vec_id, label, embedding, CAST(('0x' || substring(md5(concat_ws('|', '42', vec_id)), 1, 8))::BIGINT % 2 AS BIGINT) = 0 AS member FROM embeddings),
el AS (SELECT vec_id, label, member, CAST(embedding[i] AS DOUBLE) AS v, i - 1 AS dim FROM e, range(1, 65) AS t(i)),
cent AS (SELECT label, dim, avg(v) AS c FROM el WHERE member GROUP BY 1, 2),
cn AS (SELECT label, sqrt(sum(c * c)) AS n FROM cent GROUP BY 1),
l AS (SELECT el.vec_id, el.member, 1 - sum(el.v * cent.c) / cn.n AS loss FROM el JOIN cent USING (label, dim) JOIN cn USING (label)
      GROUP BY el.vec_id, el.member, cn.n),
g AS (SELECT t.k / 20.0 AS t FROM range(0, 21) AS t(k)),
adv AS (SELECT g.t, sum(CASE WHEN loss <= g.t AND member THEN 1 ELSE 0 END) / sum(CASE WHEN member THEN 1 ELSE 0 END)
               - sum(CASE WHEN loss <= g.t AND NOT member THEN 1 ELSE 0 END) / sum(CASE WHEN NOT member THEN 1 ELSE 0 END) AS a
        FROM l, g GROUP BY g.t),
s AS (SELECT -loss AS score, sum(CAST(member AS INTEGER)) AS pos, sum(1 - CAST(member AS INTEGER)) AS neg FROM l GROUP BY 1),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS negb FROM s)
SELECT round((SELECT max(a) FROM adv), 6) AS best_advantage,
       round((SELECT (sum(pos * negb) + 0.5 * sum(pos * neg)) / (sum(pos) * sum(neg)) FROM c), 6) AS roc_auc""")
def q_x02(spark, sf):
    return round_doubles(rb.membership_attack(_member_losses(spark, sf), [k / 20.0 for k in range(21)]))


@register("X03_unlearning_table", "WITH " + ",\n".join([
    _centroid_sql(CLEAN_ELEM).replace("lp AS", "lp_clean AS").replace("pred AS", "pred_c AS").replace("JOIN pred p", "JOIN pred_c p")
    .replace("sc AS", "sc_c AS").replace("FROM sc)", "FROM sc_c)").replace("q AS", "q_c AS").replace("FROM q JOIN", "FROM q_c q JOIN"),
    _centroid_sql(TRIG_ELEM).split(",\n", 3)[3]]) + """
SELECT 'clean_input' AS model, round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(CASE WHEN predicted = 0 THEN 1.0 ELSE 0.0 END), 6) AS target_rate FROM lp_clean
UNION ALL
SELECT 'triggered_input', round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END), 6),
       round(avg(CASE WHEN predicted = 0 THEN 1.0 ELSE 0.0 END), 6) FROM lp""")
def q_x03(spark, sf):
    trig = F.transform("embedding", lambda v, i: F.when(i < 4, F.lit(0.5)).otherwise(v))
    out = None
    for name, expr in (("clean_input", None), ("triggered_input", trig)):
        p = _centroid_preds(spark, sf, expr)
        m = p.agg(F.lit(name).alias("model"), F.avg((F.col("label") == F.col("predicted")).cast("double")).alias("accuracy"),
                  F.avg((F.col("predicted") == 0).cast("double")).alias("target_rate"))
        out = m if out is None else out.unionByName(m)
    return round_doubles(out)


@register("X08_horizon_error", """
WITH s AS (SELECT user_id, ts, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
                  count(*) OVER (PARTITION BY user_id) AS n FROM events),
tr AS (SELECT user_id, max(rn) AS last_rn, arg_max(value, rn) AS last_value, min(value) AS lo, max(value) AS hi
       FROM s WHERE rn <= (n * 8) // 10 GROUP BY user_id),
te AS (SELECT s.user_id, s.rn - tr.last_rn AS horizon, s.value - tr.last_value AS err, s.value BETWEEN tr.lo AND tr.hi AS inside
       FROM s JOIN tr USING (user_id) WHERE s.rn > tr.last_rn)
SELECT CAST((horizon > 5)::INT + (horizon > 20)::INT AS BIGINT) AS bucket, inside AS inside_range, count(*) AS n,
       round(sqrt(avg(err * err)), 6) AS rmse FROM te GROUP BY 1, 2""")
def q_x08(spark, sf):
    from tessera.functions.skew import running_in_group
    e = table(spark, sf, "events")
    n = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    s = running_in_group(e, "user_id", [F.col("ts"), F.col("event_id")], out="rn").join(n, "user_id")
    tr = s.filter(F.col("rn") <= F.floor(F.col("n") * 8 / 10)).groupBy("user_id").agg(
        F.max("rn").alias("last_rn"), F.max_by("value", "rn").alias("last_value"), F.min("value").alias("lo"),
        F.max("value").alias("hi"))
    te = s.join(tr, "user_id").filter(F.col("rn") > F.col("last_rn")).select(
        (F.col("rn") - F.col("last_rn")).alias("horizon"), (F.col("value") - F.col("last_value")).alias("err"),
        F.col("value").between(F.col("lo"), F.col("hi")).alias("inside"))
    return round_doubles(rb.horizon_error(te, "horizon", "err", [5, 20], "inside"))


@register("X08_horizon_error_by_noise", """
WITH s AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events),
tr AS (SELECT user_id, max(rn) AS last_rn, arg_max(value, rn) AS last_value, arg_max(event_id, rn) AS last_id, min(value) AS lo, max(value) AS hi FROM s WHERE rn <= (n * 8) // 10 GROUP BY user_id),
te AS (SELECT v.noise, s.rn - tr.last_rn AS horizon, s.value - tr.last_value * (1 + v.noise * ((last_id % 5) - 2) / 100.0::DOUBLE) AS err, s.value BETWEEN tr.lo AND tr.hi AS inside
       FROM s JOIN tr USING (user_id), (VALUES (0), (5), (20)) v(noise) WHERE s.rn > tr.last_rn)
SELECT CAST(noise AS BIGINT) AS noise, CAST((horizon > 5)::INT + (horizon > 20)::INT AS BIGINT) AS bucket, inside AS inside_range, count(*) AS n, round(sqrt(avg(err * err)), 6) AS rmse
FROM te GROUP BY 1, 2, 3""")
def q_x08n(spark, sf):
    """The last trained value, disturbed by 0, 5 and 20 per cent steps, is the forecast."""
    from tessera.functions.skew import running_in_group
    e = table(spark, sf, "events")
    n = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    s = running_in_group(e, "user_id", [F.col("ts"), F.col("event_id")], out="rn").join(n, "user_id")
    tr = s.filter(F.col("rn") <= F.floor(F.col("n") * 8 / 10)).groupBy("user_id").agg(
        F.max("rn").alias("last_rn"), F.max_by("value", "rn").alias("last_value"), F.max_by("event_id", "rn").alias("last_id"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    te = s.join(tr, "user_id").filter(F.col("rn") > F.col("last_rn")).withColumn("noise", F.explode(F.array(*[F.lit(x).cast("long") for x in (0, 5, 20)])))
    guess = F.col("last_value") * (1 + F.col("noise") * ((F.col("last_id") % 5) - 2) / 100)
    te = te.select("noise", (F.col("rn") - F.col("last_rn")).alias("horizon"), (F.col("value") - guess).alias("err"), F.col("value").between(F.col("lo"), F.col("hi")).alias("inside"))
    return round_doubles(rb.horizon_error(te, "horizon", "err", [5, 20], "inside", ["noise"]))


# two models of nearest class centroids: fitted on all vectors, and with the vectors of half the members left out ("unlearned")
UNLEARN_SQL = """e AS (SELECT vec_id, label, embedding, CAST(('0x' || substring(md5(concat_ws('|', '42', vec_id)), 1, 8))::BIGINT % 2 AS BIGINT) = 0 AS member FROM embeddings),
el AS (SELECT vec_id, label, member, CAST(embedding[i] AS DOUBLE) AS v, i - 1 AS dim FROM e, range(1, 65) AS t(i)),
fit AS (SELECT 'trained' AS model, label, dim, v FROM el UNION ALL SELECT 'unlearned', label, dim, v FROM el WHERE NOT member),
cent AS (SELECT model, label AS cls, dim, avg(v) AS cv FROM fit GROUP BY 1, 2, 3),
cn AS (SELECT model, cls, sqrt(sum(cv * cv)) AS n FROM cent GROUP BY 1, 2),
q AS (SELECT vec_id, label, member, FALSE AS triggered, dim, v FROM el UNION ALL SELECT vec_id, label, member, TRUE, dim, CASE WHEN dim < 4 THEN 0.5 ELSE v END FROM el WHERE vec_id % 10 = 0),
sc AS (SELECT c.model, q.vec_id, q.label, q.member, q.triggered, c.cls, sum(q.v * c.cv) / any_value(cn.n) AS score FROM q JOIN cent c USING (dim) JOIN cn ON cn.model = c.model AND cn.cls = c.cls GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY model, vec_id, triggered ORDER BY round(score, 9) DESC, cls) AS r, max(CASE WHEN cls = label THEN 1 - score END) OVER (PARTITION BY model, vec_id, triggered) AS loss FROM sc),
b AS (SELECT model, vec_id, label, member, triggered, cls AS predicted, loss FROM p WHERE r = 1)"""


@register("X03_unlearning_with_membership", "WITH " + UNLEARN_SQL + """
SELECT model, round(avg(CASE WHEN NOT triggered THEN (label = predicted)::INT END), 6) AS clean_accuracy,
       round(avg(CASE WHEN triggered AND label <> 0 THEN (predicted = 0)::INT END), 6) AS trigger_rate,
       round(avg(CASE WHEN NOT triggered AND member THEN (round(loss, 9) <= 0.85)::INT END) - avg(CASE WHEN NOT triggered AND NOT member THEN (round(loss, 9) <= 0.85)::INT END), 6) AS membership_advantage
FROM b GROUP BY model""")
def q_x03m(spark, sf):
    """Two centroid models, one fitted without the members, on clean rows and on rows that carry the trigger."""
    from tessera.functions.exprs import md5_bucket
    e = table(spark, sf, "embeddings").select("vec_id", "label", "embedding", (md5_bucket(42, 2, "vec_id") == 0).alias("member"))
    trig = F.transform("embedding", lambda v, i: F.when(i < 4, F.lit(0.5)).otherwise(v))
    rows = e.withColumn("triggered", F.lit(False)).unionByName(e.filter("vec_id % 10 = 0").withColumn("embedding", trig).withColumn("triggered", F.lit(True)))
    out = None
    for model, fit in (("trained", e), ("unlearned", e.filter("NOT member"))):
        s = sim.centroid_scores(rows, sim.class_centroids(fit, "label"), "label")
        best = F.array_sort(F.transform(F.map_entries("scores"), lambda x: F.struct((-F.round(x["value"], 9)).alias("s"), x["key"].alias("c"))))
        d = s.select(F.lit(model).alias("model"), "label", "member", "triggered", F.get(best, F.lit(0))["c"].alias("predicted"),
                     F.round(1 - F.element_at("scores", F.col("label")), 9).alias("loss"))
        out = d if out is None else out.unionByName(d)
    return round_doubles(rb.unlearning_table(out, 0, cut=0.85))


@register("X10_robustness_delta", "WITH " + ",\n".join([
    _centroid_sql(CLEAN_ELEM).replace("lp AS", "lp_clean AS").replace("pred AS", "pred_c AS").replace("JOIN pred p", "JOIN pred_c p")
    .replace("sc AS", "sc_c AS").replace("FROM sc)", "FROM sc_c)").replace("q AS", "q_c AS").replace("FROM q JOIN", "FROM q_c q JOIN"),
    _centroid_sql(NOISE_ELEM).split(",\n", 3)[3]]) + """,
a AS (SELECT label, avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END) AS acc FROM lp GROUP BY 1),
c AS (SELECT label, avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END) AS acc FROM lp_clean GROUP BY 1)
SELECT a.label, round(a.acc, 6) AS accuracy, 'noise' AS condition, round(a.acc - c.acc, 6) AS accuracy_delta
FROM a JOIN c USING (label)""")
def q_x10(spark, sf):
    noisy = F.transform("embedding", lambda v, i: v + ((i % 5) - 2) * 0.05)
    rows = None
    for cond, expr in (("clean", None), ("noise", noisy)):
        p = _centroid_preds(spark, sf, expr)
        m = p.groupBy("label").agg(F.avg((F.col("label") == F.col("predicted")).cast("double")).alias("accuracy")).withColumn(
            "condition", F.lit(cond))
        rows = m if rows is None else rows.unionByName(m)
    return round_doubles(rb.robustness(rows, "label", "condition", "clean", ["accuracy"]))
