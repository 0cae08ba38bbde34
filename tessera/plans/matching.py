"""Flow B (listing matching) and dense-vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import r6
from tessera.operators import evaluate as ev
from tessera.operators import pairs as pr
from tessera.operators import setjoin as sj
from tessera.operators import similarity as sim
from tessera.plans.common import round_doubles
from tessera.plans.registry import register
from tessera.plans.standins import LISTINGS_SQL, listings
from tessera.plans.textplans import CHAR_TFIDF_SQL, char_tfidf
from tessera.session import cut_lineage
from tessera.sources.tables import table

POS_SQL = LISTINGS_SQL + """,
rk AS (SELECT posting_id, label_group, row_number() OVER (PARTITION BY label_group ORDER BY md5(concat_ws('|', '42', posting_id))) AS rn
       FROM listings),
positives AS (SELECT least(a.posting_id, b.posting_id) AS id_a, greatest(a.posting_id, b.posting_id) AS id_b, 1 AS label
              FROM rk a JOIN rk b ON a.label_group = b.label_group AND b.rn = a.rn + 1)"""

NEG_SQL = POS_SQL + """,
pos AS (SELECT posting_id AS id, label_group AS g, row_number() OVER (ORDER BY md5(concat_ws('|', '42', posting_id))) - 1 AS p
        FROM listings),
nn AS (SELECT count(*) AS n FROM listings),
cands AS (SELECT DISTINCT least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b
          FROM pos a CROSS JOIN nn CROSS JOIN range(1, 4) AS s(s) JOIN pos b ON b.p = (a.p + s.s) % nn.n
          WHERE a.g <> b.g),
negatives AS (SELECT id_a, id_b, 0 AS label FROM (
                SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', id_a, id_b))) AS r FROM cands)
              WHERE r <= (SELECT count(*) FROM positives)),
pairs AS (SELECT * FROM positives UNION ALL SELECT * FROM negatives)"""


def _pos(spark, sf):
    return pr.positive_pairs(listings(spark, sf), "posting_id", "label_group")


def _pairs(spark, sf):
    lst = listings(spark, sf)
    pos = cut_lineage(pr.positive_pairs(lst, "posting_id", "label_group"))
    neg = pr.negative_pairs(lst, "posting_id", "label_group", pos.agg(F.count(F.lit(1)).alias("n")))
    return pr.labelled_pairs(pos, neg)


@register("J04_positive_pairs_chain", "WITH " + POS_SQL + " SELECT id_a, id_b, label FROM positives")
def q_j04(spark, sf):
    return _pos(spark, sf)


@register("J05_negative_pairs", "WITH " + NEG_SQL + " SELECT id_a, id_b, label FROM negatives")
def q_j05(spark, sf):
    lst = listings(spark, sf)
    return pr.negative_pairs(lst, "posting_id", "label_group", _pos(spark, sf).agg(F.count(F.lit(1)).alias("n")))


@register("J06_labelled_pairs", "WITH " + NEG_SQL + " SELECT id_a, id_b, label FROM pairs")
def q_j06(spark, sf):
    return _pairs(spark, sf)


PAIR_COS_SQL = NEG_SQL + ",\n" + CHAR_TFIDF_SQL + """,
shared AS (SELECT p.id_a, p.id_b, sum(x.weight * y.weight) AS cosine
           FROM pairs p JOIN tfidf x ON x.posting_id = p.id_a JOIN tfidf y ON y.posting_id = p.id_b AND y.term = x.term
           GROUP BY 1, 2),
scored AS (SELECT p.id_a, p.id_b, p.label, coalesce(s.cosine, 0.0) AS cosine FROM pairs p LEFT JOIN shared s USING (id_a, id_b))"""


def _scored_pairs(spark, sf):
    # read by both sides of the pairs
    vecs = cut_lineage(char_tfidf(spark, sf).withColumnRenamed("posting_id", "id"))
    return sim.pair_cosine_sparse(_pairs(spark, sf), vecs)


@register("N04_pair_cosine_char_tfidf", "WITH " + PAIR_COS_SQL + """
SELECT id_a, id_b, label, round(cosine, 6) AS cosine FROM scored""")
def q_n04(spark, sf):
    return round_doubles(_scored_pairs(spark, sf))


PAIR_SWEEP_SQL = PAIR_COS_SQL + """,
sweep AS (
  SELECT t.g / 100.0 AS threshold,
         CAST(sum(CASE WHEN cosine >= t.g / 100.0 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN cosine >= t.g / 100.0 AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN cosine < t.g / 100.0 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN cosine < t.g / 100.0 AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM scored, range(10, 96, 5) AS t(g) GROUP BY t.g)"""


@register("V04_pair_threshold_sweep", "WITH " + PAIR_SWEEP_SQL + """
SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM sweep""",
          headline=True)
def q_v04p(spark, sf):
    sw = ev.threshold_sweep(_scored_pairs(spark, sf), list(range(10, 96, 5)), "label", "cosine")
    return round_doubles(sw.select("threshold", "tp", "fp", "fn", "tn", "precision", "recall", "f1"))


@register("V18_pair_error_types", "WITH " + PAIR_COS_SQL + """
SELECT CASE WHEN label = CAST(cosine >= 0.5 AS INTEGER) THEN 'Correct' WHEN cosine >= 0.5 THEN 'False Positive'
            ELSE 'False Negative' END AS error_type, count(*) AS count FROM scored GROUP BY 1""")
def q_v18p(spark, sf):
    from tessera.operators.basic import predict
    d = ev.error_types(predict(_scored_pairs(spark, sf), 0.5, "cosine"))
    return d.groupBy("error_type").agg(F.count(F.lit(1)).alias("count"))


@register("V20_changed_pairs_with_titles", "WITH " + PAIR_COS_SQL + """,
h AS (SELECT s.*, CAST(a.image_phash = b.image_phash AS INTEGER) AS same_image FROM scored s JOIN listings a ON a.posting_id = id_a JOIN listings b ON b.posting_id = id_b),
m AS (SELECT *, CAST(cosine >= 0.6 AS INTEGER) AS pred_a, CAST(0.5 * cosine + 0.5 * same_image >= 0.6 AS INTEGER) AS pred_b FROM h)
SELECT id_a, id_b, CASE WHEN pred_b = label THEN 'rescued' ELSE 'hurt' END AS change, ta.title AS title_a, tb.title AS title_b
FROM m JOIN titles ta ON ta.posting_id = id_a JOIN titles tb ON tb.posting_id = id_b WHERE (pred_a = label) <> (pred_b = label)""")
def q_v20p(spark, sf):
    """Pairs whose verdict turns right or wrong when the image hash joins the text score, with both titles."""
    from tessera.plans.textplans import _titles
    im = listings(spark, sf).select("posting_id", "image_phash")
    p = (_scored_pairs(spark, sf).join(im.toDF("id_a", "ha").hint("merge"), "id_a").join(im.toDF("id_b", "hb").hint("merge"), "id_b")
         .withColumn("pred_a", (F.col("cosine") >= 0.6).cast("int"))
         .withColumn("pred_b", (0.5 * F.col("cosine") + 0.5 * (F.col("ha") == F.col("hb")).cast("int") >= 0.6).cast("int")))
    d = ev.model_disagreement(p, "label", "pred_a", "pred_b").filter(F.col("change").isin("rescued", "hurt"))
    t = _titles(spark, sf).select("posting_id", "title")
    return d.join(t.toDF("id_a", "title_a").hint("merge"), "id_a").join(t.toDF("id_b", "title_b").hint("merge"), "id_b").select("id_a", "id_b", "change", "title_a", "title_b")


@register("V19_pair_worst_errors_with_titles", "WITH " + PAIR_COS_SQL + """,
e AS ((SELECT id_a, id_b, cosine, 'False Positive' AS error_type FROM scored WHERE cosine >= 0.5 AND label = 0
       ORDER BY cosine DESC, id_a, id_b LIMIT 5)
      UNION ALL
      (SELECT id_a, id_b, cosine, 'False Negative' FROM scored WHERE cosine < 0.5 AND label = 1
       ORDER BY cosine, id_a, id_b LIMIT 5))
SELECT id_a, id_b, round(cosine, 6) AS cosine, error_type, ta.title AS title_a, tb.title AS title_b
FROM e JOIN titles ta ON ta.posting_id = id_a JOIN titles tb ON tb.posting_id = id_b""")
def q_v19p(spark, sf):
    from tessera.operators.basic import predict
    from tessera.plans.textplans import _titles
    d = predict(cut_lineage(_scored_pairs(spark, sf)), 0.5, "cosine")  # read once per kind of error
    fp = d.filter("pred = 1 AND label = 0").orderBy(F.desc("cosine"), "id_a", "id_b").limit(5).withColumn(
        "error_type", F.lit("False Positive"))
    fn = d.filter("pred = 0 AND label = 1").orderBy("cosine", "id_a", "id_b").limit(5).withColumn(
        "error_type", F.lit("False Negative"))
    t = _titles(spark, sf).select("posting_id", "title")
    e = t.toDF("id_a", "title_a").join(F.broadcast(fp.unionByName(fn)), "id_a")  # the ten errors travel, not the titles
    e = t.toDF("id_b", "title_b").join(F.broadcast(e), "id_b")
    return e.select("id_a", "id_b", r6("cosine").alias("cosine"), "error_type", "title_a", "title_b")


@register("J09_hash_block_links", "WITH " + LISTINGS_SQL + """,
rep AS (SELECT image_phash, min(posting_id) AS rep_id, count(*) AS group_size FROM listings GROUP BY 1 HAVING count(*) > 1)
SELECT posting_id AS id_a, rep_id AS id_b, image_phash, group_size FROM listings JOIN rep USING (image_phash)
WHERE posting_id <> rep_id""")
def q_j09(spark, sf):
    return pr.hash_block_links(listings(spark, sf), "posting_id", "image_phash")


@register("N11_connected_groups", "WITH RECURSIVE " + POS_SQL + """,
rep AS (SELECT image_phash, min(posting_id) AS rep_id FROM listings GROUP BY 1 HAVING count(*) > 1),
links AS (SELECT posting_id AS a, rep_id AS b FROM listings JOIN rep USING (image_phash) WHERE posting_id <> rep_id
          UNION SELECT id_a, id_b FROM positives),
und AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, root) AS (SELECT DISTINCT a, a FROM und UNION SELECT u.b, r.root FROM reach r JOIN und u ON u.a = r.node)
SELECT node, min(root) AS component FROM reach GROUP BY node""")
def q_n11(spark, sf):
    lst = listings(spark, sf)
    links = pr.hash_block_links(lst, "posting_id", "image_phash").select("id_a", "id_b").unionByName(
        _pos(spark, sf).select("id_a", "id_b"))
    return pr.connected_groups(links)


# ------------------------------------------------------------ dense vectors
EMB_LONG_SQL = """el AS (SELECT vec_id, label, CAST(embedding[i] AS DOUBLE) AS v, i - 1 AS dim
                        FROM embeddings, range(1, 65) AS t(i))"""

DENSE_SIMS_SQL = """norms AS (SELECT vec_id, label, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm,
                         embedding FROM embeddings),
sims AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label AS la, b.label AS lb,
                CASE WHEN a.nrm * b.nrm = 0 THEN 0.0 ELSE
                list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))) / (a.nrm * b.nrm) END AS sim
         FROM norms a JOIN norms b ON a.vec_id <> b.vec_id)"""


def _emb(spark, sf):
    return table(spark, sf, "embeddings")


@register("N07_knn_top5_embeddings", "WITH " + DENSE_SIMS_SQL + """
SELECT a, b, CAST(rnk AS BIGINT) AS rank, round(sim, 6) AS sim
FROM (SELECT a, b, sim, row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) AS rnk FROM sims) WHERE rnk <= 5""",
          headline=True)
def q_n07(spark, sf):
    k = sim.knn_join(_emb(spark, sf), 5, "vec_id", "embedding")
    return k.select("a", "b", "rank", r6("sim").alias("sim"))


@register("J12_hard_negatives_top3", "WITH " + DENSE_SIMS_SQL + """
SELECT a, b, CAST(rnk AS BIGINT) AS rank, round(sim, 6) AS sim
FROM (SELECT a, b, sim, row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) AS rnk FROM sims WHERE la <> lb)
WHERE rnk <= 3""")
def q_j12(spark, sf):
    k = sim.knn_join(_emb(spark, sf), 3, "vec_id", "embedding", exclude_same="label")
    return k.select("a", "b", "rank", r6("sim").alias("sim"))


@register("V16_same_label_recall_at_k", "WITH " + DENSE_SIMS_SQL + """,
r AS (SELECT a, b, la, lb, row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) AS rnk FROM sims),
f AS (SELECT a, min(CASE WHEN la = lb THEN rnk END) AS first_hit FROM r WHERE rnk <= 10 GROUP BY a)
SELECT round(avg(CASE WHEN first_hit <= 1 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_1,
       round(avg(CASE WHEN first_hit <= 5 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_5,
       round(avg(CASE WHEN first_hit <= 10 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_10 FROM f""")
def q_v16(spark, sf):
    e = _emb(spark, sf)
    k = sim.knn_join(e, 10, "vec_id", "embedding")
    lab = e.select("vec_id", "label")
    ranked = (k.join(lab.select(F.col("vec_id").alias("a"), F.col("label").alias("la")), "a")
               .join(lab.select(F.col("vec_id").alias("b"), F.col("label").alias("lb")), "b")
               .withColumn("query", F.col("a")).withColumn("item", F.col("lb")))
    truth = lab.select(F.col("vec_id").alias("query"), F.col("label").alias("item"))
    return round_doubles(ev.recall_at_k(ranked, truth, [1, 5, 10], "query", "item", "rank"))


# the other side of a vector: itself with three of four components' signs turned (a hard counterpart)
OTHER_SIDE_SQL = """sides AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x,
                 list_transform(embedding, lambda v, i: CASE WHEN (i - 1) % 3 = 2 THEN -CAST(v AS DOUBLE) ELSE CAST(v AS DOUBLE) END) AS y FROM embeddings),
both_ways AS (SELECT 'forward' AS direction, vec_id, x AS q, y AS o FROM sides UNION ALL SELECT 'backward', vec_id, y, x FROM sides),
near AS (SELECT a.direction, a.vec_id AS a, b.vec_id AS b,
                list_sum(list_transform(list_zip(a.q, b.o), lambda z: z[1] * z[2])) / sqrt(list_sum(list_transform(a.q, lambda v: v * v)) * list_sum(list_transform(b.o, lambda v: v * v))) AS sim
         FROM both_ways a JOIN both_ways b ON a.direction = b.direction WHERE a.vec_id % 20 = 0),
place AS (SELECT direction, a, b, row_number() OVER (PARTITION BY direction, a ORDER BY round(sim, 9) DESC, b) AS rnk FROM near)"""


@register("V16_recall_both_ways", "WITH " + OTHER_SIDE_SQL + """
SELECT direction, round(avg(CASE WHEN rnk <= 1 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_1, round(avg(CASE WHEN rnk <= 5 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_5,
       round(avg(CASE WHEN rnk <= 10 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_10 FROM place WHERE a = b GROUP BY direction""")
def q_v16_both(spark, sf):
    """Each side of a vector asks for its counterpart among all of the other side."""
    x = _emb(spark, sf).select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("embedding"))
    y = x.select("vec_id", F.transform("embedding", lambda v, i: F.when(i % 3 == 2, -v).otherwise(v)).alias("embedding"))
    asked, out = F.col("vec_id") % 20 == 0, None
    for name, q, o in (("forward", x, y), ("backward", y, x)):
        found = sim.nearest(o, q.filter(asked), 10, "vec_id", "embedding", "vec_id", "embedding", keep_own=True)
        truth = q.filter(asked).select(F.col("vec_id").alias("query"), F.col("vec_id").alias("b"))
        r = ev.recall_at_k(found, truth, [1, 5, 10], "query", "b", "rank").select(F.lit(name).alias("direction"), "recall_at_1", "recall_at_5", "recall_at_10")
        out = r if out is None else out.unionByName(r)
    return round_doubles(out)


CENTROID_SQL = EMB_LONG_SQL + """,
cent AS (SELECT label AS cls, dim, avg(v) AS cv FROM el GROUP BY 1, 2),
cn AS (SELECT cls, sqrt(sum(cv * cv)) AS n FROM cent GROUP BY cls),
sc AS (SELECT el.vec_id, cent.cls, sum(el.v * cent.cv) / cn.n AS score
       FROM el JOIN cent USING (dim) JOIN cn USING (cls) GROUP BY el.vec_id, cent.cls, cn.n),
pred AS (SELECT vec_id, cls AS predicted, score FROM (
           SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 9) DESC, cls) AS r FROM sc) WHERE r = 1),
lp AS (SELECT e.vec_id, e.label, p.predicted FROM embeddings e JOIN pred p USING (vec_id))"""


def _centroid_preds(spark, sf):
    e = _emb(spark, sf)
    p = sim.nearest_centroid(e, sim.class_centroids(e, "label"), "vec_id", "label")
    return e.select("vec_id", "label").join(p, "vec_id")


@register("X09_nearest_centroid_class", "WITH " + CENTROID_SQL + """
SELECT vec_id, label, predicted FROM lp""")
def q_x09(spark, sf):
    return _centroid_preds(spark, sf).select("vec_id", "label", "predicted")


@register("V12_per_class_report", "WITH " + CENTROID_SQL + """,
classes AS (SELECT label AS cls FROM lp UNION SELECT predicted FROM lp),
t AS (SELECT c.cls, (SELECT count(*) FROM lp WHERE label = c.cls AND predicted = c.cls) AS tp,
             (SELECT count(*) FROM lp WHERE predicted = c.cls) AS n_pred, (SELECT count(*) FROM lp WHERE label = c.cls) AS n_true
      FROM classes c),
per AS (SELECT CAST(cls AS VARCHAR) AS cls, CASE WHEN n_pred = 0 THEN 0 ELSE tp / n_pred END AS precision,
               CASE WHEN n_true = 0 THEN 0 ELSE tp / n_true END AS recall,
               CASE WHEN n_pred + n_true = 0 THEN 0 ELSE 2 * tp / (n_pred + n_true) END AS f1 FROM t),
allr AS (SELECT * FROM per
         UNION ALL SELECT 'macro', avg(precision), avg(recall), avg(f1) FROM per
         UNION ALL SELECT 'micro', sum(tp) / sum(n_pred), sum(tp) / sum(n_true), 2 * sum(tp) / (sum(n_pred) + sum(n_true)) FROM t)
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM allr""")
def q_v12(spark, sf):
    return round_doubles(ev.per_class_report(_centroid_preds(spark, sf), "label", "predicted"))


PAIRS_DENSE_SQL = """rk AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', vec_id))) AS rn
       FROM embeddings),
dp AS (SELECT least(a.vec_id, b.vec_id) AS id_a, greatest(a.vec_id, b.vec_id) AS id_b FROM rk a JOIN rk b
       ON a.label = b.label AND b.rn = a.rn + 1)"""


@register("N05_pair_cosine_dense", "WITH " + PAIRS_DENSE_SQL + """,
nv AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS n FROM embeddings)
SELECT id_a, id_b, round(CASE WHEN x.n * y.n = 0 THEN 0.0 ELSE
       list_sum(list_transform(list_zip(x.embedding, y.embedding), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))) / (x.n * y.n) END, 6) AS cosine
FROM dp JOIN nv x ON x.vec_id = id_a JOIN nv y ON y.vec_id = id_b""")
def q_n05(spark, sf):
    e = _emb(spark, sf)
    p = pr.positive_pairs(e, "vec_id", "label").select("id_a", "id_b")
    c = sim.pair_cosine_dense(p, e, id_col="vec_id")
    return c.select("id_a", "id_b", r6("cosine").alias("cosine"))


@register("N14_paired_distance_perturbed", """
WITH b AS (SELECT vec_id, embedding AS x,
                  list_transform(embedding, lambda v, i: CASE WHEN (i - 1) % 4 = 3 THEN -CAST(v AS DOUBLE) ELSE CAST(v AS DOUBLE) END) AS y
           FROM embeddings),
n AS (SELECT vec_id, x, y, sqrt(list_sum(list_transform(x, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))) AS nx,
             sqrt(list_sum(list_transform(y, lambda v: v * v))) AS ny FROM b)
SELECT vec_id, round(CASE WHEN nx * ny = 0 THEN 0.0 ELSE
       list_sum(list_transform(list_zip(x, y), lambda z: CAST(z[1] AS DOUBLE) * z[2])) / (nx * ny) END, 6) AS cosine FROM n""")
def q_n14(spark, sf):
    e = _emb(spark, sf).select("vec_id", "embedding")
    b = e.select("vec_id", F.transform("embedding", lambda v, i: F.when(i % 4 == 3, -v.cast("double")).otherwise(
        v.cast("double"))).alias("embedding"))
    d = sim.paired_distance(e, b, "vec_id")
    return d.select("vec_id", r6("cosine").alias("cosine"))


@register("N14_matched_against_random", """
WITH s AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x, row_number() OVER (ORDER BY md5(concat_ws('|', '14', vec_id)), vec_id) - 1 AS i, count(*) OVER () AS n,
                  list_transform(embedding, lambda v, i: CASE WHEN (i - 1) % 4 = 3 THEN -CAST(v AS DOUBLE) ELSE CAST(v AS DOUBLE) END) AS y FROM embeddings),
p AS (SELECT a.label, list_cosine_similarity(a.x, a.y) AS matched, list_cosine_similarity(a.x, b.y) AS random FROM s a JOIN s b ON b.i = (a.i + 1) % a.n)
SELECT coalesce(CAST(label AS VARCHAR), 'all') AS bucket, count(*) AS n, round(avg(matched), 6) AS mean_matched, round(avg(random), 6) AS mean_random, round(corr(matched, random), 6) AS correlation
FROM p GROUP BY GROUPING SETS ((label), ())""")
def q_n14r(spark, sf):
    e = _emb(spark, sf)
    other = e.select("vec_id", F.transform("embedding", lambda v, i: F.when(i % 4 == 3, -v.cast("double")).otherwise(v.cast("double"))).alias("embedding"))
    return round_doubles(sim.matched_against_random(e, other, "vec_id", "label", seed=14))


# the query set: every vector whose id is divisible by 20
QUERY_SET_SQL = """qs AS (SELECT vec_id FROM embeddings WHERE vec_id % 20 = 0)"""


@register("N06_nearest_to_query_set", "WITH " + QUERY_SET_SQL + ",\n" + DENSE_SIMS_SQL + """
SELECT a AS query, b, CAST(rnk AS BIGINT) AS rank, round(sim, 6) AS sim
FROM (SELECT a, b, sim, row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) AS rnk FROM sims
      WHERE a IN (SELECT vec_id FROM qs)) WHERE rnk <= 5""")
def q_n06(spark, sf):
    e = _emb(spark, sf)
    n = sim.nearest(e, e.filter("vec_id % 20 = 0"), 5, "vec_id", "embedding", "vec_id", "embedding")
    return n.select("query", "b", "rank", r6("sim").alias("sim"))


# hashed character 3-gram vectors of titles: bucket = md5 of the gram, 256 buckets
HASHED_TITLES_SQL = LISTINGS_SQL + r""",
tg AS (SELECT posting_id, label_group, substring(s, i, 3) AS g
       FROM (SELECT posting_id, label_group, s, unnest(range(1, length(s) - 1)) AS i
             FROM (SELECT posting_id, label_group, trim(regexp_replace(lower(title), '\s+', ' ', 'g')) AS s FROM listings))),
hb AS (SELECT posting_id, CAST(('0x' || substring(md5(g), 1, 8))::BIGINT % 256 AS BIGINT) AS bucket, count(*) AS c FROM tg GROUP BY 1, 2),
hn AS (SELECT posting_id, sqrt(sum(c * c)) AS n FROM hb GROUP BY 1),
hs AS (SELECT x.posting_id AS a, y.posting_id AS b, sum(x.c * y.c) / (nx.n * ny.n) AS sim
       FROM hb x JOIN hb y ON x.bucket = y.bucket AND x.posting_id <> y.posting_id
       JOIN hn nx ON nx.posting_id = x.posting_id JOIN hn ny ON ny.posting_id = y.posting_id GROUP BY 1, 2, nx.n, ny.n),
hother AS (SELECT hs.* FROM hs JOIN listings la ON la.posting_id = hs.a JOIN listings lb ON lb.posting_id = hs.b WHERE la.label_group <> lb.label_group),
htop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) AS rnk FROM hother) WHERE rnk <= 5)"""


def hashed_title_vectors(spark, sf, dims=256):
    from tessera.functions.exprs import char_ngrams, collapse_spaces
    lst = listings(spark, sf)
    t = lst.select("posting_id", collapse_spaces(F.lower("title")).alias("t"))
    g = t.select("posting_id", F.explode(char_ngrams("t", 3)).alias("g"))
    b = g.select("posting_id", F.pmod(F.conv(F.substring(F.md5("g"), 1, 8), 16, 10).cast("long"), F.lit(dims)).alias("bucket"))
    c = b.groupBy("posting_id", "bucket").agg(F.count(F.lit(1)).cast("double").alias("c"))
    v = c.groupBy("posting_id").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "c"))).alias("m"))
    return v.select("posting_id", F.transform(F.sequence(F.lit(0).cast("long"), F.lit(dims - 1).cast("long")),
                                              lambda i: F.coalesce(F.col("m")[i], F.lit(0.0))).alias("embedding"))


@register("E21_similar_title_conflicts", "WITH " + HASHED_TITLES_SQL + """
SELECT a, b, round(sim, 6) AS sim FROM htop WHERE sim >= 0.8""")
def q_e21(spark, sf):
    """The five most similar titles of another identity (k is the feature; the identity is ruled out before ranking)."""
    grp = listings(spark, sf).select("posting_id", F.xxhash64("label_group").alias("grp"))
    v = cut_lineage(hashed_title_vectors(spark, sf).join(grp.hint("merge"), "posting_id"))  # counted and read twice
    k = sim.knn_join(v, 5, "posting_id", "embedding", exclude_same="grp")
    return k.filter(F.col("sim") >= 0.8).select("a", "b", r6("sim").alias("sim"))


@register("M05_ablation_table", "WITH " + PAIR_COS_SQL + """,
im AS (SELECT s.label, s.cosine, CAST(a.image_phash = b.image_phash AS INTEGER) AS same FROM scored s JOIN listings a ON a.posting_id = id_a JOIN listings b ON b.posting_id = id_b),
cfg AS (SELECT 'text_char' AS config, label, cosine AS s FROM im
        UNION ALL SELECT 'image_hash', label, same FROM im
        UNION ALL SELECT 'fused_half', label, 0.5 * cosine + 0.5 * same FROM im),
c AS (SELECT config, sum(CASE WHEN s >= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN s >= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN s < 0.5 AND label = 1 THEN 1 ELSE 0 END) AS fn FROM cfg GROUP BY 1)
SELECT config, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM c""")
def q_m05(spark, sf):
    from tessera.operators.basic import predict
    im = listings(spark, sf).select("posting_id", "image_phash")
    same = (F.col("ha") == F.col("hb")).cast("int")
    sp = _scored_pairs(spark, sf).join(im.toDF("id_a", "ha").hint("merge"), "id_a").join(im.toDF("id_b", "hb").hint("merge"), "id_b")
    sp = cut_lineage(sp.select("label", "cosine", same.alias("same")))  # read once per configuration
    runs = None
    for name, expr in (("text_char", F.col("cosine")), ("image_hash", F.col("same")),
                       ("fused_half", 0.5 * F.col("cosine") + 0.5 * F.col("same"))):
        d = predict(sp.withColumn("s", expr), 0.5, "s")
        m = ev.classification_report(d).select(F.lit(name).alias("config"), "precision", "recall", "f1")
        runs = m if runs is None else runs.unionByName(m)
    return round_doubles(runs)


@register("V25_semantic_similarity", """
WITH b AS (SELECT vec_id, label, embedding AS x,
                  list_transform(embedding, lambda v, i: CASE WHEN (i - 1) % 4 = 3 THEN -CAST(v AS DOUBLE) ELSE CAST(v AS DOUBLE) END) AS y
           FROM embeddings),
n AS (SELECT vec_id, label, x, y, sqrt(list_sum(list_transform(x, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))) AS nx,
             sqrt(list_sum(list_transform(y, lambda v: v * v))) AS ny FROM b),
c AS (SELECT label, CASE WHEN nx * ny = 0 THEN 0.0 ELSE
             list_sum(list_transform(list_zip(x, y), lambda z: CAST(z[1] AS DOUBLE) * z[2])) / (nx * ny) END AS cosine FROM n)
SELECT CAST(label AS VARCHAR) AS bucket, count(*) AS n, round(avg(cosine), 6) AS mean_cosine FROM c GROUP BY label
UNION ALL SELECT 'all', count(*), round(avg(cosine), 6) FROM c""")
def q_v25(spark, sf):
    e = _emb(spark, sf).select("vec_id", "label", "embedding")
    b = e.select("vec_id", F.transform("embedding", lambda v, i: F.when(i % 4 == 3, -v.cast("double")).otherwise(
        v.cast("double"))).alias("embedding"))
    d = sim.paired_distance(e, b, "vec_id").join(e.select("vec_id", "label"), "vec_id")
    per = d.groupBy(F.col("label").cast("string").alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.avg("cosine").alias("mean_cosine"))
    allr = d.agg(F.lit("all").alias("bucket"), F.count(F.lit(1)).alias("n"), F.avg("cosine").alias("mean_cosine"))
    return round_doubles(per.unionByName(allr))


# brute force over all pairs that share a shingle; equal sets are one class, represented by the smallest id
NEAR_DUPLICATE_SQL = r"""dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id > b.doc_id GROUP BY 1, 2),
sim AS (SELECT a, b, m / (x.n + y.n - m) AS jaccard FROM inter JOIN sz x ON x.doc_id = a JOIN sz y ON y.doc_id = b WHERE m / (x.n + y.n - m) >= 0.8),
rep AS (SELECT sz.doc_id, coalesce(min(b), sz.doc_id) AS rep FROM sz LEFT JOIN sim ON a = sz.doc_id AND jaccard = 1 GROUP BY sz.doc_id),
links AS (SELECT doc_id AS id_a, rep AS id_b, CAST(1 AS DOUBLE) AS jaccard FROM rep WHERE doc_id <> rep
          UNION ALL SELECT a, b, jaccard FROM sim JOIN rep x ON x.doc_id = a AND x.rep = a JOIN rep y ON y.doc_id = b AND y.rep = b)"""


@register("N09_near_duplicate_links", "WITH " + NEAR_DUPLICATE_SQL + """
SELECT id_a, id_b, round(jaccard, 6) AS jaccard FROM links""")
def q_n09(spark, sf):
    return round_doubles(sj.near_duplicate_links(table(spark, sf, "documents")))


@register("N09_near_duplicate_clusters", "WITH RECURSIVE " + NEAR_DUPLICATE_SQL + """,
und AS (SELECT id_a AS a, id_b AS b FROM links UNION SELECT id_b, id_a FROM links),
reach(node, root) AS (SELECT DISTINCT a, a FROM und UNION SELECT u.b, r.root FROM reach r JOIN und u ON u.a = r.node)
SELECT node, min(root) AS component FROM reach GROUP BY node""")
def q_n09c(spark, sf):
    return pr.connected_groups(sj.near_duplicate_links(table(spark, sf, "documents")))


@register("E21_dissimilar_same_group", "WITH " + POS_SQL + HASHED_TITLES_SQL[len(LISTINGS_SQL):] + """,
pc AS (SELECT p.id_a, p.id_b, coalesce(sum(x.c * y.c), 0) AS d FROM positives p
       LEFT JOIN hb x ON x.posting_id = p.id_a LEFT JOIN hb y ON y.posting_id = p.id_b AND y.bucket = x.bucket
       GROUP BY 1, 2)
SELECT pc.id_a, pc.id_b, round(d / (na.n * nb.n), 6) AS sim FROM pc JOIN hn na ON na.posting_id = pc.id_a
JOIN hn nb ON nb.posting_id = pc.id_b WHERE d / (na.n * nb.n) < 0.8""")
def q_e21r(spark, sf):
    """E21 (reverse): members of one identity group whose titles are not similar (chained pairs,
    cosine below the 0.8 similarity bar the forward query uses)."""
    v = hashed_title_vectors(spark, sf)
    c = sim.pair_cosine_dense(_pos(spark, sf).select("id_a", "id_b"), v, id_col="posting_id")
    return c.filter(F.col("cosine") < 0.8).select("id_a", "id_b", r6("cosine").alias("sim"))
