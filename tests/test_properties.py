"""Property and hand-case tests of the operators (no oracle needed)."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import SF_SMALL
from tessera.functions.exprs import md5_order
from tessera.functions.skew import dense_index, group_rank, prefix_sums, previous_in_group, running_in_group, top_k_per_key
from tessera.operators import evaluate as ev
from tessera.operators import features as fe
from tessera.operators import pairs as pr
from tessera.operators import recommend as rec
from tessera.operators import similarity as sim
from tessera.operators import splits
from tessera.operators import textmetrics as tm
from tessera.plans.standins import listings, ratings
from tessera.sources.tables import table


def _skewed(spark, n=3000):
    # one key holds a third of the rows
    return spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
                                 (F.col("id") * 7919 % 1000).alias("v"))


@pytest.mark.parametrize("slice_rows", [50000, 40, 3])
def test_group_rank_equals_window(spark, monkeypatch, slice_rows):
    monkeypatch.setattr("tessera.functions.skew.SLICE_ROWS", slice_rows)
    d = _skewed(spark).withColumn("o", md5_order(1, "id"))
    got = {(r.id, r.rn, r.n) for r in group_rank(d, "k", "o").collect()}
    w = Window.partitionBy("k").orderBy("o")
    want = {(r.id, r.rn, r.n) for r in d.select("id", F.row_number().over(w).alias("rn"),
                                                  F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n")).collect()}
    assert got == want
    whole = Window.orderBy("o")
    assert {(r.id, r.rn, r.n) for r in group_rank(d, [], "o").collect()} == {(r.id, r.rn, 3000) for r in d.select("id", F.row_number().over(whole).alias("rn")).collect()}


def test_salted_left_join_equals_plain(spark):
    from tessera.functions.skew import salted_left_join
    d = _skewed(spark)
    right = spark.createDataFrame([(0, "a"), (7, "b"), (99, "c")], "k long, w string")
    got = sorted((r.id, r.k, r.w) for r in salted_left_join(d, right, "k", ["id"], threshold=100, salts=5).select("id", "k", "w").collect())
    assert got == sorted((r.id, r.k, r.w) for r in d.join(right, "k", "left").select("id", "k", "w").collect()) and len(got) == 3000


def test_top_k_per_key_equals_window(spark):
    d = _skewed(spark)
    got = {(r.k, r.id) for r in top_k_per_key(d, "k", [F.desc("v"), F.col("id")], 3).collect()}
    w = Window.partitionBy("k").orderBy(F.desc("v"), "id")
    want = {(r.k, r.id) for r in d.withColumn("r", F.row_number().over(w)).filter("r <= 3").collect()}
    assert got == want


def test_dense_index_is_a_permutation_in_order(spark):
    d = _skewed(spark).withColumn("o", md5_order(3, "id"))
    rows = sorted(dense_index(d, ["o"], "ix").select("o", "ix").collect(), key=lambda r: r.ix)
    assert [r.ix for r in rows] == list(range(len(rows)))
    assert [r.o for r in rows] == sorted(r.o for r in rows)


def test_prefix_sums_equal_running_sum(spark):
    d = _skewed(spark).groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    got = {r.v: r.below_c for r in prefix_sums(d, "v", ["c"]).collect()}
    run, want = 0, {}
    for r in sorted(d.collect(), key=lambda r: r.v):
        want[r.v] = run
        run += r.c
    assert got == want


def test_split_sizes_and_disjoint(spark):
    r = ratings(spark, SF_SMALL)
    s = splits.split_per_group(r, "user_id", ["user_id", "item_id"], 0.2, 42)
    per = s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("split") == "test").cast("int")).alias("t"))
    for row in per.collect():
        assert row.t == (row.n + 4) // 5
    assert s.count() == r.count()


def test_group_split_is_group_disjoint(spark):
    d = table(spark, SF_SMALL, "documents").select("doc_id", "source")
    s = splits.split_by_group(d, "source", {"train": 0.7, "validation": 0.15, "test": 0.15})
    assert splits.leakage_report(s, "source").count() == 0


def test_cosine_symmetric_and_bounded(spark):
    r = ratings(spark, SF_SMALL)
    s = sim.user_cosine(r, "user_id", "item_id", "rating").collect()
    d = {(x.a, x.b): x.sim for x in s}
    for (a, b), v in d.items():
        assert -1e-12 <= v <= 1 + 1e-12
        assert abs(v - d[(b, a)]) < 1e-12


def test_neighbour_prediction_hand_case(spark):
    # (0.9 * 4 + 0.8 * 5) / 1.7 = 4.47
    test = spark.createDataFrame([(1, 10, 4.0)], "user long, item long, rating double")
    train = spark.createDataFrame([(2, 10, 4.0), (3, 10, 5.0)], "user long, item long, rating double")
    neigh = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.8)], "a long, b long, sim double")
    p = rec.predict_neighbour(test, train, neigh).collect()[0].prediction
    assert abs(p - 7.6 / 1.7) < 1e-12 and round(p, 2) == 4.47


def test_confusion_hand_case(spark):
    conf = spark.createDataFrame([(16603, 148, 644, 16106)], "tn long, fp long, fn long, tp long")
    r = ev.with_rates(conf).collect()[0]
    assert round(r.precision, 4) == 0.9909 and round(r.recall, 4) == 0.9616 and round(r.f1, 4) == 0.9760


def test_f1_two_routes(spark):
    from tessera.plans.evaluation import _preds
    d = _preds(spark, SF_SMALL)
    a = ev.classification_report(d).collect()[0]
    sw = ev.threshold_sweep(d, [30]).collect()[0]
    assert abs(a.f1 - sw.f1) < 1e-12


def test_average_precision_perfect_ranking(spark):
    d = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.3), (0, 0.1)], "label int, score double")
    assert abs(ev.average_precision(d).collect()[0][0] - 1.0) < 1e-12
    assert abs(ev.roc_auc(d).collect()[0][0] - 1.0) < 1e-12


def test_roc_auc_ties_half(spark):
    d = spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, score double")
    assert ev.roc_auc(d).collect()[0][0] == 0.5


def test_bleu_identity(spark):
    d = spark.createDataFrame([(1, "the cat sat on the mat today".split())], "k int, t array<string>")
    d = d.withColumn("hyp", F.col("t")).withColumn("ref", F.col("t"))
    assert abs(tm.corpus_bleu(d, ["k"]).collect()[0].bleu - 1.0) < 1e-12


def test_pairwise_interactions_count(spark):
    cols = [f"f{i}" for i in range(27)]
    d = spark.range(1).select(*[F.array(F.lit(1.0), F.lit(2.0)).alias(c) for c in cols])
    assert len(fe.pairwise_interactions(d, cols).collect()[0].interactions) == 351


def test_median_is_mean_of_middle_pair(spark):
    d = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double")
    assert fe.fit_median(d, ["x"]).collect()[0].x == 3.0


def test_negative_pairs_distinct_and_cross_group(spark):
    lst = listings(spark, SF_SMALL)
    neg = pr.negative_pairs(lst, "posting_id", "label_group", 100).collect()
    g = {r.posting_id: r.label_group for r in lst.collect()}
    keys = {(r.id_a, r.id_b) for r in neg}
    assert len(keys) == len(neg) == 100
    assert all(a < b and g[a] != g[b] for a, b in keys)


def test_positive_pairs_connect_groups(spark):
    lst = listings(spark, SF_SMALL)
    pos = pr.positive_pairs(lst, "posting_id", "label_group")
    sizes = lst.groupBy("label_group").count().collect()
    assert pos.count() == sum(r["count"] - 1 for r in sizes)
    comps = pr.connected_groups(pos).collect()
    # every multi-member group is exactly one component
    g = {r.posting_id: r.label_group for r in lst.collect()}
    by_comp = {}
    for r in comps:
        by_comp.setdefault(r.component, set()).add(g[r.node])
    assert all(len(v) == 1 for v in by_comp.values())


def test_knn_matches_brute_force(spark):
    import numpy as np
    e = table(spark, SF_SMALL, "embeddings").filter("vec_id < 120")  # a fixed small fixture
    rows = e.collect()
    got = {(r.a, r.b) for r in sim.knn_join(e, 3, "vec_id", "embedding", block_rows=50).collect()}
    ids = [r.vec_id for r in rows]
    m = np.array([r.embedding for r in rows], dtype=np.float64)
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = m @ m.T
    want = set()
    for i, a in enumerate(ids):
        cand = sorted(((-round(s[i, j], 9), ids[j]) for j in range(len(ids)) if j != i))[:3]
        want |= {(a, b) for _, b in cand}
    assert got == want


def test_mf_sgd_learns_planted_factors(spark):
    import numpy as np
    rng = np.random.default_rng(8)
    U, V = rng.normal(size=(120, 3)), rng.normal(size=(90, 3))
    rows = [(int(u), int(i), float(U[u] @ V[i] * 2 + 3 + rng.normal() * 0.1), bool(rng.random() < 0.2))
            for u in range(120) for i in range(90) if rng.random() < 0.4 or u == 0]  # user 0 rates everything
    d = spark.createDataFrame(rows, "u long, i long, r double, test boolean")
    runs = [rec.mf_sgd(d.filter("NOT test"), 6, 0.02, 12, 0.02, True, user="u", item="i", rating="r", blocks=3) for _ in range(2)]
    (fu, fv, trace, mean), again = runs[0], runs[1]
    mse = [r.mse for r in trace.orderBy("epoch").collect()]
    assert mse == [r.mse for r in again[2].orderBy("epoch").collect()]  # reruns agree
    assert mse[9] < mse[0] / 2
    assert fu.count() == 120 and fv.count() == 90
    p = rec.predict_factors(d.filter("test"), fu, fv, "u", "i", mean=mean).collect()
    rmse = math.sqrt(sum((r.r - r.prediction) ** 2 for r in p) / len(p))
    assert rmse < 0.5 * math.sqrt(sum((r.r - mean) ** 2 for r in p) / len(p))
    # an empty table gives no factors and a trace of zeros
    none = rec.mf_sgd(d.limit(0), 2, 0.1, 1, user="u", item="i", rating="r")
    assert none[0].collect() == [] and [r.mse for r in none[2].collect()] == [0.0]


def test_pick_best_patience(spark):
    h = spark.createDataFrame([(1, 0.5), (2, 0.6), (3, 0.55), (4, 0.58), (5, 0.59), (6, 0.7)], "epoch int, value double")
    r = rec.pick_best(h, "value", "max", 3).collect()[0]
    assert r.best_epoch == 2 and r.stop_epoch == 5


def test_running_in_group_equals_window(spark):
    d = _skewed(spark).repartition(6)
    got = {(r.id, r.rn, r.rs) for r in running_in_group(running_in_group(d, "k", [F.col("v"), F.col("id")], out="rn"),
                                                           "k", [F.col("v"), F.col("id")], "v", "rs").collect()}
    w = Window.partitionBy("k").orderBy("v", "id")
    want = {(r.id, r.rn, r.rs) for r in d.select("id", F.row_number().over(w).alias("rn"),
                                                  F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs")).collect()}
    assert got == want
    prev = {r.id: r.prev_id for r in previous_in_group(running_in_group(d, "k", [F.col("v"), F.col("id")], out="rn"),
                                                       "k", "rn", ["id"]).collect()}
    lag = {r.id: r.p for r in d.select("id", F.lag("id").over(w).alias("p")).collect()}
    assert prev == lag


def test_exact_quantiles_match_percentile(spark):
    from tessera.functions.skew import exact_quantiles
    d = _skewed(spark)
    got = {r.k: (r.q0, r.q1, r.q2) for r in exact_quantiles(d, "v", [0.1, 0.5, 0.9], by=["k"]).collect()}
    want = {r.k: tuple(r.q) for r in d.groupBy("k").agg(F.percentile("v", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("q")).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert all(abs(a - b) < 1e-9 for a, b in zip(got[k], want[k]))


def test_salted_self_join_equals_plain_join(spark):
    from tessera.functions.skew import salted_self_join
    d = _skewed(spark, 600)
    left = d.select(F.col("id").alias("a"), "k", F.col("v").alias("va"))
    right = d.select(F.col("id").alias("b"), "k", F.col("v").alias("vb"))
    got = sorted(tuple(r) for r in salted_self_join(left, right, "k", "a", threshold=50, salts=4).select("a", "b").collect())
    want = sorted(tuple(r) for r in left.join(right, "k").select("a", "b").collect())
    assert got == want


def test_connected_groups_follow_long_paths(spark):
    from tessera.operators import pairs as pr
    path = [(i, i + 1) for i in range(500)] + [(1000, 1001), (1002, 1001), (2000, 2000)]
    got = {r.node: r.component for r in pr.connected_groups(spark.createDataFrame(path, "id_a long, id_b long")).collect()}
    assert got == {**{i: 0 for i in range(501)}, 1000: 1000, 1001: 1000, 1002: 1000, 2000: 2000}


def test_sliced_sweep_gives_every_slice_every_threshold(spark):
    from tessera.operators import evaluate as ev
    rows = [("a", 1, 0.9), ("a", 0, 0.4), ("low", 1, 0.3), ("low", 0, 0.1), (None, 1, 0.6), (None, 0, 0.9)]
    d = spark.createDataFrame(rows, "slice string, label int, score double")
    got = {(r.slice, r.threshold): (r.tp, r.fp, r.fn, r.tn) for r in ev.threshold_sweep(d, [20, 50, 80], by=["slice"]).collect()}
    want = {(s, t): tuple(sum(x == s and y == k and (v >= t) == p for x, y, v in rows) for k, p in ((1, True), (0, True), (1, False), (0, False)))
            for s in ("a", "low", None) for t in (0.2, 0.5, 0.8)}
    assert got == want
    with pytest.raises(ValueError):
        ev.threshold_sweep(d.withColumnRenamed("slice", "g"), [50], by=["g"])


def test_queries_without_hits_get_a_none_row(spark):
    from tessera.operators import graph as gr
    top = spark.createDataFrame([(1, "s1", 0.9), (2, "s2", 0.1)], "query long, sid string, score double")
    q = spark.createDataFrame([(1,), (2,), (3,)], "query long")
    assert {(r.query, r.status) for r in gr.answer_passages(top, q, "query", 0.3).collect()} == {(1, "answer"), (2, "none"), (3, "none")}


def test_negative_pairs_reach_n_beside_a_dominant_group(spark):
    from tessera.operators import pairs as pr
    rows = [(i, "big" if i < 180 else f"g{i}") for i in range(200)]
    d = spark.createDataFrame(rows, "id long, grp string")
    possible = 180 * 20 + 20 * 19 // 2
    for n in (100, 2000, possible + 50):
        got = {(r.id_a, r.id_b) for r in pr.negative_pairs(d, "id", "grp", n).collect()}
        assert len(got) == min(n, possible) and all(rows[a][1] != rows[b][1] and a < b for a, b in got)


def test_containment_of_short_and_mid_word_passages(spark):
    from tessera.operators import graph as gr
    docs = spark.createDataFrame([(1, "alpha beta  gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "xbeta gamma deltay"), (3, "none")], "doc long, t string")
    p = spark.createDataFrame([(10, "beta gamma delta"), (11, "ta gamma del"), (12, "pha be"), (13, "one"), (14, " "), (15, "lpha beta gamma delta epsilon zeta eta theta iota kappa lam"), (16, "beta delta gamma")],
                              "pid long, t string")
    got = {(r.pid, r.doc) for r in gr.containment_truth(p, "pid", "t", docs, "doc", "t").collect()}
    assert got == {(10, 1), (10, 2), (11, 1), (11, 2), (12, 1), (13, 3), (15, 1)}


def test_speaker_tags_are_words_of_their_own(spark):
    from tessera.operators import text as tx
    d = spark.createDataFrame([("hi<usr1>there",)], "t string")
    assert d.select(tx.tokenize_dialogue("t")).first()[0] == ["hi", "usr1speaker", "there"]
