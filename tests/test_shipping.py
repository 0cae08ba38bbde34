"""What joins and block products send: nothing large by broadcast, by a key alone or by rating, and every row asks."""

import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from tessera.functions import skew
from tessera.operators import recommend as rec
from tessera.operators import similarity as sim
from tessera.operators import splits
from tessera.operators import text as tx
from tessera.plans import QUERIES
from tessera.session import cut_lineage


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def titles(spark, tmp_path):
    spark.createDataFrame([(i, f"red bolt no {i % 7} of brand {i % 5}") for i in range(200)], "id long, title string").write.parquet(f"{tmp_path}/t")
    return spark.read.parquet(f"{tmp_path}/t")


def test_terms_cut_from_a_small_file_are_not_broadcast(spark, tmp_path):
    d = tx.tfidf(tx.ngram_rows(titles(spark, tmp_path), ["id"], "title", "char", 3, 5), "id")
    assert not re.search(r"BroadcastHashJoin \[term.* Inner", plan(d))
    pairs = spark.createDataFrame([(1, 2), (3, 4), (1, 8)], "id_a long, id_b long")
    c = sim.pair_cosine_sparse(pairs, cut_lineage(d))
    assert not re.search(r"BroadcastHashJoin \[id_[ab].* Inner", plan(c))
    got = {(r.id_a, r.id_b): r.cosine for r in c.collect()}
    assert len(got) == 3 and all(0 < x < 1 + 1e-9 for x in got.values())


def test_vectors_made_from_a_small_file_are_not_broadcast(spark, tmp_path):
    v = cut_lineage(titles(spark, tmp_path).select("id", F.array(F.col("id") % 3 + 1.0, F.lit(2.0)).alias("embedding")))
    c = sim.pair_cosine_dense(spark.createDataFrame([(1, 2), (3, 6)], "id_a long, id_b long"), v)
    assert "BroadcastHashJoin" not in plan(c)
    got = {r.id_a: r.cosine for r in c.collect()}
    assert math.isclose(got[3], 1.0) and math.isclose(got[1], 10 / math.sqrt(8 * 13))


@pytest.mark.parametrize("slice_rows", [10, 100_000])
def test_group_rank_shuffles_no_group_by_its_key_alone(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(skew, "SLICE_ROWS", slice_rows)
    rows = [(i, "hot" if i < 300 else f"g{i % 9}" if i < 390 else None) for i in range(400)]
    d = spark.createDataFrame(rows, "id long, g string").withColumn("o", F.md5(F.col("id").cast("string")))
    r = skew.group_rank(d, "g", "o")
    assert "SortMergeJoin" not in plan(r)
    want = d.filter("g is not null").selectExpr("id", "g", "o", "row_number() over (partition by g order by o) rn", "count(*) over (partition by g) n")
    assert sorted(map(tuple, r.select("id", "g", "o", "rn", "n").collect())) == sorted(map(tuple, want.collect()))


def test_top_k_cosine_ships_entities_and_sums_in_steps(spark, monkeypatch):
    for name, value in (("BLOCK_RATINGS", 200), ("PIECE_RATINGS", 3), ("SPARSE_STEP", 40)):
        monkeypatch.setattr(sim, name, value)
    rng = random.Random(5)
    have = {(u, i): float(rng.randint(1, 5)) for u in range(80) for i in range(30) if rng.random() < (0.9 if u == 0 or i == 0 else 0.2)}
    d = sim.top_k_cosine(spark.createDataFrame([(u, i, r) for (u, i), r in have.items()], "u long, i long, r double"), "u", "i", "r", 4)
    assert "Join" not in plan(d)
    norm = {u: math.sqrt(sum(r * r for (x, _), r in have.items() if x == u)) for u, _ in have}
    want = {}
    for a in norm:
        dots = {}
        for (b, i), r in have.items():
            if b != a and (a, i) in have:
                dots[b] = dots.get(b, 0) + have[a, i] / norm[a] * (r / norm[b])
        for n, (s, b) in enumerate(sorted((-round(s, 9), b) for b, s in dots.items())[:4], 1):
            want[a, n] = (b, -s)
    got = {(r.a, r["rank"]): (r.b, round(r.sim, 9)) for r in d.collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(math.isclose(got[k][1], want[k][1], abs_tol=1e-8) for k in want)


def test_factor_states_replace_each_other(spark):
    at = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    size = lambda: sum(os.path.getsize(f"{p}/{f}") for p, _, fs in os.walk(at) for f in fs)
    d = spark.createDataFrame([(u, i, float((u + i) % 5)) for u in range(400) for i in range(3)], "u long, i long, r double")
    grown = []
    for epochs in (1, 6):
        before = size()
        kept = rec.mf_sgd(d, 20, 0.001, epochs, user="u", item="i", rating="r")
        grown.append(size() - before)
        assert kept[0].count() == 400
    assert grown[1] < 1.3 * grown[0]


def test_every_row_asks_for_its_neighbours(spark):
    ids = {r.vec_id for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id").collect()}
    for name, k in (("N07_knn_top5_embeddings", 5), ("J12_hard_negatives_top3", 3)):
        got = [r.a for r in QUERIES[name](spark, SF_SMALL).collect()]
        assert set(got) == ids and len(got) == k * len(ids)


def test_every_title_is_looked_up(spark):
    assert any(r.a % 20 for r in QUERIES["E21_similar_title_conflicts"](spark, SF_SMALL).collect())


def test_recall_counts_every_vector(spark):
    import numpy as np
    rows = sorted((r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect())
    x = np.array([r[2] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(x @ x.T, 9)
    np.fill_diagonal(s, -np.inf)
    best = np.argsort(-s, axis=1, kind="stable")[:, :10]
    label = np.array([r[1] for r in rows])
    hit = (label[best] == label[:, None])
    r = QUERIES["V16_same_label_recall_at_k"](spark, SF_SMALL).first()
    for k in (1, 5, 10):
        assert math.isclose(r[f"recall_at_{k}"], hit[:, :k].any(1).mean(), abs_tol=2e-6)


def test_levels_of_a_cell_step_like_its_batches(spark):
    import numpy as np
    rng = random.Random(3)
    have = sorted({(rng.randrange(1500), 0 if rng.random() < 0.1 else rng.randrange(1500)) for _ in range(20_000)})
    d = spark.createDataFrame([(u, i, float(rng.randint(1, 5))) for u, i in have], "u long, i long, r double")
    k, lr, reg = 4, 0.05, 0.1
    U, V, trace, _ = rec.mf_sgd(d, k, lr, 2, reg, user="u", item="i", rating="r", blocks=1)
    fu, fv = ({r[0]: np.array(r.f) for r in rec.init_factors(d, c, k, s).collect()} for c, s in (("u", 42), ("i", 43)))
    rows = d.withColumn("o", F.md5(F.concat_ws("|", F.lit("42"), "u", "i"))).orderBy("o").collect()
    mse = []
    for _ in range(2):
        sse = 0.0
        for at in range(0, len(rows), rec.BATCH):
            batch = rows[at:at + rec.BATCH]
            now = [(fu[r.u].copy(), fv[r.i].copy()) for r in batch]
            for r, (x, y) in zip(batch, now):
                e = r.r - x @ y
                sse += e * e
                fu[r.u] += lr * (e * y - reg * x)
                fv[r.i] += lr * (e * x - reg * y)
        mse.append(sse / len(rows))
    assert np.allclose([r.mse for r in trace.orderBy("epoch").collect()], mse, rtol=1e-9)
    for got, want in ((U, fu), (V, fv)):
        got = {r[0]: r.f for r in got.collect()}
        assert got.keys() == want.keys() and all(np.allclose(got[x], want[x], rtol=1e-8, atol=1e-10) for x in want)
    a, b = np.array([r.u for r in rows]), np.array([0 if r.i == 0 and n % 2 else r.i for n, r in enumerate(rows)])
    rare = b != 0
    assert rec._levels(a[rare], b[rare], 1500, 1500).max() < 0.4 * rare.sum() / rec.BATCH  # far fewer steps than batches


@pytest.mark.parametrize("slice_rows", [20, 10_000])
def test_stratified_split_shuffles_no_row(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(skew, "SLICE_ROWS", slice_rows)
    # labels a and b are large, c is small; keys come twice (an odd number of test rows cuts a pair), one key ten times, some are null
    rows = [(i // 2 if i < 400 else 500 if i < 410 else None if i < 415 else i, "a" if i < 300 else "b" if i < 690 else "c" if i < 700 else None, i) for i in range(710)]
    d = cut_lineage(spark.createDataFrame(rows, "k long, g string, x long"))
    s = splits.split_stratified(d, "g", ["k"], 0.2, 42)
    assert "Exchange hashpartitioning" not in plan(s)
    got = s.collect()
    assert sorted(r.x for r in got) == list(range(700))
    hexed = {k: h for k, h in d.select("k", F.md5(F.concat_ws("|", F.lit("42"), F.col("k").cast("string")))).distinct().collect()}
    for g, n in (("a", 300), ("b", 390), ("c", 10)):
        mine = [r for r in got if r.g == g]
        test = sorted(hexed[r.k] for r in mine if r.split == "test")
        assert len(mine) == n and test == sorted(hexed[r.k] for r in mine)[:-(-n // 5)]
    assert sorted(map(str, s.collect())) == sorted(map(str, got))


def test_blocks_meet_in_waves_and_keep_the_best(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(u, i, float(rng.randint(1, 5))) for u in range(90) for i in range(25) if u == 0 or rng.random() < 0.25]
    d = spark.createDataFrame(rows, "u long, i long, r double")
    want = [(r.a, r.b, r["rank"], round(r.sim, 9)) for r in sim.top_k_cosine(d, "u", "i", "r", 3).collect()]
    for name, value in (("BLOCK_RATINGS", 60), ("MIN_BLOCKS", 1), ("WAVE_BLOCKS", 3)):
        monkeypatch.setattr(sim, name, value)
    waves = []
    monkeypatch.setattr(sim, "drop_stored", lambda spark, path, drop=sim.drop_stored: (waves.append(path), drop(spark, path)))
    got = sim.top_k_cosine(d, "u", "i", "r", 3)
    assert "Exchange" not in plan(got) and len(waves) > 2  # the states before the last one and the entities are gone
    assert sorted((r.a, r.b, r["rank"], round(r.sim, 9)) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("gathered", [30, 10_000])
def test_recommendations_are_summed_where_ratings_arrive(spark, monkeypatch, gathered):
    monkeypatch.setattr(rec, "PIECE_RATINGS", 7)
    monkeypatch.setattr(rec, "GATHERED", gathered)
    rng = random.Random(4)
    have = {(u, i): float(rng.randint(1, 5)) for u in range(30) for i in range(40) if u == 3 or rng.random() < 0.3}
    near = {u: rng.sample([v for v in range(30) if v != u], 3) for u in range(29)}
    near = {(u, v): (j + 1) / 4 for u, vs in near.items() for j, v in enumerate(vs)}
    train = spark.createDataFrame([*((u, i, r) for (u, i), r in have.items()), (5, None, 1.0), (5, 39, None), (None, 1, 2.0)], "u long, i long, r double")
    neigh = spark.createDataFrame([(a, b, s) for (a, b), s in near.items()], "a long, b long, sim double")
    d = rec.recommend(train, neigh, 4, "u", "i", "r")
    assert not re.search(r"Exchange hashpartitioning\(u#\d+L, i#", plan(d))
    # a null item is never seen, a null rating counts in the divisor and as seen
    rows = [(r.u, r.i, r.r) for r in train.collect() if r.u is not None]
    seen = {(u, i) for u, i, _ in rows if i is not None}
    want = {}
    for u in range(29):
        sums = {}
        for v, i, r in rows:
            if (u, v) in near and (u, i) not in seen:
                s = sums.setdefault(i, [None, 0.0])
                s[1] += near[u, v]
                if r is not None:
                    s[0] = (s[0] or 0.0) + near[u, v] * r
        best = sorted((-round(s[0] / s[1], 9), -1 if i is None else i) for i, s in sums.items() if s[0] is not None)[:4]
        want |= {(u, n): (None if i < 0 else i, -s) for n, (s, i) in enumerate(best, 1)}
    got = {(r.u, r["rank"]): (r.i, round(r.score, 9)) for r in d.collect()}
    assert got == want


def test_fm_rows_are_not_spilled_to_local_disks(spark, monkeypatch):
    from pyspark.ml.classification import FMClassifier
    from tessera.operators import models as md
    d = spark.createDataFrame([(i, float(i % 2), i % 7 / 7.0, f"c{i % 3}") for i in range(60)], "id long, label double, x double, c string")
    d = md.assemble_features(d, ["x"], ["c"], 8)
    levels = []
    monkeypatch.setattr(FMClassifier, "fit", lambda self, rows, fit=FMClassifier.fit: (levels.append(rows.storageLevel), fit(self, rows))[1])
    s = md.ctr_fm(d, d, ["id"], "label", 2, 3)
    assert s.count() == 60 and [(x.useMemory, x.useDisk) for x in levels] == [(True, False)]
