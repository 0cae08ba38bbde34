"""What tables of many rows in small files ask of joins, sweeps and texts: nothing large is broadcast, no row is compared with a whole grid, no word leaves its text."""

import re

from pyspark.sql import functions as F

from tessera.operators import evaluate as ev
from tessera.operators import pairs as pr
from tessera.operators import similarity as sim
from tessera.plans import QUERIES, standins


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_members_are_not_broadcast(spark, tmp_path):
    spark.createDataFrame([(i, f"g{i % 9}") for i in range(90)], "id long, g string").write.parquet(f"{tmp_path}/t")
    d = spark.read.parquet(f"{tmp_path}/t")
    p = pr.positive_pairs(d, "id", "g")
    assert not re.search(r"BroadcastHashJoin \[__g#\d+, __rn#", plan(p))
    assert p.count() == 81
    n = pr.negative_pairs(d, "id", "g", 50)
    assert n.count() == 50


def test_shared_terms_are_not_broadcast_to_the_pairs(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "id_a long, id_b long")
    vecs = spark.createDataFrame([(1, "x", 1.0), (2, "x", 0.6), (2, "y", 0.8), (3, "y", 1.0)], "id long, term string, weight double")
    c = sim.pair_cosine_sparse(pairs, vecs)
    assert not re.search(r"BroadcastHashJoin \[id_a.* LeftOuter", plan(c))
    assert {r.id_b: r.cosine for r in c.collect()} == {2: 0.6, 3: 0.0}


def test_worst_errors_go_to_the_titles(spark):
    p = plan(QUERIES["V19_pair_worst_errors_with_titles"](spark, "/root/testdata/sf0.001"))
    joins = re.findall(r"BroadcastHashJoin \[(?:posting_id|id_a|id_b|p_partkey)#\d+L?\].*?(BuildLeft|BuildRight)", p)
    assert joins == ["BuildRight", "BuildRight"]


def test_tables_of_many_rows_are_merged(spark, monkeypatch):
    monkeypatch.setattr(standins, "LOOKUP_ROWS", 0)
    assert "BroadcastHashJoin" not in plan(standins.click_rows(spark, "/root/testdata/sf0.001"))


def test_a_row_is_not_compared_with_every_threshold(spark):
    rows = [(0.05, 1), (0.0499, 0), (0.1, 0), (0.95, 1), (None, 1), (float("nan"), 0), (0.07, 1)]
    grid = list(range(95, 4, -1))
    d = ev.threshold_sweep(spark.createDataFrame(rows, "score double, label int"), grid)
    assert "lambda" not in plan(d.select("tp")).split("HashAggregate")[-1]
    got = {r.g: (r.tp, r.fp, r.fn, r.tn) for r in d.collect()}
    assert sorted(got) == sorted(grid)
    for g, counts in got.items():
        hit = [s is not None and (s != s or s >= g / 100.0) for s, _ in rows]
        assert counts == tuple(sum(h is want and y == of for h, (_, y) in zip(hit, rows)) for want, of in ((True, 1), (True, 0), (False, 1), (False, 0)))


def test_bigrams_of_a_text_stay_with_it(spark, tmp_path):
    words = [f"w{i}" for i in range(40)]
    words[9] += "."
    words[22] += "!"
    rows = [(1, " ".join(words)), (2, "one"), (3, " "), (4, None), (None, "a b c d"), (5, "a  b\nc"), (6, "x x. y"), (6, "x x. y")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    d = QUERIES["G12_faithfulness_bigram_support"](spark, str(tmp_path))
    p = plan(d)
    assert "Join" not in p and "Generate" not in p and p.count("Exchange hashpartitioning") == 1
    # the copies of 6 count as one text in which each place holds two words, as rows of one group do
    assert {r.doc_id: (r.n_sentences, r.n_supported) for r in d.collect()} == {1: (3, 3), 5: (1, 1), 6: (1, 1)}
