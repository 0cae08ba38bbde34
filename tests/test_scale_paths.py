"""Paths that only large or lopsided inputs take, against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions import skew
from tessera.operators import causal as ca
from tessera.operators import graph as gr
from tessera.operators import pairs as pr


@pytest.mark.parametrize("wanted", [30, 150, 10_000])
def test_negative_pairs_with_a_dominant_group(spark, wanted):
    rows = [(i, "hot" if i < 60 else f"g{i % 4}") for i in range(70)] + [(99, None)]
    got = [(r.id_a, r.id_b) for r in pr.negative_pairs(spark.createDataFrame(rows, "id long, g string"), "id", "g", wanted).collect()]
    group = dict(rows)
    every = {(a, b) for a in range(70) for b in range(a + 1, 70) if group[a] != group[b]}
    assert len(got) == len(set(got)) == min(wanted, len(every)) and set(got) <= every


def test_matching_over_many_scores_and_partitions(spark):
    rng = random.Random(6)
    rows = [(i, int(rng.random() < 0.3), rng.choice([rng.random(), round(rng.random(), 1)])) for i in range(2000)]
    rows = [r for r in rows if r[1] == 0 or not 0.4 < r[2] < 0.47] + [(5000 + i, 1, 0.95 + i / 1000) for i in range(40)]
    d = spark.createDataFrame(rows, "id long, t int, e double")
    got = {(r.id, r.control_id, round(r.distance, 9)) for r in ca.psm_matches(d, "id", caliper=0.02).collect()}
    ctrl = [(e, i) for i, t, e in rows if t == 0]
    want = set()
    for i, t, e in rows:
        if t:
            dist, c = min((abs(e - ce), ci) for ce, ci in ctrl)
            if dist <= 0.02:
                want.add((i, c, round(dist, 9)))
    assert {(i, x) for i, _, x in got} == {(i, x) for i, _, x in want}
    assert len(got - want) <= 2  # a tie of two distances within rounding may go either way
    assert ca.psm_matches(d.filter("t = 1"), "id").collect() == [] and ca.psm_matches(d.limit(0), "id").collect() == []


def test_short_passages_are_found_inside_words(spark):
    docs = [(1, "the quick  brown fox"), (2, "brownish foxes"), (3, "a\tred\nfox"), (4, ""), (5, "ownfo"), (6, "kbrown foxtrot")]
    asked = [(1, "brown fox"), (2, "own"), (3, "k  brown f"), (4, "zzz"), (5, " "), (6, "d fox"), (7, "the quick brown fox"), (8, " fox"), (9, "x")]
    got = {(r.pid, r.doc) for r in gr.containment_truth(spark.createDataFrame(asked, "pid long, p string"), "pid", "p", spark.createDataFrame(docs, "doc long, t string"), "doc", "t").collect()}

    norm = lambda x: re.sub(r"\s+", " ", x)
    want = {(i, d) for i, p in asked for d, t in docs if norm(p).strip() and norm(p) in norm(t)}
    assert got == want and len(want) > 8


def test_two_hops_with_a_hub(spark):
    rng = random.Random(3)
    edges = {("hub", f"n{i:03}") for i in range(120)} | {tuple(sorted((f"n{rng.randrange(120):03}", f"m{rng.randrange(40)}"))) for _ in range(150)}
    ment = {(d, rng.choice(["hub", *[f"n{i:03}" for i in range(120)], *[f"m{i}" for i in range(40)]])) for d in range(60) for _ in range(4)}
    q = {(1, "hub"), (2, "n003"), (2, "m1"), (3, "unknown")}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for hops in (0, 1, 2, 3):
        want = {}
        for query in {x for x, _ in q}:
            seen, front = {e: 2.0 for x, e in q if x == query}, {e for x, e in q if x == query}
            for h in range(1, hops + 1):
                front = {n for e in front for n in near.get(e, ())} - set(seen)
                seen |= {e: 2.0 * 0.5 ** h for e in front}
            for d, e in ment:
                if e in seen:
                    want[query, d] = want.get((query, d), 0) + seen[e]
        got = gr.graph_retrieve(spark.createDataFrame(sorted(q), "query long, entity string"), spark.createDataFrame([(a, b, 1) for a, b in sorted(edges)], "a string, b string, weight long"),
                                spark.createDataFrame(sorted(ment), "doc_id long, entity string"), None, hops=hops)
        assert {(r["query"], r.doc_id): r.score for r in got.collect()} == want


@pytest.mark.parametrize("small", [100_000, 0])
def test_shingles_stay_unless_passages_are_many(spark, monkeypatch, small):
    monkeypatch.setattr(gr, "SMALL", small)
    words = [f"w{i}" for i in range(60)]
    docs = [(1, " ".join(words)), (2, " ".join(words[::-1])), (3, " ".join(words[5:40])), (4, None)]
    asked = [(10, " ".join(words[10:30])), (11, " ".join(words[2:9])), (12, "w9 w8 w7 w6"), (13, "w1 w3 w5 w7 w9")]
    got = gr.containment_truth(spark.createDataFrame(asked, "pid long, p string"), "pid", "p", spark.createDataFrame(docs, "doc long, t string"), "doc", "t")
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(shingle" not in p and ("hashpartitioning(__h" in p) == (not small)
    assert sorted((r.pid, r.doc) for r in got.collect()) == sorted((i, d) for i, x in asked for d, t in docs if t and x in t)


def test_queries_walk_as_bits_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    names = [f"n{i:02}" for i in range(50)]
    edges = sorted({tuple(sorted(rng.sample(names, 2))) for _ in range(70)} | {("hub", n) for n in names})
    ment = sorted({(d, rng.choice([*names, "hub"])) for d in range(80) for _ in range(3)}) + [(None, "hub"), (None, "n01")]
    q = sorted({(i, rng.choice(names)) for i in range(150) for _ in range(2)}) + [(None, "n03")]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for hops, block, small in ((1, 256, 100_000), (2, 70, 0)):
        monkeypatch.setattr(gr, "QUERIES_AT_ONCE", block)
        monkeypatch.setattr(gr, "SMALL", small)
        want = {}
        for query in {x for x, _ in q}:
            far = {e: 0 for x, e in q if x == query}
            for h in range(1, hops + 1):
                far |= {n: h for e in [e for e in far if far[e] == h - 1] for n in near.get(e, ()) if n not in far}
            for d, e in ment:
                if e in far:
                    want[query, d] = want.get((query, d), 0) + 2.0 * 0.5 ** far[e]
        frames = (spark.createDataFrame(q, "query long, entity string"), spark.createDataFrame([(a, b, 1) for a, b in edges], "a string, b string, weight long"), spark.createDataFrame(ment, "doc_id long, entity string"))
        by = {}
        for (query, d), s in want.items():
            by.setdefault(query, []).append((-s, d is not None, d or 0, d))
        top = {(query, d): (-s, r) for query, x in by.items() for r, (s, _, _, d) in enumerate(sorted(x)[:3], 1)}
        assert {(r["query"], r.doc_id): (r.score, r["rank"]) for r in gr.graph_retrieve(*frames, 3, hops=hops).collect()} == top
        pairs = sorted((x for x in want if None not in x), key=str)[::7]
        got = [((r["query"], r.doc_id), r.score) for r in gr.graph_retrieve(*frames, 1, hops=hops, among=spark.createDataFrame(pairs, "query long, doc_id long")).collect()]
        assert len(got) == len(dict(got)) and set(got) <= set(want.items())
        assert {*pairs, *(x for x, (_, r) in top.items() if r == 1)} <= set(dict(got))


@pytest.mark.parametrize("most", [0, 3, 1000])
def test_lookup_rows_are_met_by_broadcast_or_shuffle(spark, monkeypatch, most):
    monkeypatch.setattr(skew, "MEET_ROWS", most)
    left = [(i, f"k{math.isqrt(i)}") for i in range(200)] + [(900, "none"), (901, None)]
    uses = Counter(k for _, k in left)
    table = [(k, n, len(k) * 10 + n) for k, n in uses.items() if k not in ("none", None)]
    got = skew.meet(spark.createDataFrame(left, "i long, k string"), spark.createDataFrame(table, "k string, n long, v long"), "k", "n")
    p = got._jdf.queryExecution().executedPlan().toString()
    assert ("Broadcast" in p, "SortMergeJoin" in p) == (most > 0, most < 1000)
    assert sorted((r.i, r.k, r.v) for r in got.collect()) == sorted((i, k, v) for i, k in left for key, _, v in table if k == key)


@pytest.mark.parametrize("most", [0, 6, 1000])
def test_sentences_score_by_the_weights_of_their_document(spark, monkeypatch, most):
    monkeypatch.setattr(skew, "MEET_ROWS", most)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    rows = [(d, s, " ".join(rng.choices(words, k=rng.randrange(0, 9)))) for d in range(12) for s in range(rng.randrange(1, 6))]
    rows += [(3, 0, "w1 w2 w2"), (None, 0, "w1 w1 w5"), (None, 1, "w9")]  # a document that comes twice, one without a key
    tf, n, df = {}, Counter(), Counter()
    for d, _, x in rows:
        tf.setdefault(d, Counter()).update(x.split())
    for d in tf:
        df.update(tf[d].keys())
    size = sum(1 for d in tf if tf[d])
    idf = {t: math.log((1 + size) / (1 + c)) + 1 for t, c in df.items()}
    want = {}
    for d, s, x in rows:
        if d is not None and x:
            norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in tf[d].items()))
            want[d, s] = want.get((d, s), 0) + sum(tf[d][t] * idf[t] / norm for t in x.split())
            n[d, s] += len(x.split())
    got = gr.sentence_scores(spark.createDataFrame(rows, "doc_id long, sent_id int, sentence string"), "doc_id")
    assert {(r.doc_id, r.sent_id): round(r.score, 9) for r in got.collect()} == {x: round(v / n[x], 9) for x, v in want.items()}


def test_words_of_a_community_are_not_gathered(spark, monkeypatch):
    monkeypatch.setattr(skew, "MEET_ROWS", 4)
    labels = spark.createDataFrame([("A", "A"), ("B", "A"), ("C", "C")], "node string, label string")
    texts = {(1, 0): "A met B here. So it goes. A met B here.", (1, 1): "C is alone here.", (2, 0): "B again here. So it goes."}
    chunks = spark.createDataFrame([(*k, t) for k, t in texts.items()], "doc_id long, chunk_id int, chunk_text string")
    ment = spark.createDataFrame([(1, 0, "A"), (1, 0, "B"), (1, 1, "C"), (2, 0, "B")], "doc_id long, chunk_id int, entity string")
    v, own = gr.community_terms(labels, chunks, ment, ["doc_id", "chunk_id"])
    p = v._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in p
    tf = {"A": Counter(re.findall(r"\w{2,}", (texts[1, 0] + " " + texts[2, 0]).lower())), "C": Counter(re.findall(r"\w{2,}", texts[1, 1].lower()))}
    w = {x: {t: n * (math.log(3 / (1 + sum(t in c for c in tf.values()))) + 1) for t, n in tf[x].items()} for x in tf}
    want = {(x, t): round(v / math.sqrt(sum(y * y for y in w[x].values())), 9) for x in w for t, v in w[x].items()}
    assert {(r.label, r.term): round(r.weight, 9) for r in v.collect()} == want
    got = {r.label: (r.top_terms, r.best_sentences) for r in gr.community_digest(v, own).collect()}
    for x, some in (("A", ["A met B here.", "So it goes.", "B again here."]), ("C", ["C is alone here."])):
        score = lambda s: sum(want[x, t] for t in {*re.findall(r"\w{2,}", s.lower())}) / math.sqrt(len({*re.findall(r"\w{2,}", s.lower())}))
        assert got[x][0] == [t for _, t in sorted((-want[x, t], t) for t in w[x])][:5]
        assert got[x][1] == sorted(some, key=lambda s: (-round(score(s), 9), s))[:2]


def test_redundant_sentences_are_passed_over(spark):
    rows = [(1, 0, "alpha beta gamma delta", 9.0), (1, 1, "alpha beta gamma delta epsilon", 8.0), (1, 2, "something else here", 7.0), (1, 3, "something else there", 6.9), (1, 4, "one more", 1.0),
            (2, 0, "lone sentence", 1.0), (3, 0, "x", 1.0), (3, 1, "x", 2.0)]
    got = sorted((r.doc_id, r.sent_id) for r in gr.drop_redundant(spark.createDataFrame(rows, "doc_id long, sent_id int, sentence string, score double"), "doc_id", 3).collect())
    assert got == [(1, 0), (1, 2), (1, 3), (2, 0), (3, 0), (3, 1)]
