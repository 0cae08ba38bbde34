import math
import random

from conftest_sf import SF_SMALL
from helpers_llm import clashing, docs_of
from pyspark.sql import functions as F

from tessera.llm import quality as ql
from tessera.llm.common import read

LABELS = "doc_id long, quality int, toxic int"


def fixture(n=400):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        words = [rng.choice(["the", "cat", "sat", "on", "mats", "often"]) + str(rng.randrange(40)) for _ in range(rng.randrange(5, 200))]
        if bad:
            words = [w + "$$$" for w in words]
        rows.append((i, " ".join(words), rng.choice(["en", None]), "hot" if i % 3 else rng.choice(["a", "b", None])))
        if i % 2:
            labels.append((i, 0 if bad else 1, 0))
    rows += [(n, None, "en", "a"), (n + 1, "", None, None), (None, "some words", "en", "a"), (0, *rows[0][1:]), (n + 2, "long $$$ " * 30000, "en", "tiny"), (n + 3, "long words. " * 30000, "en", "tiny")]
    return rows, labels + [(None, 1, 0), (3, None, 0), (5, 7, 0)]


def strength(groups, prior):
    """Within-site over between-site variance by sums over plain lists."""
    n, k = sum(map(len, groups.values())), len(groups)
    if n <= k:
        return 10_000.0
    within = sum(sum((x - sum(g) / len(g)) ** 2 for x in g) for g in groups.values()) / (n - k)
    between = (sum(len(g) * (sum(g) / len(g) - prior(key)) ** 2 for key, g in groups.items()) - k * within) / n
    return 10_000.0 if between <= 0 else min(10_000.0, max(1.0, within / between))


def plain(docs):
    """(host posterior, path posterior, score) of (host, path, p_text) rows."""
    mean = sum(p for *_, p in docs) / len(docs)
    hosts, paths = {}, {}
    for h, w, p in docs:
        hosts.setdefault(h, []).append(p)
        paths.setdefault((h, w), []).append(p)
    kh = strength(hosts, lambda h: mean)
    kp = strength(paths, lambda hw: (sum(hosts[hw[0]]) + kh * mean) / (len(hosts[hw[0]]) + kh))
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    out = []
    for h, w, p in docs:
        host = (sum(hosts[h]) - p + kh * mean) / (len(hosts[h]) - 1 + kh)
        path = (sum(paths[h, w]) - p + kp * host) / (len(paths[h, w]) - 1 + kp)
        out.append((host, path, 1 / (1 + math.exp(-(logit(p) - logit(mean) + logit(path))))))
    return out, kh, kp


def sited(spark, rows, labels):
    """Scores with each row's own host and path beside them, in one order."""
    got = ql.score_documents(clashing(docs_of(spark, rows)), spark.createDataFrame(labels, LABELS)).collect()
    where = {}
    for r in docs_of(spark, rows).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "source", "lang").collect():
        where.setdefault((r.doc_id, r.h), (r.source, r.lang))
    return got, [(*where[r.doc_id, r.text_hash], r.p_text) for r in got]


def test_values_against_plain_sums(spark):
    rows, labels = fixture()
    got, docs = sited(spark, rows, labels)
    assert len(got) == len(rows)
    want, _, _ = plain(docs)
    for r, (host, path, score) in zip(got, want):
        assert math.isclose(r.host_posterior, host, rel_tol=1e-6, abs_tol=1e-9) and math.isclose(r.path_posterior, path, rel_tol=1e-6, abs_tol=1e-9)
        assert math.isclose(r.score, score, rel_tol=1e-6, abs_tol=1e-9) and r.keep == (r.score >= 0.5)


def test_sites_turn_decisions_and_sparse_ones_shrink(spark):
    rng = random.Random(12)
    rows, labels = [], []

    def add(host, path, n, bad):
        for _ in range(n):
            i = len(rows)
            # middling texts too, which only their site can tell
            kind = rng.random()
            marks = 1.0 if kind < bad else 0.5 if kind < bad + 0.25 else 0.0
            rows.append((i, " ".join(rng.choice(["the", "cat", "sat", "mats"]) + str(rng.randrange(30)) + ("$$" if rng.random() < marks else "") for _ in range(60)), path, host))
            if i % 3 and marks != 0.5:
                labels.append((i, int(marks == 0), 0))

    add("good", "a", 200, 0.02), add("good", "b", 100, 0.05), add("bad", "a", 200, 0.7), add("bad", "clean", 100, 0.02), add("mixed", "a", 150, 0.3)
    add("sparse-in-bad", "x", 2, 1.0), add("bad", "sparse", 2, 0.0), add("good", "sparse", 2, 1.0)
    for i in range(40):
        labels.append((i, 1, 0))
    got, docs = sited(spark, rows, labels)
    want, kh, kp = plain(docs)
    assert 1 <= kp < 100 and kh < 100  # the spread between sites is seen
    alone = [p >= 0.5 for *_, p in docs]
    turned = [i for i, r in enumerate(got) if r.keep != alone[i]]
    assert turned
    of = {r.doc_id: r for r in got}
    place = {i: (h, w) for i, _, w, h in rows}
    mean = lambda h, w: sum(of[i].path_posterior for i in of if place[i] == (h, w)) / sum(place[i] == (h, w) for i in of)
    assert mean("good", "a") > mean("mixed", "a") > mean("bad", "a") and mean("bad", "clean") > mean("bad", "a")
    assert mean("bad", "a") < mean("bad", "sparse") < mean("bad", "clean")  # two clean documents move a path only so far


def test_keep_good_keeps_all_columns(spark):
    rows, labels = fixture()
    d, y = clashing(docs_of(spark, rows)), spark.createDataFrame(labels, LABELS)
    kept = ql.keep_good(d, y)
    assert kept.columns == d.columns
    bad = {(r.doc_id, r.text_hash) for r in ql.score_documents(d, y).collect() if not r.keep}
    want = sum((r.doc_id, r.h) not in bad for r in docs_of(spark, rows).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect())
    assert bad and kept.count() == want


def test_accuracy_on_given_labels(spark):
    d, y = read(spark, SF_SMALL.replace("0.001", "0.01"), "documents"), read(spark, SF_SMALL.replace("0.001", "0.01"), "labels")
    # learn from the even documents, judge the odd ones
    got = ql.score_documents(d, y.where("doc_id % 2 = 0")).join(y.where("doc_id % 2 = 1"), "doc_id").collect()
    assert len(got) > 100 and sum(r.keep == (r.quality == 1) for r in got) / len(got) >= 0.97


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert ql.score_documents(docs_of(spark, []), none).collect() == [] and ql.keep_good(docs_of(spark, []), none).collect() == []
    flat = ql.score_documents(docs_of(spark, [(1, "a b"), (2, None)]), none).collect()
    assert [round(r.score, 6) for r in flat] == [0.5, 0.5] and all(r.keep for r in flat)
