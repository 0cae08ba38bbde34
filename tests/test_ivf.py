"""The inverted-file index against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import ivf


def exact(ids, x, asked, k):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in asked:
        s = np.round(x @ x[i], 9)
        out[ids[i]] = [int(ids[j]) for j in np.lexsort((ids, -s)) if j != i][:k]
    return out


@pytest.mark.parametrize("kind", ["clustered", "noise", "one hot cell"])
def test_recall_and_work(spark, monkeypatch, kind):
    rng = np.random.default_rng(4)
    n, dim = 3000, 24
    centres = rng.normal(size=(60, dim)) * 4
    x = rng.normal(size=(n, dim)) + (0 if kind == "noise" else centres[rng.integers(60, size=n)])
    if kind == "one hot cell":
        x[: n // 2] = centres[0] * 3 + rng.normal(size=(n // 2, dim))
        monkeypatch.setattr(ivf, "BLOCK_ROWS", 50)
    ids = np.arange(n) * 7
    d = spark.createDataFrame([(int(i), [float(v) for v in e]) for i, e in zip(ids, x)], "id long, embedding array<double>").repartition(4)
    index, table = ivf.build(d, 5)
    assert table.count() == n  # every row is indexed
    if kind == "one hot cell":
        sizes = [r["count"] for r in table.groupBy("cell", "block").count().collect()]
        assert max(sizes) < 100 and table.groupBy("cell").count().agg(F.max("count")).first()[0] > 100
    found, work = ivf.search(index, table, d.filter("id % 20 = 0"), 5)
    want = exact(ids, x, [i for i in range(n) if ids[i] % 20 == 0], 5)
    got = {}
    for r in found.collect():
        got.setdefault(r.a, []).append((r["rank"], r.b, r.sim))
    assert all(sorted(v) == sorted(v, key=lambda t: (-round(t[2], 9), t[1])) for v in got.values())
    recall = np.mean([len({b for _, b, _ in got[q]} & set(w)) / 5 for q, w in want.items()])
    w = work.agg(F.avg("scored").alias("s"), F.avg("compared").alias("c"), F.count("a").alias("n")).first()
    assert recall >= 0.9 and w.c < 0.2 * n and w.n == len(want), (recall, w)
    if kind == "clustered":
        assert w.s < 0.4 * n  # only near cells are probed


def test_broken_vectors_few_rows_and_empty(spark):
    schema = "id long, embedding array<float>"
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [0.0, 1.0]), (2, [0.9, 0.1])]
    d = spark.createDataFrame(rows, schema)
    index, table = ivf.build(d, 2)
    assert sorted(r.id for r in table.collect()) == [1, 2, 2, 8]
    found, _ = ivf.search(index, table, d.filter("id = 1"), 2)
    assert [(r.b, r["rank"]) for r in found.orderBy("rank").collect()] == [(2, 1), (2, 2)]
    index, table = ivf.build(spark.createDataFrame([], schema), 2)
    assert table.collect() == [] and ivf.search(index, table, d.filter("id = 1"), 2)[0].collect() == []
