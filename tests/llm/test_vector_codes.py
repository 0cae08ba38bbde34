import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from conftest_sf import SF_SMALL
from helpers_llm import clashing

from tessera.llm import vector_codes as vc
from tessera.llm.common import read
from tessera.llm.oracles import ORACLES
from tessera.llm.queries import QUERIES

VEC = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2, scale=256):
    """Codes of (vec_id, vector, label) rows by loops over Python integers."""
    ok = [(i, [math.floor(scale * x) for x in e], g) for i, e, g in rows
          if e and len(e) % parts == 0 and all(x is not None and math.isfinite(x) for x in e)]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ok = [r for r in ok if len(r[1]) == len(ok[0][1])]
    if not ok:
        return [], None
    d = len(ok[0][1]) // parts
    cut = [[x[p * d:(p + 1) * d] for p in range(parts)] for _, x, _ in ok]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [[list(e) for e in b] for b in books]
        for p in range(parts):
            took = {}
            for c in cut:
                took.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for i, vs in took.items():
                new[p][i] = [sum(col) // len(vs) for col in zip(*vs)]
        books = new
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    error = [sum(e for e, _ in f) for f in found]
    label = {}
    for (_, _, g), e in zip(ok, error):
        label[g] = label.get(g, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, label[g], sha) for (i, _, g), f, e in zip(ok, found, error)), key=str), books


def got(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str)


def fixture(n=300, dim=32, seed=3):
    rng = random.Random(seed)
    f32 = lambda x: float(np.float32(x))
    rows = [(i * 7 % 1000, [f32(rng.gauss(0, 1)) for _ in range(dim)], None if i % 3 == 0 else i % 4) for i in range(n)]
    same = [f32(0.25)] * dim
    rows += [(5000 + i, same, 1) for i in range(n // 2)]  # one common vector
    rows += [rows[0], rows[1], (rows[2][0], same, None), (None, rows[3][1], 2), (None, same, 2)]
    rows += [(9000, None, 1), (9001, [], 1), (9002, [f32(1.0)] * 31, 1), (9003, [f32(1.0)] * 48, 1), (9004, [f32("nan")] * dim, 1),
             (9005, [f32("inf")] + same[1:], 1), (9006, [None] + same[1:], 1), (9007, [0.0] * dim, 1), (9008, [-3000.5] * dim, 1)]
    return rows


def test_against_plain_loops(spark, monkeypatch):
    rows = fixture()
    d = spark.createDataFrame(rows, VEC).repartition(3)
    want, books = plain(rows, entries=20)
    assert got(vc.compress(clashing(d), entries=20)) == want
    monkeypatch.setattr(vc, "CHUNK", 37)  # many small chunks give the same
    assert got(vc.compress(d, entries=20)) == want
    m = vc.Codebooks(d, entries=20)
    r = m.encoded().where("vec_id = 9008").select("code", m.decoded(vc.F.col("code")).alias("x")).first()
    assert r.x == [v for p, k in enumerate(r.code) for v in books[p][k]]


def test_fewer_rows_than_entries_and_no_rounds(spark):
    rows = fixture(20)[:10]
    d = spark.createDataFrame(rows, VEC)
    assert got(vc.compress(d)) == plain(rows)[0]
    assert got(vc.compress(d, parts=4, entries=3, rounds=0)) == plain(rows, 4, 3, 0)[0]


def test_mixed_lengths_take_that_of_the_smallest_id(spark):
    rows = [(1, [0.5] * 32, 0), (2, [0.5] * 16, 0), (3, [1.0] * 32, 0)]
    assert got(vc.compress(spark.createDataFrame(rows, VEC))) == plain(rows)[0] and len(plain(rows)[0]) == 2


def test_empty(spark):
    assert got(vc.compress(spark.createDataFrame([], VEC))) == []
    assert got(vc.compress(spark.createDataFrame([(1, None, 1)], VEC))) == []


def test_components_past_the_limit_fail_clearly(spark):
    with pytest.raises(Exception, match="must be below"):
        vc.compress(spark.createDataFrame([(1, [1e30] * 16, 1)], VEC)).collect()


def test_blocks_shortlist_every_nearest_entry_and_prune(spark):
    rng = np.random.default_rng(1)
    pts = np.concatenate([rng.normal(c, 6, (700, 4)) for c in (-300, 0, 90, 400)]).round().astype(np.int64)
    b, entries = vc.Block.of(pts), pts[rng.choice(len(pts), 64)]
    dist = ((b.points[:, None] - entries[None]) ** 2).sum(2)
    short = b.shortlists(entries)
    best = dist.argmin(1)
    assert short[np.arange(len(pts)) // vc.BLOCK, best].all() and short.mean() < 0.5
    n, total = b.sums(entries)
    assert n.tolist() == np.bincount(best, minlength=64).tolist() and total.sum(0).tolist() == pts.sum(0).tolist()
    whole = b.sums(np.array([[-300] * 4, [9000] * 4]))  # one entry left everywhere: the stored sums are the answer
    assert whole[0].tolist() == [len(pts), 0] and whole[1][0].tolist() == pts.sum(0).tolist()


def test_hilbert_order_steps_to_a_neighbour():
    grid = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    order = grid[np.argsort(vc.hilbert_keys(grid))]
    assert np.abs(np.diff(order, axis=0)).sum(1).max() == 1
    assert vc.hilbert_keys(np.zeros((3, 70), np.int64)).tolist() == [0, 0, 0] and len(vc.hilbert_keys(np.zeros((0, 4)))) == 0


def test_query_against_sql_and_loops(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in read(spark, SF_SMALL, "embeddings").collect()]
    res = got(QUERIES["op12_vector_codes"](spark, SF_SMALL))
    assert res == plain(rows)[0]
    sql = ORACLES["op12_vector_codes"].replace("FROM embeddings", f"FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    assert sorted(((r[0], r[1], r[2], r[3], r[4]) for r in duckdb.sql(sql).fetchall()), key=str) == res
