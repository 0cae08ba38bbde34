import math

import numpy as np
import pytest
from helpers_llm import clashing, union_find

from tessera.llm import neardup_vectors as nv

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold):
    ok = [i for i, (_, e, lab) in enumerate(rows) if lab is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    pairs = []
    for a in range(len(ok)):
        for b in range(a):
            i, j = ok[a], ok[b]
            x, y = np.array(rows[i][1], dtype="f4").astype(float), np.array(rows[j][1], dtype="f4").astype(float)
            if rows[i][2] == rows[j][2] and len(x) == len(y):
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    pairs.append((i, j))
    root = union_find(len(rows), pairs)
    deg = [sum(i in p for p in pairs) for i in range(len(rows))]
    low = {}
    for i, r in enumerate(root):
        ids = [rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None]
        low[i] = min(ids) if ids else None
    return sorted([(rows[i][0], deg[i], low[i], rows[i][0] is not None and rows[i][0] == low[i]) for i in range(len(rows))], key=str)


def cloud(seed, dim, n, noise=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(2, n // 8), dim))
    out = []
    for i in range(n):
        v = centres[rng.integers(len(centres))] * rng.uniform(0.1, 9) + 0
        v = v + rng.standard_normal(dim) * np.linalg.norm(v) * rng.uniform(0, noise)
        out.append((i, [float(x) for x in v.astype("f4")], int(rng.integers(2))))
    return out


@pytest.mark.parametrize("dim,noise", [(64, 0.04), (20, 0.06)])
def test_against_brute_force(spark, dim, noise):
    rows = cloud(dim, dim, 160, noise)
    rows += [(500, rows[3][1], rows[3][2]), (501, rows[3][1], rows[3][2]), (502, rows[3][1], 1 - rows[3][2]), (3, rows[3][1], rows[3][2])]
    rows += [(600, None, 1), (601, [], 1), (602, [0.0] * dim, 1), (603, [float("nan")] + [1.0] * (dim - 1), 1), (604, [float("inf")] + [1.0] * (dim - 1), 0),
             (605, [None] + [1.0] * (dim - 1), 0), (606, rows[5][1], None), (None, rows[7][1], rows[7][2]), (608, [1e-30 * x for x in rows[9][1]], rows[9][2]),
             (609, [1.0, 2.0], 0), (610, [2.0, 4.0], 0)]
    got = nv.near_duplicate_vectors(clashing(spark.createDataFrame(rows, SCHEMA)))
    assert sorted([tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()], key=str) == brute(rows, nv.THRESHOLD)


@pytest.mark.parametrize("width", [8, 12, 20, 24])
def test_any_block_width_gives_the_same(spark, monkeypatch, width):
    monkeypatch.setattr(nv, "WIDTHS", (width,))
    rows = cloud(width, 24, 90, 0.06)
    got = nv.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA))
    assert sorted([tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()], key=str) == brute(rows, nv.THRESHOLD)


def test_wider_blocks_for_larger_labels_keep_the_work_per_vector_down():
    def work(rows):
        w = nv.block_width(64, rows, 0.98)
        x = np.random.default_rng(1).standard_normal((32, 64))
        return w, len(nv.lookups(nv.encode(x, w)["v"], nv.reach(64, w, 0.98), w)[0]) / 32 * (1 + rows / 2 ** w)

    sizes = [10 ** k for k in range(3, 9)]
    got = [work(n) for n in sizes]
    assert [w for w, _ in got] == sorted(w for w, _ in got) and got[-1][0] > got[0][0]
    # 100,000 times the rows: work per vector grows with a power under one half
    assert got[-1][1] / got[0][1] < (sizes[-1] / sizes[0]) ** 0.5


def test_empty(spark):
    assert nv.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_bound_holds_for_every_pair_at_or_above_the_threshold():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 64))
    y = x + rng.standard_normal((3000, 64)) * 0.2 * rng.uniform(0, 1, (3000, 1)) * np.linalg.norm(x, axis=1, keepdims=True) / 8
    cos = (x * y).sum(1) / np.linalg.norm(x, axis=1) / np.linalg.norm(y, axis=1)
    a, b = nv.encode(x), nv.encode(y)
    est, width = nv.estimate_bound(a["code"], a["c"], b["planes"], b["lo"], b["step"], b["err"], 0.98)
    near = cos >= 0.98
    assert 500 < near.sum() < 3000
    assert np.all(np.abs(est - cos)[near] <= width[near] + 1e-9)
    # and it prunes: unrelated pairs hardly ever need the exact computation
    est, width = nv.estimate_bound(a["code"], a["c"], np.roll(b["planes"], 1, 0), np.roll(b["lo"], 1), np.roll(b["step"], 1), np.roll(b["err"], 1), 0.98)
    assert (est + width >= 0.98).mean() < 0.01


def test_estimate_is_unbiased_over_rotations():
    rng = np.random.default_rng(6)
    x, y = rng.standard_normal((1, 64)), rng.standard_normal((1, 64))
    y = 0.7 * x / np.linalg.norm(x) + 0.5 * y / np.linalg.norm(y)
    true = float((x * y).sum() / np.linalg.norm(x) / np.linalg.norm(y))
    est, keep = [], nv.ROTATION_SEED
    for s in range(600):
        nv._ROTATIONS[64, keep] = np.linalg.qr(np.random.default_rng(s).standard_normal((64, 64)))[0]
        a, b = nv.encode(x), nv.encode(y)
        est.append(nv.estimate_bound(a["code"], a["c"], b["planes"], b["lo"], b["step"], b["err"], 0.98)[0][0])
    nv._ROTATIONS.clear()
    assert abs(np.mean(est) - true) < 4 * np.std(est) / math.sqrt(len(est)) + 1e-3


def test_lookups_reach_every_near_vector():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = rng.standard_normal((400, 64))
    y = x + 0.195 * d / np.linalg.norm(d, axis=1, keepdims=True)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    a, b = nv.encode(x)["v"], nv.encode(y)["v"]
    limit = (2 - 2 * 0.98) / 8 * (1 + 1e-6)
    la, lb = nv.lookups(a, limit), nv.lookups(b, limit)
    probe = lambda t: {(r, k, c) for r, k, c in zip(*t[:3])}
    home = lambda t: [(r, k, c) for r, k, c, o in zip(*t) if o]
    pa, pb = probe(la), probe(lb)
    found = {h[0] for h in home(lb) if h in pa} | {h[0] for h in home(la) if h in pb}
    near = {i for i in range(400) if x[i] @ y[i] >= 0.98}
    assert len(near) > 300 and near <= found
