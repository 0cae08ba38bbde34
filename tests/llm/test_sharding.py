import random
import zlib
from collections import Counter, defaultdict

from helpers_llm import clashing, docs_of

from tessera.llm import sharding as sd


def fixture(seed=1, n=3000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((i, "".join(rng.choice("abcdé \n") for _ in range(int(rng.paretovariate(1.2) * 30) % 4000)), rng.choice(["en", "fr", None]), rng.choice(["hot", "hot", None, f"s{i % 9}"])))
    rows += [(n + i, "copy of one text " * 20, "en", "hot") for i in range(300)]  # more than a shard
    rows += [(n + 300 + i, "another copied text " * 5, "fr", f"s{i % 9}") for i in range(40)]  # less than a shard
    return rows + [(None, None, None, None), (None, "", "en", "x"), (7, rows[7][1], "en", "hot"), (9999, "é" * 9000, "en", "x")]


def sizes(rows):
    return [len((t or "").encode()) + 16 for _, t, *_ in rows]


def test_laws(spark):
    rows = fixture()
    got = sd.shard_records(clashing(docs_of(spark, rows))).collect()
    assert len(got) == len(rows)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == sorted(((i, s, zlib.crc32((t or "").encode())) for (i, t, *_), s in zip(rows, sizes(rows))), key=str)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    by, slots = Counter(), defaultdict(list)
    for r in got:
        by[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    target = sum(sizes(rows)) / 40
    assert set(by) == set(range(40))
    # a whole document is the least a cut can move
    assert max(abs(b - target) for b in by.values()) <= 0.1 * target + max(sizes(rows))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_equal_texts_share_a_shard_unless_larger_than_one(spark):
    rows = fixture()
    shards = defaultdict(set)
    crc = {zlib.crc32((t or "").encode()): t or "" for _, t, *_ in rows}
    for r in sd.shard_records(docs_of(spark, rows)).collect():
        shards[crc[r.text_crc32]].add(r.shard)
    target = sum(sizes(rows)) / 40
    weight, n = Counter(), Counter()
    for (_, t, *_), s in zip(rows, sizes(rows)):
        weight[t or ""] += s
        n[t or ""] += 1
    split = {t for t, s in shards.items() if len(s) > 1}
    assert split == {t for t, w in weight.items() if w > target and n[t] > 1} and len(split) == 1


def test_reruns_agree_and_the_wide_form_gives_the_same_shards(spark):
    rows = fixture(2, 400)
    d = clashing(docs_of(spark, rows))
    a = sorted(((r.doc_id, r.text_crc32, r.shard) for r in sd.shard_records(d).collect()), key=str)
    w = sd.assign_shards(d)
    assert [c for c in w.columns if c != "shard"] == [c for c in d.columns if c != "shard"]
    plain = sd.assign_shards(docs_of(spark, rows).repartition(5))
    b = sorted(((r.doc_id, zlib.crc32((r.text or "").encode()), r.shard) for r in plain.collect()), key=str)
    assert a == b


def test_few_rows_and_none(spark):
    assert sd.shard_records(docs_of(spark, [])).collect() == []
    assert sd.assign_shards(docs_of(spark, [])).collect() == []
    got = sd.shard_records(docs_of(spark, [(1, "a"), (2, "b"), (2, "b")]), 2).collect()
    assert len(got) == 3 and {r.shard for r in got} <= {0, 1}
    assert sd.shard_records(docs_of(spark, [(1, None)] * 5), 4).count() == 5


def plain_tree(points, dims, room):
    """Shard of every point by recursion over lists: exact weighted quantiles along the widest dimension."""
    out = [None] * len(points)

    def cut(mine, a, b):
        if b - a == 1:
            for i in mine:
                out[i] = a
            return
        half = (a + b) // 2
        if not mine:
            return
        wide = max(range(dims), key=lambda d: (max(points[i][1][d] for i in mine) - min(points[i][1][d] for i in mine), -d))
        weight = Counter()
        for i in mine:
            weight[points[i][1][wide]] += points[i][0]
        want = sum(weight.values()) * (sum(room[a:half]) / sum(room[a:b]) if sum(room[a:b]) else 0.5)
        run, at = 0, None
        for x in sorted(weight):
            if run + weight[x] >= want:
                # the value at the quantile goes to the side that it misses by less
                at = x if run + weight[x] - want <= want - run or at is None and len(weight) == 1 else at
                break
            run, at = run + weight[x], x
        left = [i for i in mine if at is not None and points[i][1][wide] <= at]
        cut(left, a, half)
        cut([i for i in mine if i not in set(left)], half, b)

    cut(list(range(len(points))), 0, len(room))
    return out


def test_tree_against_plain_weighted_medians(spark):
    for seed, room in ((1, [1.0] * 8), (2, [5.0, 1.0, 1.0, 0.0, 3.0, 2.0, 2.0]), (3, [1.0, 2.0, 3.0])):
        rng = random.Random(seed)
        pts = [(rng.randrange(50, 4000), (rng.randrange(1 << 40), rng.choice([3, 3, 3, rng.randrange(1 << 41)]), rng.randrange(1000))) for _ in range(260)]
        share = sum(s for s, _ in pts) / sum(room)
        d = spark.createDataFrame([(i, s, *x) for i, (s, x) in enumerate(pts)], "i long, size long, a long, b long, c long")
        cuts, leaf = sd.grow_tree(d, ["a", "b", "c"], [x * share for x in room])
        got = {r.i: leaf[r.node] for r in d.withColumn("node", sd._tree(cuts)).collect()}
        assert [got[i] for i in range(len(pts))] == plain_tree(pts, 3, room)
