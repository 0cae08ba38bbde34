import random

import numpy as np
import pytest
import xxhash
from helpers_llm import clashing, docs_of, union_find
from pyspark.sql import functions as F

from tessera.llm import simhash as sh


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh3 = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh3]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute(rows, max_bits=3):
    f = [plain_fingerprint(t) for _, t in rows]
    root = union_find(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= max_bits])
    low = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            low[r] = min(low.get(r, rows[i][0]), rows[i][0])
    return sorted([(rows[i][0], f"{f[i]:016x}", low.get(root[i])) for i in range(len(rows))], key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["Éa", "ß", "the", "OF"]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((i, " ".join(words)))
        else:
            rows.append((i, " ".join(rng.choice(vocab) for _ in range(rng.choice([4, 90, 400])))))
    return rows


ODD = [(1000, None), (1001, ""), (1002, " \t\r\n\x0b\x0c"), (1003, "one"), (1004, "One  two"), (1005, "a b c d"), (1006, "x " * 70000), (1007, "x " * 69000),
       (None, "null id text with words"), (None, "null id text with words"), (5, "the same id another text"), (1003, "one")]


def test_components_against_brute_force(spark):
    rows = corpus(1) + ODD
    got = sh.simhash_components(clashing(docs_of(spark, rows))).select("doc_id", sh.hex16(F.col("fp")).alias("h"), "component_id")
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def random_fingerprints(seed, n, centres=3, flips=4):
    rng = random.Random(seed)
    c = [rng.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < n:
        x = rng.choice(c)
        for _ in range(rng.randrange(flips + 1)):
            x ^= 1 << rng.randrange(64)
        out.add(x if rng.random() < 0.7 else rng.getrandbits(64))
    return sorted(out)


@pytest.mark.parametrize("n,centres,flips", [(1, 1, 1), (17, 1, 3), (300, 3, 4), (900, 1, 9)])
def test_group_index_against_all_pairs(n, centres, flips):
    f = np.array(random_fingerprints(n, n, centres, flips), dtype=np.uint64)
    np.random.default_rng(1).shuffle(f)
    want = union_find(n, [(i, j) for i in range(n) for j in range(i) if np.bitwise_count(f[i] ^ f[j]) <= 3])
    assert sh.link_group(f).tolist() == want


def test_hot_nodes_are_factored_again_without_losing_links(spark):
    f = random_fingerprints(9, 400, 2, 6)
    want = union_find(len(f), [(i, j) for i in range(len(f)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= 3])
    at = {sh._signed(x): i for i, x in enumerate(f)}
    e = sh.link_fingerprints(spark.createDataFrame([(x,) for x in at], "fp long"), group=64).collect()
    assert union_find(len(f), [(at[r.a], at[r.b]) for r in e]) == want
    assert len(e) < 16 * len(f)


def test_child_masks_cover_the_free_bits():
    for m in sh.split_mask(0, 4):
        kids = sh.split_mask(m, 4)
        free = ((1 << 64) - 1) ^ m
        assert [k & m for k in kids] == [m] * 4 and sum(k ^ m for k in kids) == free


def test_keep_one_keeps_all_columns_and_one_row_per_group(spark):
    rows = corpus(2, 40) + ODD + [(7, corpus(2, 40)[7][1])]
    d = clashing(docs_of(spark, rows))
    kept = sh.keep_one(d)
    assert kept.columns == d.columns
    groups = {(r[2], r[1]) for r in brute(rows)}
    by_root = sh.simhash_components(docs_of(spark, rows))
    assert kept.count() == by_root.select("root").distinct().count()
    ids = [r[0] for r in kept.collect()]
    want = [r["m"] for r in by_root.groupBy("root").agg(F.min("doc_id").alias("m")).collect()]
    assert sorted(map(str, ids)) == sorted(map(str, want)) and groups


def test_empty(spark):
    d = docs_of(spark, [])
    assert sh.simhash_components(d).collect() == [] and sh.keep_one(d).collect() == []
