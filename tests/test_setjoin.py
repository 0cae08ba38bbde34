"""The set-similarity join against brute-force Jaccard over all pairs."""

import random
from itertools import combinations

import pytest
from helpers import SF_ORACLE

from tessera.operators import setjoin as sj
from tessera.sources.tables import table

SETS = "rep long, tokens array<bigint>"


def brute(sets, t):
    return {(max(a, b), min(a, b)): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in combinations(sorted(sets), 2)
            if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-12}


def families(rng, n, universe=4000):
    """Sets in families of near copies, some tiny, some sharing one very common part."""
    out, common = {}, set(range(universe, universe + 60))
    while len(out) < n:
        base = {rng.randrange(universe) for _ in range(rng.choice([1, 2, 5, 40, 200]))}
        if rng.random() < 0.4:
            base |= common
        for _ in range(rng.choice([1, 1, 3, 8])):
            s = {x for x in base if rng.random() > rng.choice([0, 0.02, 0.1, 0.2])} | {rng.randrange(universe) for _ in range(rng.randrange(3))}
            if s and s not in out.values():
                out[len(out) * 3 + 1] = s
    return out


@pytest.mark.parametrize("t", [0.5, 0.8, 0.95])
def test_all_similar_pairs_and_no_others(spark, t):
    sets = families(random.Random(int(t * 100)), 500)
    d = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], SETS)
    got = {(r.id_a, r.id_b): r.jaccard for r in sj.similarity_pairs(d, t, salt_above=50).collect()}  # hot tokens are salted
    want = brute(sets, t)
    assert set(got) == set(want) and len(want) > (100 if t < 0.9 else 0)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_classes_short_empty_and_repeated_texts(spark):
    rows = [(1, "A b\tc d e f"), (2, "a B c d  e\nf"), (3, "a b"), (4, " A  b "), (5, ""), (6, None), (7, " \t"), (8, "x " * 3000), (9, "x " * 9000), (9, "x " * 9000),
            (10, "a b c d e"), (11, "one"), (12, "one two three four five six seven eight nine ten eleven"), (13, "one two three four five six seven eight nine ten eleven twelve")]
    links = {(r.id_a, r.id_b, round(r.jaccard, 9)) for r in sj.near_duplicate_links(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert links == {(2, 1, 1.0), (4, 3, 1.0), (9, 8, 1.0), (13, 12, 0.875)}
    assert sj.near_duplicate_links(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_recall_on_given_documents(spark):
    d = table(spark, SF_ORACLE, "documents").select("doc_id", "text")
    sets = {}
    for r in d.collect():
        w = (r.text or "").lower().split()
        if w:
            sets[r.doc_id] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    rep = {}
    for i in sorted(sets):
        rep.setdefault(sets[i], i)
    links = sj.near_duplicate_links(d).collect()
    linked = {(r.id_a, r.id_b) for r in links}
    want = brute(sets, 0.8)
    found = sum((max(rep[sets[a]], rep[sets[b]]), min(rep[sets[a]], rep[sets[b]])) in linked or sets[a] == sets[b] for a, b in want)
    assert want and found == len(want)  # recall 1.0
    assert all((a, b) in want for a, b in linked)  # and nothing else
