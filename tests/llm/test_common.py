import random

from helpers_llm import union_find

from tessera.llm import common


def test_components_with_salted_hubs(spark, monkeypatch):
    rng = random.Random(5)
    pairs = [(0, i) for i in range(1, 200)] + [(500, 501 + i) for i in range(150)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(180)]
    pairs += [(2000 + i, 2001 + i) for i in range(60)] + [(7, 7), (3000, 5), (3000, 520)]
    monkeypatch.setattr(common.salted_self_join, "__defaults__", (20, 4))  # hubs of over 20 neighbours are hot
    got = {(r.node, r.root) for r in common.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = sorted({x for p in pairs if p[0] != p[1] for x in p})
    at = {x: i for i, x in enumerate(nodes)}
    root = union_find(len(nodes), [(at[a], at[b]) for a, b in pairs if a != b])
    assert got == {(x, nodes[root[at[x]]]) for x in nodes}
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []
