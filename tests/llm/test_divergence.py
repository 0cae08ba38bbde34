import random
import re
from collections import Counter

import duckdb
import pytest
from conftest_sf import SF_SMALL
from helpers_llm import clashing, docs_of

from tessera.llm import divergence as dv
from tessera.llm.oracles import ORACLES
from tessera.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least=10, top=10):
    """The audit of (id, text, lang, source) rows by dictionaries of Python integers."""
    rows = [(TERM.findall((t or "").translate(LOWER)), la or "", so or "") for _, t, la, so in rows]
    out = []
    for lang in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == lang]
        docs = Counter(w for ws, _, _ in mine for w in set(ws))
        kept = [w for w, n in docs.items() if n >= least]
        v = len(kept)
        count = {s: Counter() for _, _, s in mine}
        for ws, _, s in mine:
            count[s].update(w for w in ws if docs[w] >= least)
        world = sum(count.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {w: 1 + 10 ** 9 * (c[w] + 2) // (n + 2 * v) for w in kept}

        p, q = {s: share(c) for s, c in count.items()}, share(world)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in count:
            pairs = sorted(((-sum(f(p[s][w], p[o][w]) for w in kept), o) for o in count if o != s), key=lambda x: (x[0], x[1].encode()))
            terms = sorted(((-f(p[s][w], q[w]), w) for w in kept if count[s][w] and p[s][w] > q[w]), key=lambda x: (x[0], x[1].encode()))[:top]
            out += [(lang, s, "pair", i, -x, k + 1) for k, (x, i) in enumerate(pairs)] + [(lang, s, "term", i, -x, k + 1) for k, (x, i) in enumerate(terms)]
    return sorted(out)


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def fixture(n=600):
    rng = random.Random(5)
    words = [a + b for a in ("ka", "Lo", "mi", "ÄÖ", "été", "漢字", "z") for b in ("", "x", "Y", "ß", "ou", "né", "aa", "bb", "cc")]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "de", "fr"]) if i % 3 else "en"
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(9)}"
        k = len(source) + ord(source[-1]) % 5
        rows.append((i, " ".join(rng.choice(words[k:]) + rng.choice([" ", ",", "\n", "7", "_", "\x00"]) for _ in range(rng.randrange(40))), lang, source))
    rows += [(n, None, "en", "only-null"), (n + 1, "", None, None), (n + 2, "Ab ab" * 20000, "en", "s1"), (None, "KA ka", "", "s1"), rows[0], rows[0]]
    return rows + [(2000 + i, "rare words", "xx", s) for i, s in enumerate("abc")]  # a language that keeps no term


def test_against_plain_counts(spark, monkeypatch):
    rows = fixture()
    d = docs_of(spark, rows).repartition(4)
    want = plain(rows)
    assert got(dv.audit(clashing(d))) == want
    # many shards, waves, source blocks and flushes give the same
    for name, value in (("SHARD_KEYS", 7), ("WAVE_BYTES", 400), ("SOURCE_BLOCK", 2), ("MOST_SLOTS", 50), ("MOST_TERMS", 30)):
        monkeypatch.setattr(dv, name, value)
    assert len(dv.Recount(d)._waves()) > 3
    assert got(dv.audit(d)) == want
    assert got(dv.audit(d, least_docs=3, top=2)) == plain(rows, 3, 2)


def test_empty_and_termless_tables(spark):
    assert got(dv.audit(docs_of(spark, []))) == []
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "1 2 3", "en", "b")]
    assert got(dv.audit(docs_of(spark, rows))) == plain(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_counts_past_64_bits_of_scale_stay_exact(spark):
    n, total, v = 7 * 10 ** 12 + 3, 9 * 10 ** 13 + 1, 10 ** 6
    r = spark.createDataFrame([(n, total, v)], "n long, total long, v long").select(dv._share(dv.F.col("n"), dv.F.col("total"), dv.F.col("v")).alias("p")).first()
    assert r.p == 1 + 10 ** 9 * (n + 2) // (total + 2 * v)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 500, 4500])
def test_perfect_hash_is_minimal_and_verifies_keys(n):
    keys = [f"word{i * 7919}é".encode() for i in range(n)]
    p = dv.PerfectHash.of(keys)
    assert sorted(p.keys) == sorted(keys)  # n keys in n slots
    look = dv.Lookup(1, {0: (p.seed, p.displace.tolist(), p.keys)})
    slots = look.slots(keys + [b"never seen", b""])
    assert sorted(slots[:n].tolist()) == list(range(n)) and slots[n:].tolist() == [-1, -1]
    assert all(p.keys[s] == k for s, k in zip(slots, keys))


def test_equal_keys_are_refused():
    with pytest.raises(ValueError):
        dv.PerfectHash.of([b"a", b"a"])


def test_lookup_over_shards_and_seeds():
    keys = [f"k{i}".encode() for i in range(300)]
    shard = dv.shard_of(dv.key_hash(keys), 3)
    held = {}
    for s in range(3):
        mine = [k for k, x in zip(keys, shard) if x == s]
        p = dv.PerfectHash.of(mine)
        held[s] = (p.seed, p.displace.tolist(), p.keys)
    for drop in ((), (1,), (0, 2)):
        look = dv.Lookup(3, {s: x for s, x in held.items() if s not in drop})
        slots = look.slots(keys)
        for k, x, s in zip(keys, shard, slots):
            assert (s < 0) if x in drop else (look.keys[s] == k and tuple(a[0] for a in look.shard_and_slot(dv.np.array([s])))[0] == x)


def test_query_against_sql_and_plain(spark):
    res = got(QUERIES["op11_source_divergence"](spark, SF_SMALL))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    rows = con.execute("SELECT doc_id, text, lang, source FROM documents").fetchall()
    assert res == plain(rows)
    assert res == sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in con.execute(ORACLES["op11_source_divergence"]).df().to_dict("records"))
