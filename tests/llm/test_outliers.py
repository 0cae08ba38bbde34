import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
from conftest_sf import SF_SMALL
from helpers_llm import clashing, docs_of

from tessera.llm import outliers as ol
from tessera.llm.common import read
from tessera.llm.oracles import ORACLES
from tessera.llm.queries import QUERIES

COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    many = Counter(wins)
    hit = {j for i, w in enumerate(wins) if many[w] > 1 for j in range(i, i + 8)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), n < 20 or 100 * len(hit) > 30 * n, len(lines)


def half_up(x):
    return math.floor(x + 0.5)


def plain_vector(c):
    n, chars, sym, dup, rep, _, lines = c
    v = (math.log1p(n), math.log(chars / n), math.log1p(100 * sym / n), math.log1p(100 * dup / lines), math.log1p(100 * rep / n))
    return [half_up(x * 1024) for x in v]


def plain_estimate(x):
    """Centre and regularised covariance of integer vectors (rows), by the module's rule in NumPy."""
    x = np.array(x, float) / 1024
    floors = np.diag([0.25, 0.0225, 0.25, 1.0, 1.0])
    srt = np.sort(x, axis=0)
    at = lambda p: srt[math.ceil(len(x) * p) - 1]
    starts = [(x.mean(0), np.cov(x.T, bias=True) + floors), (at(0.5), np.diag(((at(0.75) - at(0.25)) / 1.349) ** 2) + floors)]
    out = []
    for m, c in starts:
        for _ in range(6):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            b = np.floor(np.log2(d + 1 / 1024) * 8)
            cut = np.sort(b)[math.ceil(len(x) * 0.75) - 1]
            near = x[b <= cut]
            m, c = near.mean(0), np.cov(near.T, bias=True) * ol.WIDEN + floors
        out.append((np.linalg.slogdet(c)[1], m, c))
    _, m, c = min(out, key=lambda o: o[0])
    return m, np.linalg.inv(c)


def plain(rows):
    """(id, kept, distance) of (id, text, lang, source) rows."""
    counted = [plain_counts(t) for _, t, _, _ in rows]
    groups = {}
    for (_, _, la, so), c in zip(rows, counted):
        if not c[5]:
            groups.setdefault((la, so), []).append(plain_vector(c))
    pool, of = {}, {}
    for g, v in groups.items():
        of[g] = (0, *g) if len(v) >= 100 else (1, g[0])
    for level in (1, 2):
        size = Counter()
        for g, v in groups.items():
            size[of[g]] += len(v)
        of = {g: (2,) if size[k] < 100 and level == 1 else k for g, k in of.items()}
    for g, v in groups.items():
        pool.setdefault(of[g], []).extend(v)
    est = {k: plain_estimate(v) for k, v in pool.items() if len(v) >= 100}
    out = []
    for (i, _, la, so), c in zip(rows, counted):
        d = None
        if not c[5] and of[la, so] in est:
            m, inv = est[of[la, so]]
            x = np.array(plain_vector(c)) / 1024 - m
            d = float(x @ inv @ x)
        out.append((i, *c[:6], not c[5] and (d is None or d <= ol.BOUND), d))
    return out


def fixture(n=900):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        words = [rng.choice(["ka", "lorem", "übung", "漢字", "middle", "x"]) + rng.choice(["", "s", "ing", "er"]) + str(rng.randrange(300)) for _ in range(rng.randrange(10, 400))]
        if i % 11 == 0:
            words = [w + "$$%" for w in words]
        if i % 13 == 0:
            words = words[:40] + words[:20]
        sep = rng.choice([" ", "\n", " \t", "\x0b"])
        lang, source = ("en", "hot") if i % 3 == 0 else (rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]))
        rows.append((i, sep.join(words), lang, source))
    line = "one line that comes again and again in it\n"
    return rows + [(n, None, "en", "a"), (n + 1, "", None, None), (n + 2, line * 3 + " ".join(f"w{i}" for i in range(100)), "en", "hot"), (n + 3, line * 4000, "en", "hot"),
                   (None, "q" * 5000 + " w" * 30, "fr", "lone"), rows[0], rows[0], (n + 4, " \n\t\x0c\n ", "en", "a"), (n + 5, " ".join(f"v{i}" for i in range(60000)), "en", "hot"),
                   (n + 6, " ".join(f"u{i}" for i in range(25)), "zz", "lone")]


def compare(got, want):
    key = lambda r: str(r[:8])
    got = sorted(((r.doc_id, *(r[c] for c in COLS), r.kept, r.distance) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:8] for r in got] == [r[:8] for r in want]
    for a, b in zip(got, want):
        assert (a[8] is None) == (b[8] is None) and (a[8] is None or math.isclose(a[8], b[8], rel_tol=1e-6, abs_tol=1e-9))


def test_against_numpy(spark):
    rows = fixture()
    got = ol.judge(clashing(docs_of(spark, rows).repartition(5))).collect()
    want = plain(rows)
    compare(got, want)
    bad = {r[0] for r in want if not r[7] and not r[6]}
    assert len(bad) > 50 and all(i is None or i >= 900 or i % 11 == 0 for i in bad)  # the rules turn on the symbol texts, not on the others


def test_keep_ordinary_keeps_all_columns(spark):
    rows = fixture(400)
    d = clashing(docs_of(spark, rows))
    out = ol.keep_ordinary(d)
    assert out.columns == d.columns
    assert sorted(str(r[0]) for r in out.collect()) == sorted(str(r.doc_id) for r in ol.judge(d).collect() if r.kept)


def test_few_documents_are_kept(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(30)) + "$" * i, "en", "a") for i in range(30)]
    got = ol.judge(docs_of(spark, rows)).collect()
    assert all(r.kept and r.distance is None for r in got)


def test_equal_documents_give_a_proper_estimate(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(30)), "en", "a") for i in range(150)] + [(999, " ".join(f"w{j}$$$$$$$$" for j in range(30)), "en", "a")]
    got = {r.doc_id: r for r in ol.judge(docs_of(spark, rows)).collect()}
    assert got[0].kept and got[0].distance < 1e-6 and not got[999].kept


def test_empty(spark):
    assert ol.judge(docs_of(spark, [])).collect() == [] and ol.keep_ordinary(docs_of(spark, [])).collect() == []
    assert [(r.kept, r.base_failed) for r in ol.judge(docs_of(spark, [(1, None), (2, "")])).collect()] == [(False, True)] * 2


def test_chi_square():
    assert math.isclose(ol.chi_square(3.841458820694124, 1), 0.95, abs_tol=1e-9) and math.isclose(ol.chi_square(11.070497693516351, 5), 0.95, abs_tol=1e-9)
    assert math.isclose(ol.BOUND, 30.856189940, abs_tol=1e-6)


def test_plan_has_no_python(spark):
    plan = ol.judge(read(spark, SF_SMALL, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_on_given_documents(spark):
    docs = read(spark, SF_SMALL, "documents")
    want = plain([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()])
    compare(ol.judge(docs).collect(), want)
    got = sorted((r.doc_id, *(r[c] for c in COLS), r.kept) for r in QUERIES["op13_quality_rules"](spark, SF_SMALL).collect())
    assert got == sorted(r[:8] for r in want)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    assert got == sorted(con.execute(ORACLES["op13_quality_rules"]).fetchall())
