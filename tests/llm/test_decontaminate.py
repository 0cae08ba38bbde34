import itertools
import random
import re

from helpers_llm import clashing, docs_of

from tessera.llm import decontaminate as dc

SCHEMA = "item_id long, text string"


def toks(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items):
    out = {}
    for doc_id, text in docs:
        d = toks(text)
        for item_id, it_text in items:
            t = toks(it_text)
            if item_id is None or it_text is None or len(t) < 5:
                continue
            w = min(13, len(t))
            for ip in range(len(t) - w + 1):
                for dp in range(len(d) - w + 1):
                    n = sum(t[ip + k] == d[dp + k] for k in range(w))
                    if n >= 0.8 * w - 1e-9:
                        out[doc_id, item_id] = max(out.get((doc_id, item_id), (0, 0, 0, 0)), (n, -w, -dp, -ip))
    return sorted(((d, i, -r[1], r[0], r[0] / -r[1], -r[2], -r[3]) for (d, i), r in out.items()), key=str)


def test_masks_meet_every_allowed_alignment():
    def meets(masks, n):
        return all(any(all(s + o not in bad for o in m) for m in masks for s in range(n - m[-1]))
                   for k in range(int(n * 0.2 + 1e-9) + 1) for bad in map(set, itertools.combinations(range(n), k)))
    assert all(meets(dc.MASKS, n) for n in range(dc.LONG, dc.WINDOW + 1))
    assert all(meets(dc.SHORT_MASKS, n) for n in range(dc.LEAST, dc.LONG))


def fixture(seed=3):
    rng = random.Random(seed)
    vocab = ["the", "of", "and"] * 6 + [f"w{i}" for i in range(200)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([5, 6, 7, 8, 9, 12, 13, 20, 40, 33])]
    items += [(50, "too short now"), (51, None), (None, "a b c d e f g h i j"), (52, items[6][1]), (53, "")]
    docs = []
    for i in range(60):
        body = [rng.choice(vocab) for _ in range(rng.choice([3, 30, 120]))]
        if i % 2:
            words = toks(rng.choice(items[:10])[1])
            a = rng.randrange(max(1, len(words) - 13))
            words = [w if rng.random() > rng.choice([0, 0.15, 0.3]) else "zzz" for w in words[a:]]
            at = rng.randrange(len(body) + 1)
            body[at:at] = words
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(body).upper() if i % 3 else " ".join(body)))
    docs += [(100, None), (101, ""), (102, "..."), (103, items[8][1]), (103, items[8][1]), (None, items[7][1]), (104, ("x " * 3000) + items[9][1])]
    return docs, items


def test_against_brute_force(spark):
    docs, items = fixture()
    got = dc.overlaps(clashing(docs_of(spark, docs)), clashing(spark.createDataFrame(items, SCHEMA)))
    cols = ("doc_id", "item_id", "n_tokens", "n_match", "similarity", "doc_pos", "item_pos")
    want = brute(docs, items)
    assert len(want) > 20
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == want


def test_shuffled_seeds_give_the_same(spark, monkeypatch):
    docs, items = fixture(4)
    a = dc.overlaps(docs_of(spark, docs), spark.createDataFrame(items, SCHEMA)).collect()
    monkeypatch.setattr(dc, "BROADCAST_SEEDS", 0)
    b = dc.overlaps(docs_of(spark, docs), spark.createDataFrame(items, SCHEMA)).collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def test_remove_contaminated(spark):
    docs, items = fixture()
    d = clashing(docs_of(spark, docs))
    got = dc.remove_contaminated(d, spark.createDataFrame(items, SCHEMA))
    bad = {r[0] for r in brute(docs, items)}
    assert got.columns == d.columns
    assert sorted((str(r[0]) for r in got.collect())) == sorted(str(i) for i, _ in docs if i not in bad)


def test_clean_rows_of_a_null_or_repeated_id_stay(spark):
    _, items = fixture()
    bad = items[8][1]
    docs = [(None, bad), (None, "clean and null"), (None, None), (7, bad), (7, "clean and repeated"), (7, "clean and repeated"), (8, "alone")]
    got = dc.remove_contaminated(docs_of(spark, docs), spark.createDataFrame(items, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((i, t) for i, t in docs if t != bad), key=str)


def test_empty_tables(spark):
    docs, items = fixture()
    none = spark.createDataFrame([], SCHEMA)
    assert dc.overlaps(docs_of(spark, docs), none).collect() == []
    assert dc.overlaps(docs_of(spark, []), spark.createDataFrame(items, SCHEMA)).collect() == []
    assert dc.remove_contaminated(docs_of(spark, docs), none).count() == len(docs)
