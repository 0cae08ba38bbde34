import hashlib
import math
import re

from helpers_llm import clashing, docs_of

from tessera.llm import mixing as mx


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, capped = sum(sizes.values()) * share, {}, set()
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        target = {s: cap * sizes[s] for s in capped} | {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


def draws(rows):
    """Each row's draw: by its id if that stands once, else by id, text, source and a number among the equal rows."""
    ids, seen, out = [r[0] for r in rows], {}, []
    for i, t, _, source in rows:
        key = str(i)
        if i is None or ids.count(i) > 1:
            k = (i, t or "", source)
            seen[k] = seen.get(k, 0) + 1
            key = f"{'' if i is None else i}|{hashlib.md5((t or '').encode()).hexdigest()}|{'' if source is None else 's' + source}|{seen[k]}"
        out.append(int(hashlib.md5(f"mix|{key}".encode()).hexdigest()[:13], 16) / 16 ** 13)
    return out


def fixture():
    rows = []
    for i in range(400):
        src = None if i % 50 == 0 else "abcdefg"[min(i % 17, 6)] if i % 3 else "hot"
        rows.append((i, " ".join("w" * (i % 5 + 1) for _ in range(i * 7 % 90)), "en", src))
    return rows + [(400, None, "en", "a"), (401, "", None, "none"), (402, "x " * 30000, "en", "b"), (None, "a b", "en", "b"), (5, "again\t\x0bx", "en", "Ü"), (5, "again\t\x0bx", "en", "Ü")]


def test_against_brute_force(spark):
    rows = fixture()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target = water(sizes)
    got = mx.plan_mix(mx.measured(clashing(docs_of(spark, rows)))).collect()
    assert len(got) == len(rows)
    want = []
    for (i, t, _, s), u in zip(rows, draws(rows)):
        rate = target[s] / sizes[s] if sizes[s] else 0
        n = math.floor(rate) + (u < rate - math.floor(rate))
        assert n <= 2
        want.append((i, size(t), s, sizes[s], round(target[s], 6), n * size(t)))
    assert sorted(((r.doc_id, r["size"], r.source, r.source_size, round(r.target, 6), r.taken) for r in got), key=str) == sorted(want, key=str)
    assert math.isclose(sum(target.values()), 1.5 * sum(sizes.values()))


def test_mix_emits_the_planned_copies_with_all_columns(spark):
    rows = fixture()
    d = clashing(docs_of(spark, rows))
    out = mx.mix(d)
    assert out.columns == d.columns
    plan = {}
    for r in mx.plan_mix(mx.measured(docs_of(spark, rows))).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.copies
    got = {}
    for r in out.collect():
        got[r[0]] = got.get(r[0], 0) + 1
    assert got == {k: v for k, v in plan.items() if v}


def test_rows_without_ids_or_with_repeated_ones_draw_on_their_own(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, ("same text " if i % 2 else f"text {i % 50} ") * 5, "en", "abc"[i % 2 if i % 7 else 2]) for i in range(4000)]
    plan = mx.plan_mix(mx.measured(docs_of(spark, rows))).collect()
    for s in "abc":
        mine = [r for r in plan if r.source == s]
        assert abs(sum(r.taken for r in mine) / mine[0].target - 1) < 0.04, s
    again = mx.plan_mix(mx.measured(docs_of(spark, rows).repartition(7))).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    assert mx.mix(docs_of(spark, rows)).count() == sum(r.copies for r in plan)


def test_empty(spark):
    assert mx.mix(docs_of(spark, [])).collect() == []
    assert mx.plan_mix(mx.measured(docs_of(spark, []))).collect() == []


def test_texts_without_words(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", None)]
    assert [(r.taken, r.target) for r in mx.plan_mix(mx.measured(docs_of(spark, rows))).collect()] == [(0, 0.0)] * 2
