import re

from helpers_llm import clashing, docs_of

from tessera.llm import licences as lc


def grams(text):
    t = re.findall(r"[^\W_]+", text.lower())
    return {(a, b) for a, b in zip(t, t[1:])} if len(t) > 1 else {(w,) for w in t}


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def brute(rows, templates, threshold=0.8):
    """Every unit and every window against every template."""
    out = {}
    for i, text in rows:
        if text is None:
            continue
        paragraphs = re.split(r"\n[ \t\r]*\n", text)
        us = [(0, k, x) for k, x in enumerate(text.split("\n"))] + [(1, k, x) for k, x in enumerate(paragraphs) if "\n" in x] + ([(2, 0, text)] if len(paragraphs) > 1 else [])
        w = words(text)
        for lic, t in templates:
            tw, tb = words(t or ""), grams(t or "")
            hits = [(dice(grams(x), tb), -kind, -place) for kind, place, x in us]
            runs, last = 0, None
            if len(tw) > 1:
                for s in range(len(w) - 1):
                    if (w[s], w[s + 1]) in tb:
                        d = dice(grams(" ".join(w[s:s + len(tw)])), tb)
                        if d >= threshold - 1e-12:
                            hits.append((d, -3, -s))
                            runs, last = runs + (last is None or s - last >= len(tw)), s
            hits = [h for h in hits if h[0] >= threshold - 1e-12]
            if hits:
                r = out.setdefault((i, lic), [(-1, 0, 0), set(), 0])
                r[0], r[2] = max([r[0], *hits]), max(r[2], runs)
                r[1] |= {h[1:] for h in hits if h[1] > -3}
    return sorted(((i, lic, r[0][0], ("line", "paragraph", "text", "passage")[-r[0][1]], -r[0][2], len(r[1]), r[2]) for (i, lic), r in out.items()), key=str)


MIT = lc.TEMPLATES[2][1]
ROWS = [(1, "Intro\nReleased under the MIT License.\nmore text here"), (2, None), (3, ""), (4, "released UNDER -- the mit license"), (5, MIT), (6, "\n".join(re.findall(r".{1,60}(?: |$)", MIT))),
        (7, "x\n\n" + MIT.replace("software", "work", 1).replace("copies", "parts", 1) + "\n\nend"), (8, "word " * 30000), (9, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."),
        (10, "License"), (11, "Released under the license MIT"), (12, "Licensed under the Apache License, Version 2.0.\n\nReleased under the MIT License."), (None, "Released under the MIT License."),
        (13, "\n\n\n"), (1, "Intro\nReleased under the MIT License.\nmore text here"), (14, "one word\n \t\nmit license, released under the MIT License, yes\r\n"),
        (20, "Copyright 2024 Foo. Released under the MIT License."), (21, "Copyright 2024 Example Corp. Licensed under the Apache License, Version 2.0."), (22, "The package is free. Licensed under CC BY 4.0. Enjoy it."),
        (23, "/*\n * Foo 1.2\n * Permission is hereby granted, free of charge, to any person obtaining a copy\n" + "\n".join(" * " + x for x in re.findall(r".{1,50}(?: |$)", MIT[MIT.index("of this software"):])) + "\n */\nint main() {}"),
        (24, "see the file. " * 300 + "It is released\nunder the MIT License, as we said; released under the mit license again and later " + "x y " * 500 + "Released under the MIT License"),
        (25, "released under the MIT"), (26, "under the MIT License under the MIT License under the MIT License")]


def test_against_brute_force(spark):
    rows = [r for r in ROWS]
    got = lc.scan(clashing(docs_of(spark, rows)), clashing(lc.template_table(spark)))
    cols = ("doc_id", "license_id", "dice", "unit", "place", "n_units", "n_passages")
    want = brute([r for k, r in enumerate(rows) if r not in rows[:k]], lc.TEMPLATES)
    assert len(want) > 8
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == want


def test_templates_in_several_groups_and_by_shuffle(spark, monkeypatch):
    want = {tuple(r) for r in lc.scan(docs_of(spark, ROWS), lc.template_table(spark)).collect()}
    monkeypatch.setattr(lc, "BROADCAST_ROWS", 40)  # size ranges are joined by shuffle, templates travel in many groups
    assert {tuple(r) for r in lc.scan(docs_of(spark, ROWS), lc.template_table(spark)).collect()} == want
    assert {20, 21, 22, 23, 24} <= {r[0] for r in want}


def test_no_window_of_any_start_is_missed(spark):
    import random
    rng = random.Random(4)
    rows = []
    for i in range(60):
        t = words(rng.choice(lc.TEMPLATES)[1])
        for _ in range(rng.randrange(0, 1 + len(t) // 6)):
            t[rng.randrange(len(t))] = rng.choice(["changed", "dropped", "the"])
        rows.append((i, " ".join([rng.choice("abcdefgh") * 3 for _ in range(rng.randrange(30))] + t + [rng.choice("pqrstuv") * 3 for _ in range(rng.randrange(30))])))
    want = set()
    for i, text in rows:
        w = words(text)
        for lic, t in lc.TEMPLATES:
            m, tb = len(words(t)), grams(t)
            if max(dice(grams(" ".join(w[s:s + m])), tb) for s in range(max(1, len(w) - m + 1))) >= 0.8:
                want.add((i, lic))
    got = {(r.doc_id, r.license_id) for r in lc.scan(docs_of(spark, rows), lc.template_table(spark)).collect()}
    assert want <= got and len(want) > 40


def test_other_templates_and_empty_tables(spark):
    t = spark.createDataFrame([("A", "alpha beta gamma"), ("B", "single"), ("C", ""), (None, "x y z"), ("D", None)], "license_id string, text string")
    rows = [(1, "alpha beta gamma"), (2, "single"), (3, "x y z"), (4, "alpha beta"), (5, "")]
    got = {(r.doc_id, r.license_id, r.dice) for r in lc.scan(docs_of(spark, rows), t).collect()}
    assert got == {(1, "A", 1.0), (2, "B", 1.0), (3, None, 1.0)}
    assert lc.scan(docs_of(spark, rows), t.where("text is null")).collect() == []
    assert lc.scan(docs_of(spark, []), t).collect() == [] and lc.scan(docs_of(spark, rows), t.limit(0)).collect() == []
