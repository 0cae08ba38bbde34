from collections import defaultdict

from helpers_llm import clashing

from tessera.llm import preference as pf

SCHEMA = "pair_id long, side string, turn long, role string, text string"


def conv(pair, side, *turns):
    return [(pair, side, k, r, t) for k, (r, t) in enumerate(turns)]


U, A, S = "user", "assistant", "system"
ROWS = [
    *conv(1, "chosen", (S, "be kind"), (U, "hi"), (A, "hello"), (U, "why"), (A, "because é𝒳")),
    *conv(1, "rejected", (S, "be kind"), (U, "hi"), (A, "hello"), (U, "why"), (A, "no"), (U, "rude"), (A, "sorry")),
    *conv(2, "chosen", (U, "a")), *conv(2, "rejected", (U, "b")),
    *conv(3, "chosen", (U, "x"), (A, "y")), *conv(3, "rejected", (U, "x"), (A, "y")),
    *conv(4, "chosen", (U, "only"), (A, "one side")),
    *conv(5, "rejected", (U, "only"), (A, "other side")),
    *conv(6, "chosen", (U, None), (None, "t"), (A, "")), *conv(6, "rejected", (U, None), (None, "t"), (A, None)),
    *conv(7, "chosen", (U, "p"), (A, "q")), *conv(7, "rejected", (U, "p"), (A, "q"), (U, "more")),
    *conv(8, "chosen", *[(U if k % 2 == 0 else A, f"t{k % 3}") for k in range(3000)]), *conv(8, "rejected", *[(U if k % 2 == 0 else A, f"t{k % 3}" if k < 2990 else "z") for k in range(3000)]),
    *conv(9, "chosen", (U, "w" * 200000), (A, "v")), *conv(9, "rejected", (U, "w" * 200000), (A, "u")),
    (10, "chosen", 1, U, "tie"), (10, "chosen", 1, U, "tie"), (10, "chosen", None, S, "first"), (10, "rejected", 1, U, "tie"), (10, "rejected", None, S, "first"),
    (None, "chosen", 0, U, "x"), (11, "other", 0, U, "x"),
]


def brute(rows):
    sides = defaultdict(lambda: {"chosen": [], "rejected": []})
    for p, s, t, r, x in rows:
        if p is not None and s in ("chosen", "rejected"):
            sides[p][s].append((t, r, x))
    out = {}
    for p, both in sides.items():
        c, d = ([(r, x) for _, r, x in sorted(v, key=lambda t: [(y is not None, y or "" if not isinstance(y, int) else y) for y in t])] for v in (both["chosen"], both["rejected"]))
        k = 0
        while k < len(c) and k < len(d) and c[k] == d[k]:
            k += 1

        def text(ts):
            return "".join(f"<|{r or ''}|>\n{x or ''}<|end|>\n" for r, x in ts)

        def mask(ts):
            spans, at = [], 0
            for r, x in ts:
                lead, whole = len(f"<|{r or ''}|>\n"), len(text([(r, x)]))
                if r == A:
                    spans.append((at + lead, at + whole))
                at += whole
            return spans

        out[p] = (text(c[:k]), text(c[k:]), text(d[k:]), mask(c[k:]), mask(d[k:]))
    return out


def test_assembled_examples_against_brute_force(spark):
    got = pf.assemble(pf.preference_segments(clashing(spark.createDataFrame(ROWS, SCHEMA)))).collect()
    spans = lambda m: [(s.start, s.end) for s in m]
    assert {r.pair_id: (r.prompt, r.chosen, r.rejected, spans(r.chosen_mask), spans(r.rejected_mask)) for r in got} == brute(ROWS)


def test_summary_counts_the_same(spark):
    want = brute(ROWS)
    for r in pf.pair_summary(pf.preference_segments(spark.createDataFrame(ROWS, SCHEMA))).collect():
        p, c, d, mc, md = want[r.pair_id]
        assert (r.prompt_chars, r.chosen_chars, r.rejected_chars) == (len(p), len(c), len(d))
        assert (r.chosen_trained, r.rejected_trained) == (sum(e - s for s, e in mc), sum(e - s for s, e in md))


def test_borrowed_rejections(spark):
    turns = [(1, 0, U, "a"), (1, 1, A, "b"), (2, 0, U, "c"), (3, 0, U, "d"), (3, 1, A, "e"), (3, 2, U, "f"), (4, 0, A, "g"), (4, 1, A, None), (None, 0, A, "h")]
    got = pf.borrowed_rejections(clashing(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))).collect()
    rej = sorted(((r.pair_id, r.turn, r.text) for r in got if r.side == "rejected"), key=str)
    assert rej == sorted([(1, 0, "a"), (1, 1, "e"), (3, 0, "d"), (3, 1, ""), (3, 2, "f"), (4, 0, "g"), (4, 1, "b")], key=str)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pf.preference_segments(none).collect() == [] and pf.assemble(pf.preference_segments(none)).collect() == []
    c = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert pf.borrowed_rejections(c).collect() == []
