import math
import os
import zlib
from collections import Counter

import pytest
import regex
from conftest_sf import SF_SMALL
from helpers_llm import clashing, docs_of

from tessera.llm import langid
from tessera.llm.common import read


def pieces(word, n):
    marked = word if n == 1 else "_" + word + "_"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Plain:
    """The rule over dictionaries: words by smoothed log frequency, unseen ones by the mean of their longest known pieces."""

    def __init__(self, counts, totals, langs):
        """counts: (order, feature) -> language -> n; totals: (order, language) -> n; order 0 is the words."""
        self.langs, self.counts = langs, counts
        size = Counter(k for k, _ in counts)
        self.log = lambda f: [math.log((counts[f].get(x, 0) + 0.1) / (totals.get((f[0], x), 0) + 0.1 * (size[f[0]] + 1))) for x in langs]

    def word(self, w):
        for order in (0, 4, 3, 2, 1):
            known = [f for f in ([(0, w)] if order == 0 else [(order, g) for g in pieces(w, order)]) if f in self.counts]
            if known:
                return [sum(col) / len(known) for col in zip(*map(self.log, known))]
        return [0.0] * len(self.langs)

    def predict(self, text):
        words = regex.findall(r"\p{L}+", (text or "").lower())
        if not words or not self.langs:
            return "und", 0.0
        total = [0.0] * len(self.langs)
        for w, n in Counter(words).items():
            total = [a + n * b for a, b in zip(total, self.word(w))]
        top = max(total)
        best = next(i for i, x in enumerate(total) if x >= top - 1e-12 * (1 + abs(top)))
        return self.langs[best], 1 / sum(math.exp(x - total[best]) for x in total)


def plain(rows):
    """Counts over the documents that aren't held out, by a straight loop."""
    counts, totals = {}, {}
    for i, t, lang, *_ in rows:
        if i is None or t is None or lang is None or zlib.crc32(str(i).encode()) % 4 == 2:
            continue
        for w in regex.findall(r"\p{L}+", t.lower()):
            for f in [(0, w)] + [(k, g) for k in (4, 3, 2, 1) for g in pieces(w, k)]:
                counts.setdefault(f, Counter())[lang] += 1
                totals[f[0], lang] = totals.get((f[0], lang), 0) + 1
    return Plain(counts, totals, sorted({x for k, x in totals if k == 0}))


ROWS = [(i, t, lang) for i, (t, lang) in enumerate([
    ("the cat and the dog of the house", "en"), ("le chat et la maison de la ville", "fr"), ("der Hund und die Katze", "de"), ("el perro y la casa de los gatos", "es"),
    ("the of and to in", "en"), ("unhappiness thereof", "en"), ("maisonnette", "fr"), ("Häuser Straße", "de"), (None, "en"), ("", "fr"), ("123 456 !!!", "de"),
    ("new words here", None), ("qqq", "en"), ("żółw", "fr"), ("the " * 20000, "en"), ("la la la", "es"), ("la", "fr"), ("x", "en")] * 3)] + [(None, "the cat", "en"), (3, "der die das", "de")]


def test_against_a_plain_model(spark):
    d = clashing(docs_of(spark, ROWS))
    m = plain(ROWS)
    got = sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in langid.identify(d).collect()), key=str)
    want = sorted(((i, i is not None and zlib.crc32(str(i).encode()) % 4 == 2, (p := m.predict(t))[0], round(p[1], 9)) for i, t, _ in ROWS), key=str)
    assert got == want
    assert all(0 <= g[3] <= 1 for g in got) and ("und", 0.0) in {g[2:] for g in got}


@pytest.mark.parametrize("hot", [0, 40])
def test_shuffled_features_give_the_same(spark, monkeypatch, hot):
    monkeypatch.setattr(langid, "HOT", hot)
    test_against_a_plain_model(spark)


def test_labels_and_sources_of_the_predicted_documents_are_not_used(spark):
    other = [(i, t, lang if i is None or zlib.crc32(str(i).encode()) % 4 != 2 else "xx") for i, t, lang in ROWS]
    a = langid.identify(docs_of(spark, ROWS)).collect()
    b = langid.identify(docs_of(spark, [(*r, "s") for r in other])).collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def test_backoff_order(spark):
    teach = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2]
    ask = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(teach[0], "the the the", "en"), (teach[1], "abcq abcu", "fr"), (teach[2], "xyabz", "en"), (teach[3], "ö", "de")]
    asked = {"the": "en", "abcd": "fr", "wyabz": "en", "kabz": "en", "ukq": "fr", "öww": "de", "www": "de"}  # a word, pieces of 4, 3 and 1; nothing known ties, by code point
    rows += [(ask[k], w, None) for k, w in enumerate(asked)]
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs_of(spark, rows)).collect()}
    assert {w: got[ask[k]] for k, w in enumerate(asked)} == asked
    m = plain(rows)
    assert {w: m.predict(w)[0] for w in asked} == asked


def test_held_out_accuracy(spark):
    d = read(spark, SF_SMALL, "documents")
    j = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(j) > 30 and sum(r.lang == r.lang_pred for r in j) / len(j) >= 0.95


def test_every_word_gram_and_language_is_kept(spark):
    """More languages, words and n-grams than a model of fixed size held (64, 100,000, 20,000): the rare ones count too."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i: "".join(letters[i // 26 ** k % 26] for k in range(4))
    common = " ".join(word(i) for i in range(110_000))
    taught = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2][:72]
    rows = [(taught[0], common, "l00"), (taught[1], common, "l00")]
    rows += [(i, f"ж{chr(0x4e00 + k)}ф " + f"я{chr(0x5e00 + k)}дл", f"l{k:02d}") for k, i in enumerate(taught[2:], 1)]
    asked = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2][:70]
    rows += [(i, f"ж{chr(0x4e00 + k)}ф" if k % 2 else f"оя{chr(0x5e00 + k)}дл", None) for k, i in enumerate(asked, 1)]
    m = plain(rows)
    size = Counter(k for k, _ in m.counts)
    assert len(m.langs) > 64 and size[0] > 100_000 and size[4] > 20_000
    got = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in langid.identify(docs_of(spark, rows)).collect()}
    assert [got[i][0] for i in asked] == [f"l{k:02d}" for k in range(1, 71)]
    assert all(got[i] == ((p := m.predict(t))[0], round(p[1], 9)) for i, t, _ in rows)


def test_empty(spark):
    assert langid.identify(docs_of(spark, [])).collect() == []
    untaught = langid.identify(docs_of(spark, [(1, "some words", None)])).collect()
    assert [(r.lang_pred, r.score) for r in untaught] == [("und", 0.0)]


def test_words_of_the_rows_take_little_disk(spark):
    """op7's disk: 200,000 distinct words in every text, beyond Parquet's own dictionary, are not written out once per text."""
    order = lambda k: sorted(range(200_000), key=lambda i: zlib.crc32(f"{k} {i}".encode()))
    word = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(4)) * 4
    texts = [(k, " ".join(map(word, order(k))), "en") for k in range(6)]
    c = langid.counted(docs_of(spark, texts).coalesce(1))
    written = sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in c.inputFiles())
    assert c.agg({"row": "count"}).first()[0] == 6 and written < 0.4 * sum(len(t) for _, t, _ in texts)


def test_common_words_are_not_shuffled_to_find_the_unseen(spark, monkeypatch):
    """op7's disk: only words that the model lacks, or that are rare, travel; words without a known n-gram add nothing."""
    c = langid.counted(docs_of(spark, ROWS))
    m = langid._fit(c)
    seen = {r.word for r in m.words.collect()}
    got = {r.word: r.kind for d in langid._unseen(c, m) for r in d.collect()}
    asked = {w for i, t, _ in ROWS for w in regex.findall(r"\p{L}+", (t or "").lower())}
    assert set(got) == asked - seen
    assert all((k == langid.UNKNOWN) == (m.base[k] == 0).all() for k in got.values())
    one = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    other = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2)
    rows = [(other, "abc abc def", "en"), (other + 1000, "ghi", "fr"), (one, "zzz zzz abc", None), (one, "zzz", None)]
    p = plain(rows)
    assert sorted((r.lang_pred, round(r.score, 9)) for r in langid.identify(docs_of(spark, rows)).collect()) == sorted(
        ((x := p.predict(t))[0], round(x[1], 9)) for _, t, _ in rows)
