"""The pipeline's stages against brute force on the small documents, each stage on its own input."""

import random

from conftest_sf import SF_SMALL
from test_decontaminate import brute as overlaps
from test_mixing import draws, size, water
from test_simhash import brute as groups

import corpus_pipeline
from tessera.llm.common import read


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_against_brute_force(spark):
    docs = read(spark, SF_SMALL, "documents")
    stage = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "decontamination", "mixing", "sharding"]
    good = stage["quality"](spark, docs, SF_SMALL).cache()
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in read(spark, SF_SMALL, "labels").collect()}
    kept = set(ids(good))
    # labelled documents fare as their labels say
    right = [(i in kept) == (q == 1) for i, q in labels.items()]
    assert sum(right) / len(right) >= 0.97 and len(kept) < docs.count()

    one = stage["simhash"](spark, good, SF_SMALL).cache()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert ids(one) == sorted(i for i, _, c in groups(rows) if i == c) and one.columns == docs.columns

    clean = stage["decontamination"](spark, one, SF_SMALL).cache()
    rows = [(r.doc_id, r.text) for r in one.collect()]
    items = [(r.item_id, r.text) for r in read(spark, SF_SMALL, "benchmark").collect()]
    # brute force over the windows is slow: only documents that share five words in a row with an item are tried
    grams = {tuple(w[k:k + 4]) for _, t in items for w in [t.lower().split()] for k in range(len(w) - 3)}
    near = [(i, t) for i, t in rows if any(tuple(w[k:k + 4]) in grams for w in [t.lower().split()] for k in range(len(w) - 3))]
    bad = {r[0] for r in overlaps(near, items)}
    assert bad and ids(clean) == sorted(i for i, _ in rows if i not in bad)

    mixed = stage["mixing"](spark, clean, SF_SMALL).cache()
    left = [(r.doc_id, r.text, r.lang, r.source) for r in clean.collect()]
    sizes, docs_of = {}, [(i, size(t), s) for i, t, _, s in left]
    for _, n, s in docs_of:
        sizes[s] = sizes.get(s, 0) + n
    target, want = water(sizes), []
    for (i, _, s), u in zip(docs_of, draws(left)):
        rate = target[s] / sizes[s]
        want += [i] * (int(rate) + (u < rate - int(rate)))
    assert ids(mixed) == sorted(want) and mixed.columns == docs.columns

    placed = stage["sharding"](spark, mixed, SF_SMALL).collect()
    assert sorted(r.doc_id for r in placed) == sorted(want)
    by = {}
    for r in placed:
        by.setdefault(r.text, set()).add(r.shard)
    assert all(0 <= s < 40 for v in by.values() for s in v)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"] and out.count() > 0


def test_broken_and_empty_tables_pass_every_stage(spark, tmp_path):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("the cat sat on many mats and often ran over there".split()) + str(rng.randrange(60)) for _ in range(40))
    rows = [(i, text(), "en", rng.choice(["a", "b", None])) for i in range(60)]
    rows += [(None, text(), None, "a"), (None, None, "en", None), (5, text(), "en", "a"), rows[7], rows[7], (70, "", "en", "b"), (71, None, None, None), (72, "x " * 20000, "en", "a")]
    full = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    labels = [(i, int(i % 9 > 0), 0) for i in range(40)] + [(None, 1, 0), (3, None, 0)]
    for name, docs in (("some", full), ("none", [])):
        d = tmp_path / name
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([(1, text()), (None, text()), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        out = corpus_pipeline.run(spark, str(d))
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"]
        got = [(r.doc_id, r.text, r.lang, r.source) for r in out.collect()]
        assert set(got) <= set(rows) and bool(got) == bool(docs)
        assert got.count(rows[7]) <= 2  # one of the three equal rows went on, and the mix repeats it at most once
