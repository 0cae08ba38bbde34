"""Sources and sinks (S01-S08), source-corpus labels (X05-X07) and the streaming sweep."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from helpers import SF_SMALL
from tessera.operators import corpus
from tessera.operators.evaluate import threshold_sweep
from tessera.plans.standins import click_rows
from tessera.sources import files as fs
from tessera.sources.tables import table
from tessera.streaming import sweep_state_stream, threshold_sweep_from_state


def _tmp():
    return tempfile.mkdtemp(prefix="tessera-test-")


def test_csv_roundtrip_with_schema(spark):
    d = _tmp()
    src = table(spark, SF_SMALL, "customer").select("c_custkey", "c_name", "c_acctbal")
    src.write.mode("overwrite").option("header", True).csv(f"{d}/c")
    back = fs.read_csv(spark, f"{d}/c", "c_custkey long, c_name string, c_acctbal double")
    assert back.dtypes == src.dtypes
    assert sorted(back.collect()) == sorted(src.collect())


def test_json_documents_keyed_inside_file(spark):
    d = _tmp()
    docs = [{"wikiDocumentIdx": 7, "0": "plain text", "1": {"a": "x", "b": ["y", "z"]}},
            {"wikiDocumentIdx": 9, "0": "other"}]
    for i, doc in enumerate(docs):
        with open(f"{d}/f{i}.json", "w") as f:
            json.dump(doc, f, indent=2)  # multi-line: the whole file is one document
    out = {(r.doc_key, r.section): r.text for r in fs.read_json_documents(spark, f"{d}/*.json", "wikiDocumentIdx").collect()}
    assert out[("7", "0")] == "plain text"
    assert set(out[("7", "1")].split()) == {"x", "y", "z"}
    assert out[("9", "0")] == "other"


def test_read_splits_and_write_dataset(spark):
    d = _tmp()
    e = table(spark, SF_SMALL, "events").select("event_id", "user_id")
    fs.write_dataset(e.filter("event_id % 2 = 0"), f"{d}/train")
    fs.write_dataset(e.filter("event_id % 2 = 1"), f"{d}/test")
    u = fs.read_splits(spark, {"train": f"{d}/train", "test": f"{d}/test"})
    assert u.count() == e.count()
    assert {r.split for r in u.select("split").distinct().collect()} == {"train", "test"}


def test_file_inventory(spark):
    d = _tmp()
    for sub, n in (("a", 3), ("b", 7)):
        os.makedirs(f"{d}/{sub}")
        for i in range(n):
            open(f"{d}/{sub}/f{i}.txt", "w").write("x")
    inv = {os.path.basename(r.directory): (r.n_files, r.first_names) for r in fs.file_inventory(spark, d, 5).collect()}
    assert inv["a"][0] == 3 and inv["b"][0] == 7 and len(inv["b"][1]) == 5


def test_embeddings_csv_and_report(spark):
    d = _tmp()
    e = table(spark, SF_SMALL, "embeddings").select(F.col("vec_id").alias("article_id"), F.lit(0).alias("chunk_id"),
                                                    F.lit("text, with comma").alias("chunk_text"), "embedding")
    fs.write_embeddings_csv(e, f"{d}/emb")
    back = spark.read.option("header", True).option("escape", '"').csv(f"{d}/emb")
    row = back.first()
    assert row.chunk_text == "text, with comma" and len(json.loads(row.embedding)) == 64
    rep = e.select(F.col("article_id").alias("key"), F.lit(1.0).alias("m"))
    fs.write_report(rep, f"{d}/rep", "key", ["m"])
    r = spark.read.option("header", True).csv(f"{d}/rep")
    assert r.filter("key = 'AVERAGE'").first().m == "1.0"
    assert r.count() == e.count() + 1


def test_parse_json_col(spark):
    e = fs.parse_json_col(table(spark, SF_SMALL, "events"), "props", "k int", "p")
    assert e.filter(F.col("p.k").isNull()).count() == 0


def test_source_corpus_labels(spark):
    d = _tmp()
    open(f"{d}/a.c", "w").write(
        "int main() {\n#pragma omp parallel for private(i) reduction(+:s)\nfor (i = 0; i < n; i++) s += i;\n"
        "for (j = 0; j < n; j++) x[j] = 0;\n#pragma omp parallel for\n\nfor (k = 0; k < n; k++) y[k] = k;\n}\n")
    open(f"{d}/b.c", "w").write("void f() {\nfor (i = 0; i < 3; i++) g(i);\n}\n")
    lab = corpus.extract_labels(corpus.read_source_lines(spark, f"{d}/*.c"))
    cl = corpus.clause_labels(lab)
    rows = {(os.path.basename(r.file), r.loop_line): r for r in cl.collect()}
    assert rows[("a.c", 3)].pattern == "PRIVATE+REDUCTION" and rows[("a.c", 3)].pragma_line == 2
    assert rows[("a.c", 4)].pattern == "NONE"
    assert rows[("a.c", 7)].pattern == "PLAIN"
    assert rows[("b.c", 2)].pattern == "NONE"
    per_file, patterns = corpus.annotation_stats(cl)
    pf = {os.path.basename(r.file): (r.n_loops, r.n_annotated) for r in per_file.collect()}
    assert pf == {"a.c": (3, 2), "b.c": (1, 0)}


def test_streaming_sweep_equals_batch(spark):
    d = _tmp()
    grid = list(range(5, 96, 5))
    rows = click_rows(spark, SF_SMALL).select("label", "score")
    rows.repartition(4).write.parquet(f"{d}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in")
    q = (sweep_state_stream(stream, grid).writeStream.outputMode("complete").format("memory")
         .queryName("sweep_state").option("checkpointLocation", f"{d}/ckpt").start())
    q.processAllAvailable()
    q.stop()
    got = {r.threshold: (r.tp, r.fp) for r in threshold_sweep_from_state(spark.table("sweep_state"), grid).collect()}
    want = {r.threshold: (r.tp, r.fp) for r in threshold_sweep(rows, grid).collect()}
    assert got == want


def test_clause_match(spark):
    d = spark.createDataFrame([
        ("#pragma omp parallel for private(i) reduction(+:s)", "#pragma omp parallel for  private(i) reduction(+:s)"),
        ("#pragma omp parallel for reduction(+: s) private(i)", "#pragma omp parallel for private(i) reduction(+:s)"),
        ("#pragma omp parallel for", "#pragma omp parallel for private(j)"),
    ], "pred string, ref string")
    rows = corpus.clause_match(d, "pred", "ref").collect()
    assert [r.exact for r in rows] == [1, 0, 0]
    assert [r.normalised for r in rows] == [1, 1, 0]
    assert rows[2].agree_private == 0 and rows[2].agree_reduction == 1
    rep = corpus.clause_match_report(corpus.clause_match(d, "pred", "ref")).first()
    assert abs(rep.normalised_rate - 2 / 3) < 1e-12


def test_rouge_l_brute_force(spark):
    from tessera.operators import textmetrics as tm
    pairs = [("a b c d e".split(), "a c e".split()), ("x y".split(), "y x".split()), ([], "a".split())]
    d = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)], "k int, hyp array<string>, ref array<string>")
    got = {r.k: r.lcs for r in tm.rouge_l(d, ["k"]).collect()}
    assert got == {0: 3, 1: 1, 2: 0}
