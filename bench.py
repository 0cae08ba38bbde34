"""Benchmark: wall time of the headline queries at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma list to run other registered queries).
Each query is executed in full (``noop`` sink: every row computed, nothing
collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.session import get_spark  # noqa: E402

HEADLINE = [
    "V01_neighbour_rmse",          # flow A: split, user cosine, top-k, prediction, RMSE
    "C07_recommend_top10",         # recommendation lists
    "V04_pair_threshold_sweep",    # flow B: pairs, char TF-IDF, pair cosine, sweep
    "N07_knn_top5_embeddings",     # exact blocked kNN
    "V04_threshold_sweep",         # one-pass sweep over scored rows
    "V06_roc_auc",                 # rank metric with distributed prefix sums
    "T12_tfidf_char_3_5",          # text vectorisation
    "V13_corpus_bleu",             # corpus BLEU over whole documents
    "G06_flat_retrieve_top5",      # term retrieval
    "K04_psm_att",                 # caliper matching
    "E06_describe_lineitem",       # profiling
    "F04_encode_test_rows",        # fit / apply features
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      extra={"spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024)})
    from tessera.plans import QUERIES
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed
    times = {}
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
