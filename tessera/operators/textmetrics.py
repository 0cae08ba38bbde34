"""Text-generation metrics (V13-V15, G11, G14) over token arrays, in long form.

Inputs are tables with a row key and two token arrays (hypothesis and
reference). N-grams are counted where the row is, a batch of rows at a time,
and only the counts are summed by Spark; texts of any length are whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _make_ngram_stats(ns: list[int]):
    """Per-row n-gram statistics of a batch of token lists, built as a closure so it ships to Python workers by value.

    For each n: clipped matches, hypothesis n-grams, reference n-grams,
    hypothesis n-grams (with multiplicity) whose gram occurs in the reference.
    The batch's tokens are numbered once; an n-gram's number comes from those
    of its first n-1 tokens and its last, so equal numbers mean equal n-grams
    exactly, and whole batches are counted by sorting numbers.
    """
    import numpy as np
    import pyarrow as pa

    def stats(h: pa.Array, r: pa.Array) -> pa.Array:
        rows = len(h)
        token = pa.concat_arrays([h.flatten(), r.flatten()]).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        size = np.concatenate([x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for x in (h, r)]).astype(np.int64)
        # side 0 is rows 0.., side 1 rows ``rows``..
        row = np.repeat(np.arange(2 * rows), size)
        width, gram, out = int(token.max(initial=0)) + 2, token, []
        for n in range(1, max(ns) + 1):
            if n > 1:
                gram, row = gram[:-1], row[:-1]
                inside = row == whole[n - 1:]
                gram = np.unique(gram * width + (token[n - 1:] + 1), return_inverse=True)[1]
            else:
                whole, inside = row, np.ones(len(row), bool)
            if n in ns:
                g, at = gram[inside], row[inside]
                span = int(g.max(initial=0)) + 1
                key, count = np.unique(at * span + g, return_counts=True)
                hyp = key < rows * span
                both, i, j = np.intersect1d(key[hyp], key[~hyp] - rows * span, assume_unique=True, return_indices=True)
                of, ch, cr = both // span, count[hyp][i], count[~hyp][j]
                left = np.maximum(size - n + 1, 0)
                out += [np.bincount(of, weights=np.minimum(ch, cr), minlength=rows), left[:rows], left[rows:], np.bincount(of, weights=ch, minlength=rows)]
        table = np.stack(out, axis=1).astype(np.int64) if rows else np.zeros((0, 4 * len(ns)), np.int64)
        return pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * table.shape[1], pa.array(table.ravel()))
    return stats


def ngram_stats(df: DataFrame, key: list[str], hyp: str, ref: str, ns: list[int]) -> DataFrame:
    """(key..., n, match, nh, nr, covered) per row and n, from one Arrow UDF that counts whole batches.

    N-gram counting is per document, so it runs where the document already is:
    no n-gram rows are materialised or shuffled; only the per-row numbers
    leave the task.
    """
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf

    batch = _make_ngram_stats(ns)
    batch.__annotations__ = {"h": pa.Array, "r": pa.Array, "return": pa.Array}
    udf = arrow_udf(batch, "array<long>")
    d = df.select(*key, udf(F.col(hyp), F.col(ref)).alias("__st"))
    parts = [F.struct(F.lit(n).alias("n"), *[F.col("__st")[4 * i + j].alias(nm)
                                              for j, nm in enumerate(("match", "nh", "nr", "covered"))])
             for i, n in enumerate(sorted(ns))]
    return d.select(*key, F.explode(F.array(*parts)).alias("x")).select(*key, "x.*")


def corpus_bleu(df: DataFrame, key: list[str], hyp: str = "hyp", ref: str = "ref", max_n: int = 4,
                smooth: float | None = None) -> DataFrame:
    """Corpus BLEU with clipped counts summed over the corpus and a brevity penalty.

    Unsmoothed, any n with zero matches gives 0. With ``smooth`` (0.1), a zero
    count becomes smooth / denominator; no unigram match at all still gives 0.
    Rows with an empty reference are dropped.
    """
    ns = list(range(1, max_n + 1))
    d = df.filter(F.size(ref) > 0)
    # one pass: the unigram totals are the corpus lengths
    per = ngram_stats(d, key, hyp, ref, ns).groupBy("n").agg(
        F.sum("match").alias("match"), F.sum("nh").alias("total"), F.sum("nr").alias("rtotal"))
    if smooth is None:
        p = F.when(F.col("match") == 0, F.lit(None)).otherwise(F.col("match") / F.col("total"))
    else:
        p = F.when(F.col("total") == 0, F.lit(None)).when(F.col("match") == 0, F.lit(smooth) / F.col("total")).otherwise(
            F.col("match") / F.col("total"))
    per = per.withColumn("p", p)
    j = per.agg(F.sum(F.log("p")).alias("__slog"), F.count("p").alias("__np"),
                F.max(F.when(F.col("n") == 1, F.col("match"))).alias("__m1"),
                F.max(F.when(F.col("n") == 1, F.col("total"))).alias("hyp_len"),
                F.max(F.when(F.col("n") == 1, F.col("rtotal"))).alias("ref_len"))
    bp = F.when(F.col("hyp_len") > F.col("ref_len"), F.lit(1.0)).when(F.col("hyp_len") == 0, F.lit(0.0)).otherwise(
        F.exp(1 - F.col("ref_len") / F.col("hyp_len")))
    bleu = F.when((F.col("__np") < max_n) | (F.col("__m1") == 0), F.lit(0.0)).otherwise(bp * F.exp(F.col("__slog") / max_n))
    return j.select(bleu.alias("bleu"), bp.alias("brevity_penalty"), "hyp_len", "ref_len")


def rouge_n(df: DataFrame, key: list[str], n: int, hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    """V15 (ROUGE-1/2): per-row n-gram overlap recall, precision and F1."""
    j = ngram_stats(df, key, hyp, ref, [n])
    rec = F.when(F.col("nr") == 0, 0.0).otherwise(F.col("match") / F.col("nr"))
    prec = F.when(F.col("nh") == 0, 0.0).otherwise(F.col("match") / F.col("nh"))
    return j.select(*key, rec.alias("recall"), prec.alias("precision"),
                    F.when(rec + prec == 0, 0.0).otherwise(2 * rec * prec / (rec + prec)).alias("f1"))


def copy_rate(df: DataFrame, key: list[str], n: int, summary: str = "hyp", source: str = "ref") -> DataFrame:
    """Share of the summary's n-grams (with multiplicity) that occur anywhere in the source.

    Rows whose summary has no n-gram give no value (they are dropped).
    """
    j = ngram_stats(df, key, summary, source, [n]).filter(F.col("nh") > 0)
    return j.select(*key, (F.col("covered") / F.col("nh")).alias("copy_rate"))


def qa_score(df: DataFrame, key: list[str], pred: str = "hyp", gold: str = "ref") -> DataFrame:
    """Exact match of the token sequences and token-multiset F1 per row."""
    j = ngram_stats(df, key, pred, gold, [1]).join(
        df.select(*key, (F.array_join(pred, " ") == F.array_join(gold, " ")).cast("int").alias("exact_match")), key)
    p = F.when(F.col("nh") == 0, 0.0).otherwise(F.col("match") / F.col("nh"))
    r = F.when(F.col("nr") == 0, 0.0).otherwise(F.col("match") / F.col("nr"))
    return j.select(*key, "exact_match", F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r)).alias("token_f1"))


def _make_lcs_len():
    """LCS length of two token sequences by the bit-parallel recurrence (one big-int per row of b).

    V starts all ones over len(a) bits; for each token y of b with match mask
    M[y]: U = V & M[y]; V = (V + U) | (V - U). LCS = len(a) - popcount(V).
    Built as a closure so it ships to Python workers by value.
    """
    def lcs_len(a, b) -> int:
        m = len(a)
        if m == 0 or len(b) == 0:
            return 0
        masks: dict = {}
        for i, x in enumerate(a):
            masks[x] = masks.get(x, 0) | (1 << i)
        full = (1 << m) - 1
        v = full
        for y in b:
            u = v & masks.get(y, 0)
            v = ((v + u) | (v - u)) & full
        return m - bin(v).count("1")
    return lcs_len


_lcs_len = _make_lcs_len()


def rouge_l(df: DataFrame, key: list[str], hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    """V15 (ROUGE-L): LCS-based recall, precision and F1 per row.

    The LCS runs in an Arrow-batched pandas UDF (a small per-row helper); the
    rows themselves stay distributed across tasks like any other column work.
    """
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    lcs_len = _make_lcs_len()

    def lcs_batch(h, r):
        return pd.Series([lcs_len(list(x) if x is not None else [], list(y) if y is not None else [])
                          for x, y in zip(h, r)], dtype="int64")

    # real (not postponed) annotations so Spark recognises a Series -> Series pandas UDF
    lcs_batch.__annotations__ = {"h": pd.Series, "r": pd.Series, "return": pd.Series}
    lcs = pandas_udf(lcs_batch, "long")

    d = df.select(*key, F.size(hyp).alias("nh"), F.size(ref).alias("nr"), lcs(F.col(hyp), F.col(ref)).alias("lcs"))
    rec = F.when(F.col("nr") == 0, 0.0).otherwise(F.col("lcs") / F.col("nr"))
    prec = F.when(F.col("nh") == 0, 0.0).otherwise(F.col("lcs") / F.col("nh"))
    return d.select(*key, "lcs", rec.alias("recall"), prec.alias("precision"),
                    F.when(rec + prec == 0, 0.0).otherwise(2 * rec * prec / (rec + prec)).alias("f1"))
