"""Evaluation over score tables.

Input is a table with a label column (0/1), a score column and/or a
prediction column. Every metric is one aggregation pass (plus, for ranking
metrics, a pre-aggregation by distinct score and distributed prefix sums).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import safe_div
from tessera.functions.skew import exact_quantiles, prefix_sums
from tessera.functions.rows import attach_row
from tessera.session import cut_lineage

EPS_DOUBLE = 2.220446049250313e-16  # fixed value: machine epsilon of float64


def rmse(df: DataFrame, actual: str = "rating", pred: str = "prediction") -> DataFrame:
    """MSE and RMSE over rows that have a prediction."""
    e2 = F.when(F.col(pred).isNotNull(), F.pow(F.col(actual) - F.col(pred), 2))
    return df.agg(F.count(pred).alias("n"), F.avg(e2).alias("mse"), F.sqrt(F.avg(e2)).alias("rmse"))


def _confusion_cols(label: str, pred: str):
    y, p = F.col(label), F.col(pred)
    return [F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
            F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
            F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
            F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp")]


def confusion(df: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None) -> DataFrame:
    """Confusion counts tn fp fn tp (optionally per slice)."""
    g = df.groupBy(*(by or []))
    return g.agg(*_confusion_cols(label, pred))


def with_rates(conf: DataFrame) -> DataFrame:
    """V03 from V02: accuracy, precision, recall, F1; 0 when a denominator is 0."""
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec = safe_div(tp, tp + fp)
    rec = safe_div(tp, tp + fn)
    return (conf.withColumn("accuracy", safe_div(tp + tn, tp + tn + fp + fn))
                .withColumn("precision", prec).withColumn("recall", rec)
                .withColumn("f1", safe_div(2 * tp, 2 * tp + fp + fn)))


def classification_report(df: DataFrame, label: str = "label", pred: str = "pred",
                          by: list[str] | None = None) -> DataFrame:
    """V03 (and V23 with ``by``): accuracy / precision / recall / F1 per slice."""
    return with_rates(confusion(df, label, pred, by))


def grid_hundredths(lo: int, hi: int, step: int) -> list[int]:
    """Threshold grid as integer hundredths (0.05..0.95 by 0.01 = 5..95 by 1)."""
    return list(range(lo, hi + 1, step))


def threshold_sweep(df: DataFrame, grid: list[int], label: str = "label", score: str = "score",
                    by: list[str] | None = None) -> DataFrame:
    """Confusion and F1 for every threshold t = g/100 of the grid, predicting score >= t.

    One pass over the rows: each row falls into the bucket of the largest grid
    threshold it reaches (exact comparisons against g/100.0), giving a tiny
    (by, bucket, pos, neg) table; counts per threshold are suffix sums of it.
    ``by`` runs one sweep per slice (e.g. per fusion weight) in the same pass;
    every slice, a null one too, gets a row for every threshold.
    """
    by = by or []
    if any(x in by for x in ("g", "threshold")):
        raise ValueError("a slice column may not be called g or threshold: the result has these")
    g = sorted(grid)

    def place(lo: int, hi: int):  # a row is compared with log2 of the thresholds; a null score reaches none
        mid = (lo + hi) // 2
        return F.lit(lo) if lo == hi else F.when(F.col(score) >= g[mid] / 100.0, place(mid + 1, hi)).otherwise(place(lo, mid))

    # index (1-based) of the largest threshold <= score; 0 = below all
    bucket = place(0, len(g))
    h = (df.select(*[F.col(x).alias(f"__by{k}") for k, x in enumerate(by)], bucket.alias("__b"), F.col(label).cast("long").alias("__y"))
           .groupBy(*[f"__by{k}" for k in range(len(by))], "__b").agg(F.sum("__y").alias("__pos"), F.sum(1 - F.col("__y")).alias("__neg")))
    keys = [f"__by{k}" for k in range(len(by))]
    # a slice's bucket counts as one small map (at most grid + 1 entries), so that every slice gets every threshold
    counts = h.groupBy(*keys).agg(F.collect_list(F.struct("__b", "__pos", "__neg")).alias("__h"))
    upto = lambda k, f: F.aggregate(F.filter("__h", lambda x: x["__b"] >= k), F.lit(0).cast("long"), lambda s, x: s + x[f])
    rows = F.explode(F.array(*[F.struct(F.lit(k + 1).alias("gi"), F.lit(x).alias("g")) for k, x in enumerate(g)]))
    out = counts.withColumn("__g", rows).filter(F.size("__h") > 0)
    tp, fp, pos, neg = upto(F.col("__g.gi"), "__pos"), upto(F.col("__g.gi"), "__neg"), upto(F.lit(0), "__pos"), upto(F.lit(0), "__neg")
    out = out.select(*[F.col(f"__by{k}").alias(x) for k, x in enumerate(by)], F.col("__g.g").alias("g"), tp.alias("tp"), fp.alias("fp"),
                     (pos - tp).alias("fn"), (neg - fp).alias("tn"), (F.col("__g.g") / 100.0).alias("threshold"))
    return with_rates(out)


def best_threshold(sweep: DataFrame, metric: str = "f1", by: list[str] | None = None) -> DataFrame:
    """The threshold with the best metric; lowest threshold on ties (per slice with ``by``)."""
    if not by:
        return sweep.orderBy(F.desc(metric), "threshold").limit(1)
    w = Window.partitionBy(*by).orderBy(F.desc(metric), "threshold")
    return sweep.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def _score_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    return (df.groupBy(F.col(score).alias("s"))
              .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                   F.sum(1 - F.col(label).cast("long")).alias("neg")))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ROC-AUC with tied scores counted half (Mann-Whitney form).

    Rows are first reduced to one row per distinct score; the count of
    negatives below each score comes from distributed prefix sums.
    """
    g = prefix_sums(_score_groups(df, label, score), "s", ["neg"])
    return g.agg(((F.sum(F.col("pos") * F.col("below_neg")) + 0.5 * F.sum(F.col("pos") * F.col("neg")))
                  / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Average precision = sum over distinct scores of (R_i - R_{i-1}) * P_i."""
    g = prefix_sums(_score_groups(df, label, score), "s", ["pos", "neg"], totals=True)
    # predicted positive at threshold s: all rows with score >= s
    j = g.withColumnRenamed("total_pos", "P").withColumnRenamed("total_neg", "N")
    tp = F.col("P") - F.col("below_pos")
    fp = F.col("N") - F.col("below_neg")
    return j.agg(F.sum(F.col("pos") / F.col("P") * (tp / (tp + fp))).alias("average_precision"))


def log_loss(df: DataFrame, label: str = "label", score: str = "score", eps: float = EPS_DOUBLE) -> DataFrame:
    """Mean negative log-likelihood with probabilities clipped to [eps, 1-eps]."""
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label)
    return df.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def brier(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Mean squared difference of probability and outcome."""
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def calibration_uniform(df: DataFrame, n_bins: int = 10, label: str = "label", score: str = "score") -> DataFrame:
    """Uniform bins closed on the right; mean predicted and fraction positive per non-empty bin."""
    b = F.greatest(F.ceil(F.col(score) * n_bins) - 1, F.lit(0)).cast("long")
    return (df.groupBy(b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_predicted"),
                   F.avg(F.col(label).cast("double")).alias("fraction_positive")))


def calibration_quantile(df: DataFrame, n_bins: int = 10, label: str = "label", score: str = "score",
                         exact: bool = True) -> DataFrame:
    """Quantile bins; edges are the score percentiles 1/n .. (n-1)/n.

    A row's bin = number of inner edges strictly below its score (so bins are
    closed on the right). ``exact=False`` uses ``percentile_approx`` edges,
    the path for very large tables.
    """
    probs = [i / n_bins for i in range(1, n_bins)]
    if exact:  # distributed exact quantiles: one row of n_bins - 1 edges
        q = exact_quantiles(df, score, probs)
        edges = q.select(F.array(*[F.col(f"q{i}") for i in range(len(probs))]).alias("edges"))
    else:
        edges = df.agg(F.percentile_approx(score, F.array(*[F.lit(p) for p in probs]), 10000).alias("edges"))
    j = attach_row(df, edges)
    b = F.size(F.filter("edges", lambda x: x < F.col(score))).cast("long")
    return (j.groupBy(b.alias("bin"))
             .agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_predicted"),
                  F.avg(F.col(label).cast("double")).alias("fraction_positive")))


def _class_report(t: DataFrame) -> DataFrame:
    """Rows per class, macro and micro from ``(cls, tp, n_pred, n_true)``."""
    per = t.select(F.col("cls").cast("string").alias("cls"), safe_div("tp", "n_pred").alias("precision"), safe_div("tp", "n_true").alias("recall"),
                   safe_div(2 * F.col("tp"), F.col("n_pred") + F.col("n_true")).alias("f1"))
    macro = per.agg(F.lit("macro").alias("cls"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"))
    s = t.agg(F.sum("tp").alias("tp"), F.sum("n_pred").alias("np"), F.sum("n_true").alias("nt"))
    micro = s.select(F.lit("micro").alias("cls"), safe_div("tp", "np").alias("precision"), safe_div("tp", "nt").alias("recall"),
                     safe_div(2 * F.col("tp"), F.col("np") + F.col("nt")).alias("f1"))
    return per.unionByName(macro).unionByName(micro)


def _class_counts(rows: DataFrame) -> DataFrame:
    """``(cls, tp, n_pred, n_true)`` of rows (cls, t, p), written once for the three parts of a report."""
    n = lambda c, name: F.sum(c.cast("long")).alias(name)
    return cut_lineage(rows.groupBy("cls").agg(n(F.col("t") & F.col("p"), "tp"), n(F.col("p"), "n_pred"), n(F.col("t"), "n_true")))


def per_class_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Per-class precision / recall / F1 for multi-class predictions, plus macro and micro rows, in one pass over the rows."""
    hit = F.col(label).eqNullSafe(F.col(pred))
    sides = F.array(F.struct(F.col(label).alias("cls"), F.lit(True).alias("t"), hit.alias("p")), F.struct(F.col(pred).alias("cls"), F.lit(False).alias("t"), F.lit(True).alias("p")))
    # a right prediction is one row that is both, a wrong one a row of either class
    return _class_report(_class_counts(df.select(F.inline(F.filter(sides, lambda x: x["t"] | ~hit)))))


def multi_label_report(df: DataFrame, labels: str = "labels", preds: str = "preds") -> DataFrame:
    """V12 for label sets: precision / recall / F1 of each label, plus macro and micro rows; repeated labels of a row count once."""
    row = df.select(F.coalesce(labels, F.array().cast("array<string>")).alias("l"), F.coalesce(preds, F.array().cast("array<string>")).alias("q"))
    return _class_report(_class_counts(row.select(F.inline(F.transform(F.array_union("l", "q"), lambda c: F.struct(
        c.alias("cls"), F.array_contains("l", c).alias("t"), F.array_contains("q", c).alias("p")))))))


def cube_report(df: DataFrame, by: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """V23 for several conditions: the V03 report of every combination of slices and totals in one pass.

    ``level`` has a bit set (the first condition's is the highest) where a condition is summed over, which tells a
    total from a slice whose value is null.
    """
    return with_rates(df.cube(*by).agg(F.grouping_id().cast("long").alias("level"), *_confusion_cols(label, pred)))


def recall_at_k(ranked: DataFrame, truth: DataFrame, ks: list[int], query: str = "query",
                item: str = "item", rank: str = "rank") -> DataFrame:
    """Share of queries whose best-ranked true item is within k, for each k."""
    hit = (ranked.join(truth.select(query, item), [query, item], "left_semi")
                 .groupBy(query).agg(F.min(rank).alias("first_hit")))
    q = truth.select(query).distinct().join(hit, query, "left")
    return q.agg(*[F.avg(F.coalesce((F.col("first_hit") <= k).cast("double"), F.lit(0.0))).alias(f"recall_at_{k}")
                   for k in ks])


def precision_recall_at_k(ranked: DataFrame, relevant: DataFrame, k: int, user: str = "user",
                          item: str = "item", rank: str = "rank") -> DataFrame:
    """Mean precision@k and recall@k over users with at least one relevant item."""
    top = ranked.filter(F.col(rank) <= k)
    hits = top.join(relevant.select(user, item), [user, item], "left_semi").groupBy(user).agg(
        F.count(F.lit(1)).alias("hits"))
    nrel = relevant.groupBy(user).agg(F.count(F.lit(1)).alias("n_rel"))
    j = nrel.join(hits, user, "left").fillna(0, ["hits"])
    return j.agg(F.avg(F.col("hits") / F.lit(k)).alias(f"precision_at_{k}"),
                 F.avg(F.col("hits") / F.col("n_rel")).alias(f"recall_at_{k}"))


def error_types(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Per-row error type (Correct / False Positive / False Negative) and counts."""
    t = (F.when(F.col(label) == F.col(pred), F.lit("Correct"))
          .when(F.col(pred) == 1, F.lit("False Positive"))
          .otherwise(F.lit("False Negative")))
    return df.withColumn("error_type", t)


def worst_errors(df: DataFrame, n: int, key: str, label: str = "label", pred: str = "pred",
                 score: str = "score") -> DataFrame:
    """N false positives with the highest score and n false negatives with the lowest."""
    fp = df.filter((F.col(pred) == 1) & (F.col(label) == 0)).orderBy(F.desc(score), key).limit(n)
    fn = df.filter((F.col(pred) == 0) & (F.col(label) == 1)).orderBy(F.asc(score), key).limit(n)
    return (fp.withColumn("error_type", F.lit("False Positive"))
              .unionByName(fn.withColumn("error_type", F.lit("False Negative"))))


def model_disagreement(df: DataFrame, label: str, pred_a: str, pred_b: str) -> DataFrame:
    """Rows wrong under A and right under B ("rescued") and the reverse ("hurt")."""
    ra = F.col(pred_a) == F.col(label)
    rb = F.col(pred_b) == F.col(label)
    return df.withColumn("change", F.when(~ra & rb, F.lit("rescued")).when(ra & ~rb, F.lit("hurt"))
                         .when(ra & rb, F.lit("both right")).otherwise(F.lit("both wrong")))


def split_gap(metrics: DataFrame, split: str, a: str, b: str, metric_cols: list[str],
              by: list[str] | None = None) -> DataFrame:
    """metric(a) - metric(b) per metric (e.g. validation minus test)."""
    ga = metrics.filter(F.col(split) == a).select(*(by or []), *[F.col(m).alias(f"{m}_{a}") for m in metric_cols])
    gb = metrics.filter(F.col(split) == b).select(*(by or []), *[F.col(m).alias(f"{m}_{b}") for m in metric_cols])
    j = ga.join(gb, by) if by else attach_row(ga, gb)
    for m in metric_cols:
        j = j.withColumn(f"{m}_gap", F.col(f"{m}_{a}") - F.col(f"{m}_{b}"))
    return j


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement rate and Cohen's kappa of two categorical verdict columns."""
    n = F.count(F.lit(1))
    obs = df.agg(n.alias("n"), F.avg((F.col(a) == F.col(b)).cast("double")).alias("observed"))
    pa = df.groupBy(F.col(a).alias("v")).agg(F.count(F.lit(1)).alias("na"))
    pb = df.groupBy(F.col(b).alias("v")).agg(F.count(F.lit(1)).alias("nb"))
    exp = pa.join(pb, "v").agg(F.sum(F.col("na") * F.col("nb")).alias("ab"))
    j = attach_row(obs, exp)
    pe = F.col("ab") / (F.col("n") * F.col("n"))
    return j.select("n", "observed", pe.alias("expected"),
                    F.when(pe == 1, F.lit(1.0)).otherwise((F.col("observed") - pe) / (1 - pe)).alias("kappa"))


def agreement_matrix(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows of every pair of verdicts with their share of all rows: ``(a, b, n, share)``."""
    m = df.groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return attach_row(m, df.agg(F.count(F.lit(1)).alias("__all"))).select("a", "b", "n", (F.col("n") / F.col("__all")).alias("share"))
