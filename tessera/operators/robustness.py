"""Attack, membership and robustness summaries over prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.rows import attach_row
from tessera.operators.evaluate import roc_auc


def attack_success(df: DataFrame, target, label: str = "label", pred: str = "predicted",
                   triggered: str = "triggered") -> DataFrame:
    """Share of triggered rows whose true class is not the target that are predicted as the target."""
    d = df.filter(F.col(triggered) & (F.col(label) != F.lit(target)))
    return d.agg(F.count(F.lit(1)).alias("n_triggered"),
                 F.avg((F.col(pred) == F.lit(target)).cast("double")).alias("attack_success_rate"))


def membership_attack(df: DataFrame, grid: list[float], loss: str = "loss", member: str = "member") -> DataFrame:
    """Loss-threshold membership test: best advantage TPR - FPR over the grid, and AUC of -loss."""
    spark = df.sparkSession
    g = spark.createDataFrame([(float(t),) for t in grid], "t double")
    ex = df.select(F.col(loss).alias("__l"), F.col(member).cast("int").alias("__m"))
    # one pass per threshold on a (grid x rows) join would be wasteful: bucket rows by threshold index
    arr = F.array(*[F.lit(float(t)) for t in sorted(grid)])
    b = ex.select(F.size(F.filter(arr, lambda t: F.col("__l") > t)).alias("__b"), "__m")
    h = b.groupBy("__b").agg(F.sum("__m").alias("pos"), F.sum(1 - F.col("__m")).alias("neg"))
    gi = spark.createDataFrame([(i, float(t)) for i, t in enumerate(sorted(grid))], "gi int, t double")
    # predicted member when loss <= t  <=>  rows whose count of thresholds below their loss <= gi
    c = gi.join(F.broadcast(h), F.col("__b") <= F.col("gi"), "left").groupBy("gi", "t").agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("tp"), F.coalesce(F.sum("neg"), F.lit(0)).alias("fp"))
    tot = h.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    c = attach_row(c, tot).withColumn("advantage", F.col("tp") / F.col("P") - F.col("fp") / F.col("N"))
    best = c.agg(F.max("advantage").alias("best_advantage"))
    auc = roc_auc(df.select(F.col(member).cast("int").alias("label"), (-F.col(loss)).alias("score")))
    return attach_row(best, auc)


def robustness(metrics: DataFrame, by: str, condition: str, clean: str, metric_cols: list[str]) -> DataFrame:
    """Metric under each changed condition minus the metric on the clean condition (per slice)."""
    base = metrics.filter(F.col(condition) == clean).select(by, *[F.col(m).alias(f"__clean_{m}") for m in metric_cols])
    d = metrics.filter(F.col(condition) != clean).join(base, by)
    for m in metric_cols:
        d = d.withColumn(f"{m}_delta", F.col(m) - F.col(f"__clean_{m}"))
    return d.drop(*[f"__clean_{m}" for m in metric_cols])


def horizon_error(df: DataFrame, horizon: str, err: str, edges: list[int], inside: str, by: list[str] | None = None) -> DataFrame:
    """RMSE by horizon bucket (bucket i = horizon in (edge[i-1], edge[i]]), inside / outside the trained range,
    and by further columns such as the noise level."""
    arr = F.array(*[F.lit(e) for e in edges])
    b = F.size(F.filter(arr, lambda e: F.col(horizon) > e)).cast("long")
    return df.groupBy(*(by or []), b.alias("bucket"), F.col(inside).alias("inside_range")).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.col(err) * F.col(err))).alias("rmse"))


def unlearning_table(preds: DataFrame, target, model: str = "model", label: str = "label", pred: str = "predicted", triggered: str = "triggered",
                     loss: str = "loss", member: str = "member", cut: float = 0.5) -> DataFrame:
    """One row per model: clean accuracy, trigger success rate, and membership advantage, in one pass.

    Accuracy is over rows without the trigger, the rate over triggered rows of
    other classes, and the advantage is the share of members minus that of
    non-members whose clean loss is at most ``cut``.
    """
    share = lambda cond, hit: F.avg(F.when(cond, hit.cast("double")))
    clean, low = ~F.col(triggered), F.col(loss) <= cut
    return preds.groupBy(model).agg(
        share(clean, F.col(label) == F.col(pred)).alias("clean_accuracy"), share(F.col(triggered) & (F.col(label) != F.lit(target)), F.col(pred) == F.lit(target)).alias("trigger_rate"),
        (share(clean & F.col(member), low) - share(clean & ~F.col(member), low)).alias("membership_advantage"))
