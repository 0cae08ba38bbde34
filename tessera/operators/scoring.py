"""Score fusion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.skew import prefix_sums
from tessera.operators.evaluate import best_threshold, threshold_sweep


def fuse(df: DataFrame, a: str, b: str, w: float, out: str = "fused") -> DataFrame:
    """W * a + (1 - w) * b."""
    return df.withColumn(out, F.lit(w) * F.col(a) + F.lit(1 - w) * F.col(b))


def fuse_many(df: DataFrame, weights: dict[str, float], out: str = "fused") -> DataFrame:
    """General weighted sum of score columns."""
    e = None
    for c, w in weights.items():
        t = F.lit(w) * F.col(c)
        e = t if e is None else e + t
    return df.withColumn(out, e)


def fusion_grid(df: DataFrame, a: str, b: str, weights_q: list[int], grid: list[int], label: str = "label",
                q: int = 4) -> DataFrame:
    """For each weight w = k/q, the best threshold of w*a + (1-w)*b (one pass over rows).

    Weights are integers over ``q`` (0, 1/4, ... 1) so both engines build the
    same doubles; rows are exploded over the (few) weights and swept together.
    """
    wv = F.explode(F.array(*[F.lit(k) for k in weights_q]))
    d = df.select(label, a, b, wv.alias("wk"))
    d = d.withColumn("weight", F.col("wk") / q).withColumn(
        "fused", F.col("weight") * F.col(a) + (1 - F.col("weight")) * F.col(b))
    sw = threshold_sweep(d, grid, label, "fused", by=["weight"])
    return best_threshold(sw, "f1", by=["weight"])


def improvement(a, b) -> F.Column:
    """Relative improvement (a - b) / a * 100."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return (a - b) / a * 100


def rank_desc(df: DataFrame, score: str, out: str = "rank") -> DataFrame:
    """Competition rank by score descending (1 + rows with a higher score), distributed."""
    g = df.groupBy(F.col(score).alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    g = g.withColumn("__neg", -F.col("__s"))
    r = prefix_sums(g, "__neg", ["__n"], prefix="__above")
    r = r.select(F.col("__s").alias(score), (F.col("__above__n") + 1).cast("long").alias(out))
    return df.join(r, score)


def rank_fusion(df: DataFrame, key: str, scores: list[str], out: str = "mean_rank") -> DataFrame:
    """Ensemble by mean rank over several score columns (lower = better)."""
    d = df.select(key, *scores)
    for s in scores:
        d = rank_desc(d, s, f"{s}_rank")
    return d.withColumn(out, sum(F.col(f"{s}_rank") for s in scores) / len(scores))


def fit_fusion(train: DataFrame, features: list[str], label: str = "label", reg: float | None = None):
    """C11: two-score logistic fusion (L2, no standardisation), coefficients and intercept."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    n = None
    if reg is None:
        n = train.count()
        reg = 1.0 / max(n, 1)  # C = 1 in the liblinear form
    va = VectorAssembler(inputCols=features, outputCol="__fv")
    lr = LogisticRegression(featuresCol="__fv", labelCol=label, regParam=reg, elasticNetParam=0.0,
                            standardization=False, maxIter=100)
    return lr.fit(va.transform(train.withColumn(label, F.col(label).cast("double"))))


def apply_fusion(df: DataFrame, coefs: list[float], intercept: float, features: list[str],
                 out: str = "probability") -> DataFrame:
    """C11 apply: sigmoid(intercept + sum coef * feature) as one expression."""
    z = F.lit(intercept)
    for c, f in zip(coefs, features):
        z = z + F.lit(c) * F.col(f)
    return df.withColumn(out, 1 / (1 + F.exp(-z)))
