"""Effect estimates on a unit table.

Input: one row per unit with a 0/1 treatment, an outcome and covariates.
Propensity scores come from either a stratum frequency (exact, SQL-stateable)
or MLlib logistic regression; all estimators are single aggregation passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.rows import attach_row
from tessera.session import cut_lineage


def naive_ate(df: DataFrame, t: str = "t", y: str = "y") -> DataFrame:
    """Mean outcome treated minus mean outcome untreated."""
    return df.agg((F.avg(F.when(F.col(t) == 1, F.col(y))) - F.avg(F.when(F.col(t) == 0, F.col(y)))).alias("naive_ate"),
                  F.sum(F.col(t)).cast("long").alias("n_treated"), F.sum(1 - F.col(t)).cast("long").alias("n_control"))


def propensity_strata(df: DataFrame, strata: list[str], t: str = "t", out: str = "e") -> DataFrame:
    """K02 (exact form): share treated within the unit's covariate stratum."""
    s = df.groupBy(*strata).agg(F.avg(F.col(t).cast("double")).alias(out))
    return df.join(s, strata)


def propensity_logistic(df: DataFrame, covariates: list[str], t: str = "t", out: str = "e") -> DataFrame:
    """K02 (model form): logistic regression on assembled covariates (MLlib)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    d = VectorAssembler(inputCols=covariates, outputCol="__x").transform(df.withColumn("__t", F.col(t).cast("double")))
    m = LogisticRegression(featuresCol="__x", labelCol="__t", maxIter=200, tol=1e-10).fit(d)
    return m.transform(d).withColumn(out, vector_to_array("probability")[1]).drop("__x", "__t", "rawPrediction",
                                                                                    "probability", "prediction")


def ipw_ate(df: DataFrame, t: str = "t", y: str = "y", e: str = "e", clip: float = 0.01) -> DataFrame:
    """Inverse-propensity effect, plain (Horvitz-Thompson) and normalised (Hajek), e clipped."""
    ec = F.least(F.greatest(F.col(e), F.lit(clip)), F.lit(1 - clip))
    tt, yy = F.col(t), F.col(y)
    return df.agg(
        (F.avg(tt * yy / ec) - F.avg((1 - tt) * yy / (1 - ec))).alias("ipw_ate"),
        (F.sum(tt * yy / ec) / F.sum(tt / ec) - F.sum((1 - tt) * yy / (1 - ec)) / F.sum((1 - tt) / (1 - ec))).alias(
            "ipw_ate_normalised"))


def psm_matches(df: DataFrame, id_col: str, t: str = "t", e: str = "e", caliper: float = 0.05) -> DataFrame:
    """1-nearest control by propensity distance (ties: smaller control id), within a caliper,
    with replacement. Output ``(id, control_id, distance)`` for matched treated units.

    An as-of join over a range sort: controls are reduced to one candidate per
    distinct score (the smallest id) and the search runs once per distinct
    treated score. Scores are sorted across partitions, so tasks grow with the
    data; inside a partition the last control at or below and the first above
    come from windows, and each partition gets the nearest controls of the
    partitions before and after it (a table of one row per partition).
    """
    ctrl = df.filter(F.col(t) == 0).groupBy(F.col(e).alias("__e")).agg(F.min(id_col).cast("long").alias("__cid")).withColumn("__is_t", F.lit(0))
    tr = df.filter(F.col(t) == 1).select(F.col(e).alias("__e")).distinct().select("__e", F.lit(None).cast("long").alias("__cid"), F.lit(1).alias("__is_t"))
    # controls sort before treated at an equal score, so "below" includes equal scores
    u = cut_lineage(ctrl.unionByName(tr).filter(F.col("__e").isNotNull()).orderBy("__e", "__is_t").withColumn("__mid", F.monotonically_increasing_id()))
    u = u.withColumn("__pid", F.shiftright("__mid", 33)).withColumn("__c", F.when(F.col("__is_t") == 0, F.struct(F.col("__e").alias("e"), F.col("__cid").alias("id"))))
    near = Window.partitionBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.rowsBetween(Window.unboundedPreceding, -1)
    ends = u.groupBy("__pid").agg(F.min_by("__c", F.when(F.col("__is_t") == 0, F.col("__mid"))).alias("__first"), F.max_by("__c", F.when(F.col("__is_t") == 0, F.col("__mid"))).alias("__last"))
    ends = ends.select("__pid", F.last("__last", ignorenulls=True).over(across.orderBy("__pid")).alias("__before"),
                       F.last("__first", ignorenulls=True).over(across.orderBy(F.desc("__pid"))).alias("__after"))
    u = (u.withColumn("__lo", F.last("__c", ignorenulls=True).over(near.orderBy("__mid")))
          .withColumn("__hi", F.last("__c", ignorenulls=True).over(near.orderBy(F.desc("__mid")))).join(F.broadcast(ends), "__pid")
          .withColumn("__lo", F.coalesce("__lo", "__before")).withColumn("__hi", F.coalesce("__hi", "__after")))
    m = u.filter(F.col("__is_t") == 1).select(
        "__e", F.col("__lo.id").alias("lo_id"), (F.col("__e") - F.col("__lo.e")).alias("lo_d"),
        F.col("__hi.id").alias("hi_id"), (F.col("__hi.e") - F.col("__e")).alias("hi_d"))
    pick_lo = F.col("hi_id").isNull() | (F.col("lo_d") < F.col("hi_d")) | (
        (F.col("lo_d") == F.col("hi_d")) & (F.col("lo_id") < F.col("hi_id")))
    m = m.select("__e",
                 F.when(F.col("lo_id").isNotNull() & pick_lo, F.col("lo_id")).otherwise(F.col("hi_id")).alias("control_id"),
                 F.when(F.col("lo_id").isNotNull() & pick_lo, F.col("lo_d")).otherwise(F.col("hi_d")).alias("distance"))
    m = m.filter(F.col("control_id").isNotNull() & (F.col("distance") <= caliper))
    treated = df.filter(F.col(t) == 1).select(F.col(id_col), F.col(e).alias("__e"))
    return treated.join(m, "__e").drop("__e")


def psm_ate(df: DataFrame, matches: DataFrame, id_col: str, y: str = "y") -> DataFrame:
    """Effect on the matched treated = mean(y_treated - y_matched_control)."""
    yt = df.select(F.col(id_col), F.col(y).alias("__yt"))
    yc = df.select(F.col(id_col).alias("control_id"), F.col(y).alias("__yc"))
    j = matches.join(yt, id_col).join(yc, "control_id")
    return j.agg(F.count(F.lit(1)).alias("n_matched"), F.avg(F.col("__yt") - F.col("__yc")).alias("psm_att"))


def ite_strata(df: DataFrame, strata: list[str], t: str = "t", y: str = "y", out: str = "ite") -> DataFrame:
    """Per-row effect estimate = treated minus untreated mean outcome of the unit's stratum."""
    s = df.groupBy(*strata).agg((F.avg(F.when(F.col(t) == 1, F.col(y))) - F.avg(F.when(F.col(t) == 0, F.col(y)))).alias(out))
    return df.join(s, strata)


def ite_forest(train: DataFrame, test: DataFrame, covariates: list[str], t: str = "t", y: str = "y", num_trees: int = 20,
               seed: int = 42, out: str = "ite") -> DataFrame:
    """T-learner, one random forest per arm (MLlib) fitted on ``train``; the effect on the rows of ``test`` is the
    difference of their predictions. String covariates are one-hot coded over the values that ``train`` holds."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    words = [c for c, kind in train.dtypes if c in covariates and kind == "string"]
    stages, cols = [], [c for c in covariates if c not in words]
    if words:
        stages = [StringIndexer(inputCols=words, outputCols=[f"__i_{c}" for c in words], handleInvalid="keep", stringOrderType="alphabetAsc"),
                  OneHotEncoder(inputCols=[f"__i_{c}" for c in words], outputCols=[f"__h_{c}" for c in words])]
        cols += [f"__h_{c}" for c in words]
    d = cut_lineage(train)
    prep = Pipeline(stages=[*stages, VectorAssembler(inputCols=cols, outputCol="__x")]).fit(d)
    d, scored = prep.transform(d), prep.transform(test)
    for arm in (0, 1):
        m = RandomForestRegressor(featuresCol="__x", labelCol=y, numTrees=num_trees, seed=seed, maxDepth=6).fit(d.filter(F.col(t) == arm))
        scored = m.setPredictionCol(f"__m{arm}").transform(scored)
    return scored.select(*test.columns, (F.col("__m1") - F.col("__m0")).alias(out))


def effect_error(df: DataFrame, est: str = "ite", truth: str = "tau") -> DataFrame:
    """Estimated against true effect: error of the average, per-row RMSE, correlation."""
    return df.agg((F.avg(est) - F.avg(truth)).alias("ate_error"),
                  F.sqrt(F.avg(F.pow(F.col(est) - F.col(truth), 2))).alias("rmse"),
                  F.corr(est, truth).alias("correlation"))


def overlap(df: DataFrame, t: str = "t", e: str = "e", bins: int = 10) -> DataFrame:
    """Propensity histogram by arm (uniform bins on [0, 1]) with the share of each arm
    outside the common support [max(min), min(max)] of the two arms."""
    sup = df.groupBy(t).agg(F.min(e).alias("lo"), F.max(e).alias("hi")).agg(
        F.max("lo").alias("__lo"), F.min("hi").alias("__hi"))
    j = attach_row(df, sup)
    b = F.least(F.floor(F.col(e) * bins), F.lit(bins - 1)).cast("long")
    out = (F.col(e) < F.col("__lo")) | (F.col(e) > F.col("__hi"))
    h = j.groupBy(F.col(t).alias("arm"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    o = j.groupBy(F.col(t).alias("arm")).agg(F.avg(out.cast("double")).alias("share_outside_support"))
    return h.join(o, "arm")


def balance(df: DataFrame, covariates: list[str], t: str = "t", e: str = "e", clip: float = 0.01) -> DataFrame:
    """Standardised mean difference per covariate, before and after inverse-propensity weighting."""
    ec = F.least(F.greatest(F.col(e), F.lit(clip)), F.lit(1 - clip))
    w = F.when(F.col(t) == 1, 1 / ec).otherwise(1 / (1 - ec))
    # one pass: every covariate is a row of (covariate, x)
    x = df.select(F.col(t).alias("__t"), w.alias("__w"), F.explode(F.array(*[F.struct(F.lit(c).alias("covariate"), F.col(c).cast("double").alias("x")) for c in covariates])).alias("v"))
    arm = lambda k, v: F.when(F.col("__t") == k, v)
    xv, wv = F.col("v.x"), F.col("__w")
    a = x.groupBy(F.col("v.covariate").alias("covariate")).agg(
        F.avg(arm(1, xv)).alias("m1"), F.avg(arm(0, xv)).alias("m0"), F.var_samp(arm(1, xv)).alias("v1"), F.var_samp(arm(0, xv)).alias("v0"),
        (F.sum(arm(1, wv * xv)) / F.sum(arm(1, wv))).alias("wm1"), (F.sum(arm(0, wv * xv)) / F.sum(arm(0, wv))).alias("wm0"))
    pooled = F.sqrt((F.col("v1") + F.col("v0")) / 2)
    smd = lambda p, q: F.when(pooled == 0, 0.0).otherwise((F.col(p) - F.col(q)) / pooled)
    return a.select("covariate", smd("m1", "m0").alias("smd_before"), smd("wm1", "wm0").alias("smd_after"))
