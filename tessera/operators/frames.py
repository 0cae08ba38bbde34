"""Frames, masks and images as tables.

Frames are rows keyed by (sequence, frame[, instance]); masks and images are
long pixel tables keyed by (image, pixel). Temporal work is a join on
``frame + 1`` (an equi-join, not a window over a whole sequence), image
metrics are group-by aggregates per image.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def consecutive(df: DataFrame, seq: str = "sequence", frame: str = "frame", keys: list[str] | None = None) -> DataFrame:
    """Pairs of rows whose frame numbers differ by exactly 1 inside a sequence (and instance)."""
    k = [seq, *(keys or [])]
    prev = df.select(*k, (F.col(frame) + 1).alias(frame), *[F.col(c).alias(f"prev_{c}") for c in df.columns if c not in k])
    return df.join(prev, [*k, frame])


def temporal_stability(df: DataFrame, value: str, seq: str = "sequence", frame: str = "frame",
                       instance: str = "instance") -> DataFrame:
    """Per sequence, mean and max absolute change of a value between consecutive frames of an instance."""
    c = consecutive(df.select(seq, frame, instance, value), seq, frame, [instance])
    d = c.withColumn("change", F.abs(F.col(value) - F.col(f"prev_{value}")))
    return d.groupBy(seq).agg(F.count(F.lit(1)).alias("n_pairs"), F.avg("change").alias("mean_change"),
                              F.max("change").alias("max_change"))


def excess_change(pred: DataFrame, truth: DataFrame, value: str, seq: str = "sequence", frame: str = "frame",
                  instance: str = "instance", variant: str | None = None) -> DataFrame:
    """Model change minus true change between consecutive frames, only where both frames have truth; per sequence and,
    with ``variant`` naming a column of ``pred``, per model precision (truth is joined once for all of them)."""
    k, v = [seq, frame, instance], [variant] if variant else []
    j = pred.select(*k, *v, F.col(value).alias("p")).join(truth.select(*k, F.col(value).alias("t")), k)
    c = consecutive(j, seq, frame, [instance, *v])
    d = c.withColumn("excess", F.abs(F.col("p") - F.col("prev_p")) - F.abs(F.col("t") - F.col("prev_t")))
    return d.groupBy(seq, *v).agg(F.count(F.lit(1)).alias("n_pairs"), F.avg("excess").alias("mean_excess"))


def instance_churn(df: DataFrame, seq: str = "sequence", frame: str = "frame", instance: str = "instance") -> DataFrame:
    """Per sequence, instances appearing and disappearing between frame f and f+1 (both frames present)."""
    frames = df.select(seq, frame).distinct()
    pairs = frames.join(frames.select(seq, (F.col(frame) - 1).alias(frame)), [seq, frame])  # f with f+1 present
    cur = df.select(seq, frame, instance).distinct().join(pairs, [seq, frame])
    nxt = df.select(seq, (F.col(frame) - 1).alias(frame), instance).distinct().join(pairs, [seq, frame])
    j = cur.withColumn("__c", F.lit(1)).join(nxt.withColumn("__n", F.lit(1)), [seq, frame, instance], "full")
    return j.groupBy(seq).agg(F.sum(F.when(F.col("__c").isNull(), 1).otherwise(0)).cast("long").alias("appeared"),
                              F.sum(F.when(F.col("__n").isNull(), 1).otherwise(0)).cast("long").alias("disappeared"))


def variant_report(df: DataFrame, by: str, variant: str, metric: str, variants: list[str]) -> DataFrame:
    """A metric per (slice, variant), variants side by side (pivot on a declared value list)."""
    return df.groupBy(by).pivot(variant, variants).agg(F.avg(metric))


def variant_reports(df: DataFrame, by: list[str], variant: str, metric: str, variants: list[str]) -> DataFrame:
    """I06 for several conditions (size bucket, density, sequence): ``(condition, slice, n, one column per variant)``.

    Each row is counted under every condition's slice in the same pass; the
    declared variants are conditional averages, so nothing is collected.
    """
    sides = F.array(*[F.struct(F.lit(c).alias("condition"), F.col(c).cast("string").alias("slice")) for c in by])
    d = df.select(F.col(variant).alias("__v"), F.col(metric).alias("__m"), F.inline(sides))
    return d.groupBy("condition", "slice").agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.when(F.col("__v") == v, F.col("__m"))).alias(v) for v in variants])


def mask_metrics(pred: DataFrame, truth: DataFrame, ignore: DataFrame, labelled: DataFrame,
                 image: str = "image", pixel: str = "pixel", instance: str | None = None) -> DataFrame:
    """IoU, Dice, precision, recall per labelled image (or per image and instance) from positive-pixel tables.

    Ignore-region pixels are removed from both sides, whatever their instance; images without labels
    are skipped (never counted as empty). Empty-vs-empty gives 1 for IoU/Dice: with ``instance``, rows of
    ``labelled`` name the (image, instance) pairs to report, and pixels of other instances count for none.
    """
    unit = [image, *([instance] if instance else [])]
    k, here = [*unit, pixel], [image, pixel]
    p = pred.select(*k).join(ignore.select(*here), here, "left_anti").join(labelled.select(*unit), unit, "left_semi")
    t = truth.select(*k).join(ignore.select(*here), here, "left_anti").join(labelled.select(*unit), unit, "left_semi")
    j = p.withColumn("__p", F.lit(1)).join(t.withColumn("__t", F.lit(1)), k, "full")
    c = j.groupBy(*unit).agg(F.sum(F.when(F.col("__p").isNotNull() & F.col("__t").isNotNull(), 1).otherwise(0)).alias("tp"),
                             F.sum(F.when(F.col("__p").isNotNull() & F.col("__t").isNull(), 1).otherwise(0)).alias("fp"),
                             F.sum(F.when(F.col("__p").isNull() & F.col("__t").isNotNull(), 1).otherwise(0)).alias("fn"))
    c = labelled.select(*unit).join(c, unit, "left").fillna(0, ["tp", "fp", "fn"])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    one_if_empty = lambda num, den: F.when(den == 0, F.lit(1.0)).otherwise(num / den)
    return c.select(*unit, F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
                    F.col("fn").cast("long").alias("fn"),
                    one_if_empty(tp, tp + fp + fn).alias("iou"), one_if_empty(2 * tp, 2 * tp + fp + fn).alias("dice"),
                    one_if_empty(tp, tp + fp).alias("precision"), one_if_empty(tp, tp + fn).alias("recall"))


def _paired(a: DataFrame, b: DataFrame, image: str, pixel: str, value: str) -> DataFrame:
    return a.select(image, pixel, F.col(value).alias("a")).join(b.select(image, pixel, F.col(value).alias("b")), [image, pixel])


def difference_mask(a: DataFrame, b: DataFrame, t: float, image: str = "image", pixel: str = "pixel",
                    value: str = "value") -> DataFrame:
    """Pixels with |a - b| > t, and the share of the image they cover."""
    j = _paired(a, b, image, pixel, value)
    return j.groupBy(image).agg(F.sum((F.abs(F.col("a") - F.col("b")) > t).cast("long")).alias("n_changed"),
                                F.avg((F.abs(F.col("a") - F.col("b")) > t).cast("double")).alias("share_changed"))


def psnr(a: DataFrame, b: DataFrame, peak: float, image: str = "image", pixel: str = "pixel",
         value: str = "value") -> DataFrame:
    """PSNR per image = 10 log10(peak^2 / mse); identical images -> null."""
    j = _paired(a, b, image, pixel, value)
    m = j.groupBy(image).agg(F.avg(F.pow(F.col("a") - F.col("b"), 2)).alias("mse"))
    return m.withColumn("psnr", F.when(F.col("mse") == 0, F.lit(None)).otherwise(
        10 * F.log10(F.lit(peak * peak) / F.col("mse"))))


def psnr_with_average(a: DataFrame, b: DataFrame, peak: float, image: str = "image", pixel: str = "pixel", value: str = "value") -> DataFrame:
    """The PSNR of each image and an ``average`` row over the images that have one: ``(image string, mse, psnr)``."""
    per = cut_lineage(psnr(a, b, peak, image, pixel, value).select(F.col(image).cast("string").alias("image"), "mse", "psnr"))
    return per.unionByName(per.agg(F.lit("average").alias("image"), F.avg("mse").alias("mse"), F.avg("psnr").alias("psnr")))


def ssim_global(a: DataFrame, b: DataFrame, data_range: float, image: str = "image", pixel: str = "pixel",
                value: str = "value") -> DataFrame:
    """One-window SSIM per image from means, population variances and covariance."""
    j = _paired(a, b, image, pixel, value)
    c1, c2 = (0.01 * data_range) ** 2, (0.03 * data_range) ** 2
    m = j.groupBy(image).agg(F.avg("a").alias("ma"), F.avg("b").alias("mb"), F.var_pop("a").alias("va"),
                             F.var_pop("b").alias("vb"), F.covar_pop("a", "b").alias("cab"))
    s = ((2 * F.col("ma") * F.col("mb") + c1) * (2 * F.col("cab") + c2)) / (
        (F.col("ma") * F.col("ma") + F.col("mb") * F.col("mb") + c1) * (F.col("va") + F.col("vb") + c2))
    return m.select(image, s.alias("ssim"))
