"""Deterministic splits, samples and leakage checks.

Every draw is an md5 order of ``seed|key`` so results are re-computable and
have exact SQL oracles; no seeded RNG, no driver-side sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import md5_order, md5_bucket
from tessera.functions import skew
from tessera.functions.skew import group_rank
from tessera.session import cut_lineage, store

_DEN = 10000


def _ceil_frac(n, frac: float):
    """ceil(frac * n) in integer arithmetic (float grids drift: 0.2*15 > 3)."""
    p = int(round(frac * _DEN))
    return F.floor((n * p + (_DEN - 1)) / _DEN).cast("long")


def split_per_group(df: DataFrame, key: str, row_key: list[str], test_frac: float = 0.2,
                    seed: int = 42, split_col: str = "split") -> DataFrame:
    """Each group's rows split on their own; test size = ceil(frac * n)."""
    d = group_rank(df, key, md5_order(seed, *row_key), "__rn", "__n")
    return (d.withColumn(split_col, F.when(F.col("__rn") <= _ceil_frac(F.col("__n"), test_frac), F.lit("test"))
                         .otherwise(F.lit("train")))
             .drop("__rn", "__n"))


def split_stratified(df: DataFrame, label: str, row_key: list[str], test_frac: float = 0.2,
                     seed: int = 42, split_col: str = "split") -> DataFrame:
    """Stratified split = per-class split on the label, for labels of many rows.

    A label of more than ``SLICE_ROWS`` rows is cut at the md5 of its last test
    row: counts of md5 sub-ranges find the one that holds it, counts of that
    range's values find the value, and each row compares itself with it where
    it is, so no row is shuffled. Rows that share that value, if only some are
    test rows, and the rows of small labels are ranked. ``df`` is read several
    times; it should be stored.
    """
    order, digits, at = md5_order(seed, *row_key), "__digits", "__slice"
    sizes = cut_lineage(df.groupBy(label).agg(F.count(F.lit(1)).alias("__n")).filter(F.col(label).isNotNull()))
    big = (sizes.filter(F.col("__n") > skew.SLICE_ROWS)
           .select(label, _ceil_frac(F.col("__n"), test_frac).alias("__want"), F.ceil(F.log(16.0, F.col("__n") / skew.SLICE_ROWS)).cast("int").alias(digits)))
    n_labels, n_big = sizes.count(), big.count()
    if not n_big:
        return store(split_per_group(df, label, row_key, test_frac, seed, split_col))[0]

    def reached(counts: DataFrame, by: str) -> DataFrame:
        """Per label, the value of ``by`` that holds its wanted row, how many rows are wanted of it, and its rows."""
        w = Window.partitionBy(label).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        c = counts.withColumn("__below", F.coalesce(F.sum("__c").over(w), F.lit(0))).withColumn("__take", F.col("__want") - F.col("__below"))
        return cut_lineage(c.filter((F.col("__take") >= 1) & (F.col("__take") <= F.col("__c"))).select(label, by, F.col("__take").alias("__want"), F.col("__c").alias("__rows")))

    rows = df.select(label, order.alias("__o"))
    ranges = rows.join(F.broadcast(big), label).groupBy(label, "__want", F.substring("__o", F.lit(1), F.col(digits)).alias(at))
    part = reached(ranges.agg(F.count(F.lit(1)).alias("__c")), at).drop("__rows")  # one row per large label, as the next
    held = rows.join(F.broadcast(part), label).filter(F.col("__o").startswith(F.col(at))).groupBy(label, "__want", "__o")
    cut = reached(held.agg(F.count(F.lit(1)).alias("__c")), "__o").withColumnRenamed("__o", "__cut")
    cut = cut_lineage(big.select(label).join(cut, label, "left"))
    out = df.withColumn("__o", order).join(F.broadcast(cut), label)
    name = lambda test: F.when(test, F.lit("test")).otherwise(F.lit("train"))
    some = F.coalesce((F.col("__o") == F.col("__cut")) & (F.col("__want") < F.col("__rows")), F.lit(False))
    tied = cut.filter("__want < __rows").count() > 0
    got = (out.filter(~some) if tied else out).withColumn(split_col, name(F.col("__o") <= F.col("__cut")))
    if tied:
        turn = F.row_number().over(Window.partitionBy(label).orderBy("__o"))
        got = got.unionByName(cut_lineage(out.filter(some).withColumn(split_col, name(turn <= F.col("__want")))))  # equal keys are ranked once
    got = got.select(*df.columns, split_col)
    if n_big < n_labels:
        got = got.unionByName(store(split_per_group(df.join(F.broadcast(big.select(label)), label, "left_anti"), label, row_key, test_frac, seed, split_col))[0])
    return got


def head_subset(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First n rows by a declared total order (a row cap is the feature)."""
    return df.orderBy(*order).limit(n)


def sample_distinct(df: DataFrame, col: str, n: int, seed: int = 42) -> DataFrame:
    """N distinct values of ``col`` without replacement (md5 order)."""
    return (df.select(col).distinct().withColumn("__o", md5_order(seed, col))
              .orderBy("__o").limit(n).drop("__o"))


def semi_filter(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Keep rows whose key is in ``keys`` (left semi join)."""
    return df.join(keys, on, "left_semi")


def nested_subsets(df: DataFrame, key: str, sizes: list[int], seed: int = 42) -> DataFrame:
    """Nested subsets; row gets ``subset_<size>`` = 1 when its md5 rank <= size."""
    d = group_rank(df.withColumn("__o", md5_order(seed, key)), [], "__o", "__rn", "__n")
    for s in sizes:
        d = d.withColumn(f"in_{s}", (F.col("__rn") <= s).cast("int"))
    return d.drop("__o", "__n").withColumnRenamed("__rn", "sample_rank")


def split_by_group(df: DataFrame, group: str, fracs: dict[str, float], seed: int = 42,
                   split_col: str = "split") -> DataFrame:
    """Group-disjoint split; the *group* key's md5 bucket picks the split."""
    b = md5_bucket(seed, _DEN, group)
    expr, lo = None, 0
    items = list(fracs.items())
    for i, (name, f) in enumerate(items):
        hi = _DEN if i == len(items) - 1 else lo + int(round(f * _DEN))
        cond = (b >= lo) & (b < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
        lo = hi
    return df.withColumn(split_col, expr)


def leakage_report(df: DataFrame, key: str, split_col: str = "split") -> DataFrame:
    """Keys seen in more than one split, with the sorted list of splits."""
    return (df.groupBy(key).agg(F.array_sort(F.collect_set(split_col)).alias("splits"))
              .filter(F.size("splits") > 1))


def shuffle(df: DataFrame, seed: int, key: list[str]) -> DataFrame:
    """Deterministic shuffle = order by md5(seed|key)."""
    return df.orderBy(md5_order(seed, *key))


def poison_split(df: DataFrame, key: str, label: str, target, n: int, seed: int = 42) -> DataFrame:
    """Pick n rows whose label is not ``target``; relabel them and flag them."""
    rest = df.filter(~(F.coalesce(F.col(label) != F.lit(target), F.lit(False))))
    d = df.filter(F.col(label) != F.lit(target)).withColumn("__o", md5_order(seed, key))
    d = group_rank(d, [], "__o", "__rn", "__n")  # only rows that can be poisoned are ranked
    flag = F.col("__rn") <= n
    d = (d.withColumn("poisoned", flag.cast("int")).withColumn(label, F.when(flag, F.lit(target)).otherwise(F.col(label)))
          .drop("__o", "__rn", "__n"))
    return d.unionByName(rest.withColumn("poisoned", F.lit(0)))


def scaling_grid(df: DataFrame, key: str, eval_keys: DataFrame, sizes: list[int], seed: int = 42) -> DataFrame:
    """Training pool = rows not in the fixed evaluation set, with nested subsets."""
    pool = df.join(eval_keys, key, "left_anti")
    return nested_subsets(pool, key, sizes, seed)
