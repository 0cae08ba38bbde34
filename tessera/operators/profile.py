"""Table profiling (E01-E22). One aggregation pass per report where possible."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.rows import attach_row
from tessera.functions.skew import exact_quantiles, melt


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_cols"))


def _unpivot(one_row: DataFrame, cols: list[str], var: str, val: str) -> DataFrame:
    return one_row.unpivot([], cols, var, val)


def schema_report(df: DataFrame) -> DataFrame:
    """Column, type, non-null count (one pass, then unpivot)."""
    cnt = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    types = df.sparkSession.createDataFrame([(c, t) for c, t in df.dtypes], "column string, dtype string")
    return _unpivot(cnt, df.columns, "column", "non_null").join(types, "column")


def _is_missing(name: str, dtype: T.DataType):
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """Null (and NaN for floats) count per column."""
    agg = df.agg(*[F.sum(_is_missing(f.name, f.dataType).cast("long")).alias(f.name) for f in df.schema.fields])
    return _unpivot(agg, df.columns, "column", "n_null")


def distinct_counts(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (``approx`` = HyperLogLog++)."""
    f = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.countDistinct(c))
    return _unpivot(df.agg(*[f(c).alias(c) for c in cols]), cols, "column", "n_distinct")


def value_counts(df: DataFrame, col: str, by_count: bool = True) -> DataFrame:
    """Frequency of each value; sorted by count desc then value (or by value)."""
    vc = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return vc.orderBy(F.desc("count"), col) if by_count else vc.orderBy(col)


def describe(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (linear interpolation), max per column.

    ``exact=False`` swaps the exact ``percentile`` for ``percentile_approx``
    (bounded memory per group on very large tables).
    """
    fns = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double")}
    one = df.agg(*[f(c).alias(f"{k}_{i}") for i, c in enumerate(cols) for k, f in fns.items()])
    out = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{k}_{i}").alias(k) for k in fns]) for i, c in enumerate(cols)])))
    if exact:  # distributed exact quantiles (no single-task value map), all columns in one sort
        q = exact_quantiles(melt(df, cols), "value", [0.25, 0.5, 0.75], by=["column"]).toDF("column", "p25", "p50", "p75")
    else:
        q = melt(df, cols).groupBy("column").agg(F.percentile_approx("value", [0.25, 0.5, 0.75], 10000).alias("__q"))
        q = q.select("column", *[F.col("__q")[i].alias(p) for i, p in enumerate(("p25", "p50", "p75"))])
    return out.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram(df: DataFrame, col: str, bins: int | None = None) -> DataFrame:
    """Per-integer counts (bins=None) or N equal-width bins, last bin closed on the right."""
    if bins is None:
        return df.groupBy(F.floor(col).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    mm = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    j = attach_row(df.select(col), mm)
    w = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("__lo")) / w), F.lit(bins - 1))).cast("long")
    return (j.filter(F.col(col).isNotNull()).groupBy(b.alias("bin"))
             .agg(F.count(F.lit(1)).alias("count"), F.min(col).alias("lo"), F.max(col).alias("hi")))


def group_sizes(df: DataFrame, key: str | list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))


def group_size_distribution(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Group size -> number of groups."""
    return group_sizes(df, key).groupBy("size").agg(F.count(F.lit(1)).alias("n_groups"))


def group_size_buckets(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Number of groups of size 1, 2, 3, 4 and 5+ (zero buckets included)."""
    s = F.col("size")
    return group_sizes(df, key).agg(*[F.sum((s == i).cast("long")).alias(f"size_{i}") for i in (1, 2, 3, 4)],
                                    F.sum((s >= 5).cast("long")).alias("size_5plus"))


def duplicate_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows repeating an earlier value = rows - distinct (null counts as one value).

    One pass; rows are grouped by a SHA-256 digest of the columns, so long texts are never a shuffle key.
    """
    per = df.select(_digest(cols).alias("__d")).groupBy("__d").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def _digest(cols: list[str]):
    """SHA-256 of the columns' values; lengths and nulls are part of what is hashed, so no two rows of values share a digest."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[one(c) for c in cols]), 256))


def top_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n most frequent values (ties by value)."""
    return value_counts(df, col).limit(n)


def key_consistency(df: DataFrame, a: str, b: str) -> DataFrame:
    """How many values of a map to more than one b, and the largest such count."""
    g = df.groupBy(a).agg(F.countDistinct(b).alias("nb"))
    return g.agg(F.count(F.lit(1)).alias(f"n_{a}"), F.sum((F.col("nb") > 1).cast("long")).alias("n_inconsistent"),
                 F.max("nb").alias("max_distinct"))


def group_variation(df: DataFrame, key: str, col: str) -> DataFrame:
    """Groups with one vs several distinct values of col, and the maximum."""
    g = df.groupBy(key).agg(F.countDistinct(col).alias("nd"))
    return g.agg(F.sum((F.col("nd") == 1).cast("long")).alias("n_uniform"),
                 F.sum((F.col("nd") > 1).cast("long")).alias("n_varied"), F.max("nd").alias("max_distinct"))


def example_groups(df: DataFrame, key: str, m: int, n: int) -> DataFrame:
    """Rows of the n largest groups having at least m members (ties by key)."""
    top = (group_sizes(df, key).filter(F.col("size") >= m).orderBy(F.desc("size"), key).limit(n))
    return df.join(F.broadcast(top), key)  # top has at most n rows


def filter_groups(df: DataFrame, key: str, m: int) -> DataFrame:
    """Keep rows of groups with at least m rows (size from a partial aggregate, then a join)."""
    keep = group_sizes(df, key).filter(F.col("size") >= m).select(key)
    return df.join(keep, key, "left_semi")


def word_count(col) -> F.Column:
    t = F.trim(F.col(col) if isinstance(col, str) else col)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"\s+")))


def text_lengths(df: DataFrame, col: str) -> DataFrame:
    """Words (whitespace split) and characters of a text column."""
    return df.withColumn(f"{col}_words", word_count(col).cast("long")).withColumn(
        f"{col}_chars", F.char_length(col).cast("long"))


def length_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and maximum word count per text column, all columns in one pass."""
    one = df.agg(*[f(word_count(c)).alias(f"{k}_{i}") for i, c in enumerate(cols) for k, f in (("mean", F.avg), ("max", F.max))])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"mean_{i}").alias("mean_words"), F.col(f"max_{i}").cast("long").alias("max_words"))
                     for i, c in enumerate(cols)])
    return one.select(F.inline(rows))


def sparsity(df: DataFrame, user: str, item: str) -> DataFrame:
    """Observed cells, possible cells, share observed and unobserved."""
    a = df.agg(F.count(F.lit(1)).alias("observed"), F.countDistinct(user).alias("n_users"),
               F.countDistinct(item).alias("n_items"))
    poss = F.col("n_users") * F.col("n_items")
    return a.select("observed", "n_users", "n_items", poss.alias("possible"),
                    (F.col("observed") / poss).alias("share_observed"),
                    (1 - F.col("observed") / poss).alias("share_unobserved"))


def class_balance(df: DataFrame, label: str, split: str | None = None) -> DataFrame:
    """Rows per (split, label) and the share within the split."""
    keys = ([split] if split else []) + [label]
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    tot = g.groupBy(*([split] if split else [])).agg(F.sum("n").alias("__t"))
    j = g.join(tot, split) if split else attach_row(g, tot)
    return j.withColumn("share", F.col("n") / F.col("__t")).drop("__t")


def interaction_stats(df: DataFrame, user: str, item: str) -> DataFrame:
    """Interactions per user and per item: count, mean, min, quartiles, max."""
    pu = group_sizes(df, user).withColumn("entity", F.lit("user"))
    pi = group_sizes(df, item).withColumn("entity", F.lit("item"))
    u = pu.select("entity", "size").unionByName(pi.select("entity", "size"))
    base = u.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean"),
                                    F.min("size").alias("min"), F.max("size").alias("max"))
    q = exact_quantiles(u, "size", [0.25, 0.5, 0.75], by=["entity"]).select(
        "entity", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    return base.join(q, "entity").select("entity", "n", "mean", "min", "p25", "p50", "p75", "max")


def noise_flags(df: DataFrame, id_col: str, text: str, dup_col: str, min_chars: int = 5) -> DataFrame:
    """Flags for null/blank/short text and for a value repeated in other rows."""
    t = F.trim(F.col(text))
    # only the flags and a digest of the value go through the join, never the texts
    d = df.select(id_col, F.col(text).isNull().alias("is_null"), (t == "").alias("is_blank"), (F.char_length(t) < min_chars).alias("is_short"), _digest([dup_col]).alias("__d"))
    dup = d.groupBy("__d").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("__d", F.lit(True).alias("is_repeated"))
    return d.join(dup, "__d", "left").select(id_col, "is_null", "is_blank", "is_short", F.coalesce("is_repeated", F.lit(False)).alias("is_repeated"))
