"""Skew-safe building blocks.

Any key may hold a third of all rows, so nothing here puts one group into one
task: ranks of a large group are computed over md5 sub-ranges, top-k runs in two
phases (salted partial top-k, then a final top-k over at most ``salts * k``
rows per key), and self-joins split hot keys across salted tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.rows import attach_row

# A group with more rows than this is ranked in md5 sub-ranges of about this many rows at most.
SLICE_ROWS = 50000
# Salt fan-out of the partial phase of a per-key top-k.
TOPK_SALTS = 16
# A key with more rows than this is split across salted tasks in self-joins.
HOT_KEY_ROWS = 20000
HOT_SALTS = 32
MAX_HOT_KEYS = 10000
# Most rows of a lookup table that are broadcast: its most used ones (see ``meet``).
MEET_ROWS = 200_000


def group_rank(df: DataFrame, key: list[str] | str, order_hex: str | Column,
               rank_col: str = "rn", size_col: str = "n") -> DataFrame:
    """Exact 1-based rank of each row inside its group by an md5 hex column.

    Equivalent to ``row_number() over (partition by key order by order_hex)``
    plus ``count(*) over (partition by key)``. Groups of more than
    ``SLICE_ROWS`` rows are cut into md5 sub-ranges, with as many leading hex
    digits as their size asks for, so tasks grow with the group; counts per
    (key, sub-range) give each its offset and the row number runs inside it.
    Rows never meet by ``key`` alone: only the large groups (at most one per
    ``SLICE_ROWS`` rows) and their slices travel, as broadcasts, and the rows
    are shuffled once, by (key, sub-range). A row with a null key is left out.
    An empty ``key`` list ranks the whole table. ``order_hex`` given as an
    expression is worked out after the shuffle, so that it doesn't travel.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = F.col(order_hex) if isinstance(order_hex, str) else order_hex
    sl, big_n = "__slice", "__big"
    digits = F.ceil(F.log(16.0, F.col(big_n) / SLICE_ROWS)).cast("int")
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(big_n)).filter(F.col(big_n) > SLICE_ROWS).withColumn("__digits", digits)
    if keys:
        d = df.dropna(subset=keys).join(F.broadcast(big), keys, "left")
    else:
        d = df.join(F.broadcast(big), F.lit(True), "left")  # one row or none
    d = d.withColumn(sl, F.when(F.col("__digits").isNull(), F.lit("")).otherwise(F.substring(F.coalesce(order, F.lit("")), F.lit(1), F.col("__digits"))))
    cnt = d.filter(F.col(big_n).isNotNull()).groupBy(*keys, sl).agg(F.count(F.lit(1)).alias("__cnt"))
    wk = Window.partitionBy(*keys).orderBy(sl).rowsBetween(Window.unboundedPreceding, -1)
    offs = cnt.select(*keys, sl, F.coalesce(F.sum("__cnt").over(wk), F.lit(0)).alias("__off"))
    ws = Window.partitionBy(*keys, sl)
    if not isinstance(order_hex, str):
        d = d.repartition(*keys, sl)
    return (d.withColumn("__ord", order).withColumns({"__in_slice": F.row_number().over(ws.orderBy("__ord")), "__in": F.count(F.lit(1)).over(ws)})
             .join(F.broadcast(offs), [*keys, sl], "left")
             .withColumn(rank_col, (F.col("__in_slice") + F.coalesce("__off", F.lit(0))).cast("long"))
             .withColumn(size_col, F.coalesce(big_n, "__in"))  # a group that is not large is one slice
             .select(*df.columns, rank_col, size_col))


def top_k_per_key(df: DataFrame, key: list[str] | str, order: list[Column], k: int,
                  rank_col: str | None = None, salt_cols: list[str] | None = None) -> DataFrame:
    """Exact top-k rows per key by ``order`` (which must be a total order).

    Phase 1 keeps the top-k inside each (key, salt) slice, so a hot key is
    split across ``TOPK_SALTS`` tasks; phase 2 ranks the <= salts*k survivors.
    """
    keys = [key] if isinstance(key, str) else list(key)
    salt_src = [F.col(x) for x in (salt_cols or [x for x in df.columns if x not in keys])]
    d = df.withColumn("__salt", F.pmod(F.xxhash64(*salt_src), F.lit(TOPK_SALTS)))
    p1 = (d.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, "__salt").orderBy(*order)))
           .filter(F.col("__r") <= k).drop("__r", "__salt"))
    rc = rank_col or "__r2"
    out = (p1.withColumn(rc, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
             .filter(F.col(rc) <= k))
    return out if rank_col else out.drop(rc)


def hot_keys(df: DataFrame, key: str, threshold: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys with more than ``threshold`` rows; at most ``MAX_HOT_KEYS`` of them.

    The result has a proven size bound (<= MAX_HOT_KEYS rows), so it may be
    broadcast. Keys past the bound are still joined exactly, only unsalted
    (AQE skew-join splitting still applies to them).
    """
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("__deg"))
              .filter(F.col("__deg") > threshold)
              .orderBy(F.desc("__deg"), key).limit(MAX_HOT_KEYS)
              .select(key, F.lit(True).alias("__hot")))


def salted_self_join(left: DataFrame, right: DataFrame, key: str, left_id: str,
                     threshold: int = HOT_KEY_ROWS, salts: int = HOT_SALTS, *, merge: bool = False) -> DataFrame:
    """Equi-join of two views of one table on ``key``, hot keys split by salt.

    Rows of a hot key on the left get salt ``hash(left_id) mod salts``; the
    right rows of that key are replicated once per salt. Each salted task then
    holds 1/salts of the hot key's left rows: no task holds a hot group whole.
    ``merge`` asks for a sort-merge join, for rows whose size the planner
    underrates (exploded from a small file) and would broadcast.
    """
    hk = F.broadcast(hot_keys(left, key, threshold))
    l = (left.join(hk, key, "left")
             .withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(left_id), F.lit(salts)))
                         .otherwise(F.lit(0)).cast("long")).drop("__hot"))
    r = (right.join(hk, key, "left")
              .withColumn("__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
                                              .otherwise(F.array(F.lit(0).cast("long"))))).drop("__hot"))
    return l.join(r.hint("merge") if merge else r, [key, "__salt"]).drop("__salt")


def salted_left_join(left: DataFrame, right: DataFrame, key: str, spread: list[str], threshold: int = HOT_KEY_ROWS, salts: int = HOT_SALTS) -> DataFrame:
    """Left join to a lookup table with one row per ``key``; a hot key's left rows are dealt over ``salts`` tasks by a hash of ``spread``.

    The lookup rows of hot keys are repeated once per salt; the others join as they are.
    """
    hk = F.broadcast(hot_keys(left, key, threshold))
    l = (left.join(hk, key, "left")
             .withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0)).cast("long")).drop("__hot"))
    r = (right.join(hk, key, "left")
              .withColumn("__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
                                              .otherwise(F.array(F.lit(0).cast("long"))))).drop("__hot"))
    return l.join(r, [key, "__salt"], "left").drop("__salt")


def meet(left: DataFrame, table: DataFrame, key: list[str] | str, uses: str) -> DataFrame:
    """Inner join to a lookup table with one row per ``key`` whose column ``uses`` (1 or more) says how often it is met.

    Its most used rows, ``MEET_ROWS`` at most, are broadcast, so that a hot key's rows stay where they are and only
    the rows of ``left`` with other keys are shuffled. ``left`` and ``table`` are read twice; ``uses`` is dropped.
    """
    keys = [key] if isinstance(key, str) else list(key)
    at = F.floor(4 * F.log2(uses))
    sizes = sorted(table.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)  # 4 per power of two
    fit = 0
    while fit < len(sizes) and sum(r["n"] for r in sizes[:fit + 1]) <= MEET_ROWS:
        fit += 1
    if not fit:
        return left.join(table.drop(uses).hint("merge"), keys)
    hot = table.where(at >= sizes[fit - 1]["at"]).drop(uses)
    out = left.join(F.broadcast(hot), keys)
    if fit == len(sizes):
        return out
    cold = table.where(at < sizes[fit - 1]["at"]).drop(uses)
    return out.unionByName(left.join(F.broadcast(hot.select(keys)), keys, "left_anti").join(cold.hint("merge"), keys))


def prefix_sums(df: DataFrame, order_col: str, sum_cols: list[str], prefix: str = "below_", totals: bool = False) -> DataFrame:
    """Exclusive running sums in ``order_col`` order, without a global window.

    For each row, ``below_<c>`` = sum of ``c`` over rows with a smaller order
    value (``df`` should hold one row per distinct order value, e.g. after a
    group-by score). A range sort lays the rows out over as many partitions as
    the shuffle has; partition totals give offsets through a window over one
    row per partition, and the running sum runs inside each partition.
    """
    from tessera.session import cut_lineage
    # ids depend on the physical partitioning of the sort: materialise them once (see dense_index)
    d = cut_lineage(df.orderBy(order_col).withColumn("__mid", F.monotonically_increasing_id())).withColumn("__b", F.shiftright("__mid", 33))
    tot = d.groupBy("__b").agg(*[F.sum(x).alias(f"__t_{x}") for x in sum_cols])
    wb = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("__b", *[F.coalesce(F.sum(f"__t_{x}").over(wb), F.lit(0)).alias(f"__o_{x}") for x in sum_cols],
                      *[F.sum(f"__t_{x}").over(Window.partitionBy(F.lit(0))).alias(f"total_{x}") for x in sum_cols])
    wr = Window.partitionBy("__b").orderBy("__mid").rowsBetween(Window.unboundedPreceding, -1)
    out = d.join(F.broadcast(offs), "__b")  # one row per partition
    for x in sum_cols:
        out = out.withColumn(f"{prefix}{x}", F.coalesce(F.sum(x).over(wr), F.lit(0)) + F.col(f"__o_{x}"))
    out = out.drop("__b", "__mid", *[f"__o_{x}" for x in sum_cols])
    return out if totals else out.drop(*[f"total_{x}" for x in sum_cols])


def dense_index(df: DataFrame, order: list, out: str = "index") -> DataFrame:
    """Exact 0-based position of every row in a total ``order``, fully distributed.

    A range-partitioned sort puts the rows in order across partitions;
    ``monotonically_increasing_id`` encodes (partition, row-in-partition);
    per-partition counts (one row per partition, a bounded table) give each
    partition its offset. No global window, no single task sees all rows.
    """
    from tessera.session import cut_lineage
    # the ids depend on the physical partitioning of this sort: write them once, so both reads
    # below (and any recomputation after an executor loss) see the same ids
    s = cut_lineage(df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()))
    s = s.withColumn("__pid", F.shiftright("__mid", 33)).withColumn(
        "__pos", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
    cnt = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__c"))
    offs = cnt.select("__pid", F.coalesce(F.sum("__c").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    return (s.join(F.broadcast(offs), "__pid")
             .withColumn(out, (F.col("__off") + F.col("__pos")).cast("long"))
             .drop("__mid", "__pid", "__pos", "__off"))


def running_in_group(df: DataFrame, key: list[str] | str, order: list, value: str | None = None,
                     out: str = "rn") -> DataFrame:
    """Inclusive running sum of ``value`` (default 1 = the row number) inside each group, in a total
    ``order``, without a window over whole groups.

    A range sort on (key, order) lays every group out contiguously, a hot group
    possibly over several partitions. Each (partition, key) piece gets its
    offset from the pieces before it (a small window over at most
    #partitions rows per key); inside a piece the running sum is a window
    bounded by one partition's rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    v = F.col(value) if value else F.lit(1)
    from tessera.session import cut_lineage
    # ids depend on the physical partitioning of the sort: materialise them once (see dense_index)
    s = cut_lineage(df.withColumn("__v", v.cast("long")).orderBy(*keys, *order)
                      .withColumn("__mid", F.monotonically_increasing_id()))
    s = s.withColumn("__pid", F.shiftright("__mid", 33)).withColumn("__pos", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
    pieces = s.groupBy("__pid", *keys).agg(F.sum("__v").alias("__piece"))
    wp = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = pieces.select("__pid", *keys, F.coalesce(F.sum("__piece").over(wp), F.lit(0)).alias("__off"))
    wi = Window.partitionBy("__pid", *keys).orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    return (s.join(offs, ["__pid", *keys])
             .withColumn(out, (F.col("__off") + F.sum("__v").over(wi)).cast("long"))
             .drop("__v", "__mid", "__pid", "__pos", "__off"))


def previous_in_group(ranked: DataFrame, key: list[str] | str, rank: str, cols: list[str],
                      prefix: str = "prev_") -> DataFrame:
    """Attach the previous row's columns (rank - 1 in the same group) by an equi-join on
    (key, rank): the join key is unique per row, so a hot group spreads like any other."""
    keys = [key] if isinstance(key, str) else list(key)
    prev = ranked.select(*keys, (F.col(rank) + 1).alias(rank), *[F.col(c).alias(prefix + c) for c in cols])
    return ranked.join(prev, [*keys, rank], "left")


def exact_quantiles(df: DataFrame, col: str, probs: list[float], by: list[str] | None = None,
                    prefix: str = "q") -> DataFrame:
    """Exact linear-interpolation quantiles (position (n-1)p between the two nearest ranks), distributed.

    Values are counted first, so a value that most rows hold is one row, and
    the range sort (``running_in_group``) runs over distinct values only;
    running sums of the counts give the ranks each value covers. Just the at
    most two values per probability that bracket its position reach the final
    aggregate. Output: ``by`` columns plus ``{prefix}0..`` (one per
    probability).
    """
    from functools import reduce
    keys = list(by or ["__all"])
    d = df if by else df.withColumn("__all", F.lit(0))
    d = d.select(*keys, F.col(col).cast("double").alias("__x")).filter(F.col("__x").isNotNull())
    r = running_in_group(d.groupBy(*keys, "__x").agg(F.count(F.lit(1)).alias("__c")), keys, [F.col("__x")], value="__c", out="__upto")
    n = d.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("__n"))
    r = r.join(n, keys) if by else attach_row(r, n)
    conds, aggs, outs = [], [], []
    for i, p in enumerate(probs):
        pos = (F.col("__n") - 1) * F.lit(float(p))
        covers = lambda k: (k < F.col("__upto")) & (k >= F.col("__upto") - F.col("__c"))
        lo, hi = covers(F.floor(pos)), covers(F.ceil(pos))
        conds.append(lo | hi)
        aggs += [F.max(F.when(lo, F.col("__x"))).alias(f"__lo{i}"), F.max(F.when(hi, F.col("__x"))).alias(f"__hi{i}"),
                 F.max(pos - F.floor(pos)).alias(f"__f{i}")]
        outs.append((F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__f{i}")).alias(f"{prefix}{i}"))
    sel = r.filter(reduce(lambda a, b: a | b, conds))
    return sel.groupBy(*(by or [])).agg(*aggs).select(*(by or []), *outs)


def melt(df: DataFrame, cols: list[str]) -> DataFrame:
    """Numeric columns as rows ``(column, value double)``: one pass serves them all."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])))
