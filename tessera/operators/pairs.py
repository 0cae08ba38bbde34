"""Joins, labelled pairs and candidates.

No operator here emits all pairs inside a group: positive pairs chain the
members of a group, duplicate groups link each member to one representative,
negatives align md5-ordered positions. Output sizes are linear in the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import md5_order
from tessera.functions.skew import dense_index, group_rank, top_k_per_key
from tessera.session import cut_lineage


def lookup(df: DataFrame, dim: DataFrame, on: str | list[str], defaults: dict | None = None) -> DataFrame:
    """Dictionary lookup as a left join, missing values replaced by defaults.

    Spark broadcasts ``dim`` only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (or AQE finds it small at run time).
    """
    j = df.join(dim, on, "left")
    for c, v in (defaults or {}).items():
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return j


def positive_pairs(df: DataFrame, id_col: str, group: str, seed: int = 42) -> DataFrame:
    """J04 (re-aimed): members of a group chained in md5 order, (m1,m2), (m2,m3), ...

    A group of n gives n-1 pairs that connect all of its members (the full
    n(n-1)/2 set is not emitted). Ids are returned as ``id_a < id_b``.
    """
    d = df.select(F.col(id_col).alias("__id"), F.col(group).alias("__g")).withColumn("__o", md5_order(seed, "__id"))
    r = group_rank(d, "__g", "__o", "__rn", "__n").select("__id", "__g", "__rn")
    nxt = r.select(F.col("__id").alias("__id2"), "__g", (F.col("__rn") - 1).alias("__rn"))
    p = r.join(nxt.hint("merge"), ["__g", "__rn"])  # the planner sees a small file and would broadcast all of its rows
    return p.select(F.least("__id", "__id2").alias("id_a"), F.greatest("__id", "__id2").alias("id_b"),
                    F.lit(1).alias("label"))


def negative_pairs(df: DataFrame, id_col: str, group: str, n: "int | DataFrame", seed: int = 42,
                   shifts: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """N distinct pairs of rows from different groups, chosen deterministically.

    Rows get md5-ordered positions 0..N-1; row p is paired with p+s (mod N)
    for each shift s; pairs inside one group are dropped, mirrors merged and
    the first n by md5 of the pair are kept (n is the wanted count, e.g. the
    number of positives: a one-row DataFrame with column ``n`` or an int).
    If the first shifts give too few pairs (a group may hold most rows), the
    largest group is paired, turn by turn, with the rows outside it: each turn
    gives one new pair per member and only as many turns run as are missing.
    A group whose pairs are exhausted is set aside and the next one follows.
    Positions come from a distributed dense index, so nothing is ranked in
    one task.
    """
    from tessera.functions.rows import attach_row
    d = df.select(F.col(id_col).alias("__id"), F.col(group).alias("__g")).withColumn("__o", md5_order(seed, "__id"))
    pos = dense_index(d, ["__o"], "__p").select("__id", "__g", "__o", "__p")
    pos = attach_row(pos, pos.agg(F.count(F.lit(1)).alias("N")))
    want = n if isinstance(n, DataFrame) else df.sparkSession.range(1).select(F.lit(int(n)).alias("n"))
    pos = cut_lineage(pos)
    other = pos.select(F.col("__id").alias("__id2"), F.col("__g").alias("__g2"), F.col("__p").alias("__p2"))
    wanted = want.first()["n"]

    def drawn(some) -> DataFrame:
        shifted = pos.withColumn("__s", F.explode(F.array(*[F.lit(s) for s in some]))).withColumn("__p2", F.pmod(F.col("__p") + F.col("__s"), F.col("N")))
        return (shifted.join(other.hint("merge"), "__p2").filter(F.col("__g") != F.col("__g2"))
                .select(F.least("__id", "__id2").alias("id_a"), F.greatest("__id", "__id2").alias("id_b")).distinct())

    cands, rest = cut_lineage(drawn(shifts)), pos.select("__id", "__g", "__o")
    while (have := cands.count()) < wanted:
        top = rest.filter(F.col("__g").isNotNull()).groupBy("__g").agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("m"), "__g").limit(2).collect()
        if len(top) < 2:
            break  # every pair there is has been given
        largest = F.col("__g").eqNullSafe(F.lit(top[0]["__g"]))
        inside, outside = dense_index(rest.filter(largest), ["__o"], "__i"), cut_lineage(dense_index(rest.filter(~largest), ["__o"], "__j"))
        others = outside.count()
        # pairs drawn before may come up again, so as many more turns as they could fill
        turns = min(others, -(-(wanted + have) // top[0]["m"]))
        t = inside.withColumn("__t", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long")))).withColumn("__j", F.pmod(F.col("__i") + F.col("__t"), F.lit(others)))
        more = (t.join(outside.select("__j", F.col("__id").alias("__id2"), F.col("__g").alias("__g2")).hint("merge"), "__j").filter("__g2 is not null")
                .select(F.least("__id", "__id2").alias("id_a"), F.greatest("__id", "__id2").alias("id_b")))
        cands, rest = cut_lineage(cands.unionByName(more).distinct()), cut_lineage(outside.select("__id", "__g", "__o"))
    cands = cands.withColumn("__o", md5_order(seed, "id_a", "id_b"))
    ranked = dense_index(cands, ["__o"], "__r")
    return (attach_row(ranked, want.select(F.col("n").cast("long").alias("__n")))
            .filter(F.col("__r") < F.col("__n")).select("id_a", "id_b", F.lit(0).alias("label")))


def labelled_pairs(pos: DataFrame, neg: DataFrame) -> DataFrame:
    """Union of positive and negative pairs."""
    return pos.select("id_a", "id_b", "label").unionByName(neg.select("id_a", "id_b", "label"))


def first_per_key(df: DataFrame, key: str | list[str], order: list) -> DataFrame:
    """The first row per key by a declared total order (skew-safe two-phase top-1)."""
    return top_k_per_key(df, key, order, 1)


def hash_block_links(df: DataFrame, id_col: str, hash_col: str) -> DataFrame:
    """J09 (re-aimed): rows sharing an exact hash, each linked to its group's smallest id.

    Equal-hash groups become star edges (member -> representative), which
    feed ``connected_groups``; groups of one give no link.
    """
    rep = df.groupBy(hash_col).agg(F.min(id_col).alias("rep_id"), F.count(F.lit(1)).alias("group_size"))
    return (df.select(id_col, hash_col).join(rep.filter("group_size > 1"), hash_col)
              .filter(F.col(id_col) != F.col("rep_id"))
              .select(F.col(id_col).alias("id_a"), F.col("rep_id").alias("id_b"), hash_col, "group_size"))


def connected_groups(edges: DataFrame, a: str = "id_a", b: str = "id_b") -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    Large-star links every larger neighbour of a node to its smallest one;
    small-star links the smaller neighbours among themselves. Both are a
    partial aggregate plus an equi-join, so a hub's edges spread over tasks.
    It runs until the edge set stops changing (the stars are then the
    components), however long the paths; each round is written once
    (reliable checkpoint). Output ``(node, component)``, component = smallest
    node id in the component.
    """
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    alone = ends.filter("u = v").select("u").distinct()
    e = cut_lineage(ends.filter("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct())

    def state(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    seen = state(e)
    while seen[0]:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(low.select("hi", F.col("m").alias("lo")))
        e = cut_lineage(small.filter("hi <> lo").distinct())
        now = state(e)
        if now == seen:
            break
        seen = now
    stars = e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
    rest = alone.join(stars.select(F.col("node").alias("u")), "u", "left_anti").select(F.col("u").alias("node"), F.col("u").alias("component"))
    return stars.unionByName(rest)
