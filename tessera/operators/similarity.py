"""Similarity and neighbour search (N01-N14) in long (sparse) form.

Vectors are either long tables ``(id, term, weight)`` or ``array<float>``
columns. Pair work is driven by equi-joins (shared item / term / bucket),
never by a cross join; hot join keys are split by salting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import dot, l2_norm
from tessera.functions.skew import salted_self_join, top_k_per_key
from tessera.session import cut_lineage, drop_stored, store


def vector_norms(long_df: DataFrame, ent: str, val: str, out: str = "norm") -> DataFrame:
    return long_df.groupBy(ent).agg(F.sqrt(F.sum(F.col(val) * F.col(val))).alias(out))


def _unit_rows(long_df: DataFrame, ent: str, key: str, val: str) -> DataFrame:
    """Long rows scaled by their entity's L2 norm (norm over *all* the entity's values)."""
    base = long_df.select(F.col(ent).alias("__e"), F.col(key).alias("__k"), F.col(val).cast("double").alias("__v"))
    norms = base.groupBy("__e").agg(F.sqrt(F.sum(F.col("__v") * F.col("__v"))).alias("__n"))
    return base.join(norms, "__e").select("__e", "__k", (F.col("__v") / F.col("__n")).alias("__u"))


def _cosine_pairs(long_df: DataFrame, ent: str, key: str, val: str) -> DataFrame:
    """(a, b, u_a * u_b) per shared key, a != b; hot keys split across salted tasks."""
    u = _unit_rows(long_df, ent, key, val)
    left = u.select(F.col("__e").alias("a"), "__k", F.col("__u").alias("ua"))
    right = u.select(F.col("__e").alias("b"), "__k", F.col("__u").alias("ub"))
    return (salted_self_join(left, right, "__k", "a").filter(F.col("a") != F.col("b"))
            .select("a", "b", (F.col("ua") * F.col("ub")).alias("p")))


def entity_cosine(long_df: DataFrame, ent: str, key: str, val: str) -> DataFrame:
    """Cosine of every pair of entities that share at least one key.

    ``sum_k v_ak * v_bk / (|a| |b|)`` with norms over *all* of an entity's
    values (absent = 0, so pairs with no shared key have cosine 0 and are not
    emitted). Values are scaled to unit vectors first, so the sum of products
    is the cosine and no pair-sized join with the norms is needed. Partial
    sums combine map-side before the shuffle; hot keys are salted.
    Output ``(a, b, sim)`` for a != b, both directions.
    """
    return _cosine_pairs(long_df, ent, key, val).groupBy("a", "b").agg(F.sum("p").alias("sim"))


#: Entities and ratings of one block of a sparse product at most, ratings of one shipped piece, products expanded at a time.
SPARSE_BLOCK = 500_000
BLOCK_RATINGS = 4_000_000
PIECE_RATINGS = 4096
SPARSE_STEP = 4_000_000
#: Blocks that meet all blocks before them at a time, if there are more than MIN_BLOCKS.
WAVE_BLOCKS = 4
MIN_BLOCKS = 5


def _best_of_rows(sims, names_a, names_b, k: int, tie_digits: int):
    """(a, b, sim) of the k largest finite entries of each row; ties by column (columns ascend by name)."""
    import numpy as np
    r = np.where(np.isfinite(sims), np.round(sims, tie_digits), -np.inf)
    kk = min(k, r.shape[1])
    at_least = np.partition(r, r.shape[1] - kk, axis=1)[:, r.shape[1] - kk]
    row, col = np.nonzero((r >= at_least[:, None]) & np.isfinite(r))
    order = np.lexsort((col, -r[row, col], row))
    row, col = row[order], col[order]
    start = np.searchsorted(row, np.arange(len(r)))
    keep = np.arange(len(row)) - start[row] < kk
    row, col = row[keep], col[keep]
    return names_a[row], names_b[col], sims[row, col]


def _best_of_cells(row, col, sim, k: int, tie_digits: int):
    """The k largest cells of each row of a sparse matrix; ties by column."""
    import numpy as np
    order = np.lexsort((col, -np.round(sim, tie_digits), row))
    row, col, sim = row[order], col[order], sim[order]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, int)
    keep = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)])) < k
    return row[keep], col[keep], sim[keep]


def _sparse_product(k: int, tie_digits: int):
    import numpy as np
    import pandas as pd

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
        piece = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf["ks"]])
        key = pd.factorize(np.concatenate(pdf["ks"].to_list()))[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            unit = np.concatenate(pdf["vs"].to_list()).astype(float) / pdf["n"].to_numpy()[piece]
        own, names = pdf["own"].to_numpy(), pdf["e"].to_numpy()

        def side(block):
            at = np.flatnonzero(own == block)
            e, row = np.unique(names[at], return_inverse=True)
            of = np.full(len(pdf), -1)
            of[at] = row
            m = own[piece] == block
            return e, of[piece[m]], key[m], unit[m]

        na, ra, ka, ua = side(low)
        nb, rb, kb, ub = (na, ra, ka, ua) if low == high else side(high)
        if not len(na) or not len(nb):
            return pd.DataFrame({"a": pd.Series([], dtype=pdf["e"].dtype), "b": pd.Series([], dtype=pdf["e"].dtype), "sim": pd.Series([], dtype="float64")})
        order = np.argsort(ra, kind="stable")
        ra, ka, ua = ra[order], ka[order], ua[order]
        order = np.argsort(kb, kind="stable")
        rb, kb, ub = rb[order], kb[order], ub[order]
        first, last = np.searchsorted(kb, ka, "left"), np.searchsorted(kb, ka, "right")
        begin = np.searchsorted(ra, np.arange(len(na) + 1))  # of each entity's rows
        upto = np.r_[0, np.cumsum(last - first)][begin]
        out, back = [], [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        at = 0
        while at < len(na):  # whole entities, so that a step's sums are final; an entity meets a row of the other block once at most
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + SPARSE_STEP, "right")) - 1)
            span = slice(begin[at], begin[end])
            n = (last - first)[span]
            left = np.repeat(np.arange(span.start, span.stop), n)
            right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[span], n)
            cell = ra[left] * len(nb) + rb[right]
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, int)
            sim = np.add.reduceat((ua[left] * ub[right])[order], starts) if len(cell) else np.zeros(0)
            row, col = np.divmod(cell[starts], len(nb))
            ok = np.isfinite(sim) & ((row != col) if low == high else True)
            row, col, sim = row[ok], col[ok], sim[ok]
            out.append(_best_of_cells(row, col, sim, k, tie_digits))
            if low != high:
                back.append(_best_of_cells(col, row, sim, k, tie_digits))
                if len(back) > 8:
                    back = [_best_of_cells(*(np.concatenate([x[i] for x in back]) for i in range(3)), k, tie_digits)]
            at = end
        back = _best_of_cells(*(np.concatenate([x[i] for x in back]) for i in range(3)), k, tie_digits)
        out = [np.concatenate([x[i] for x in out]) for i in range(3)]
        return pd.DataFrame({"a": np.concatenate([na[out[0]], nb[back[0]]]), "b": np.concatenate([nb[out[1]], na[back[1]]]), "sim": np.concatenate([out[2], back[2]])})
    return fn


def top_k_cosine(long_df: DataFrame, ent: str, key: str, val: str, k: int, tie_digits: int = 9,
                 block_rows: int = SPARSE_BLOCK) -> DataFrame:
    """N01 + N03 fused: the k most similar partners of every entity (sharing a key), ties by partner id.

    Entities are dealt over blocks of about ``block_rows`` entities and
    ``BLOCK_RATINGS`` rows. An entity travels as arrays of its keys and values
    (pieces of about ``PIECE_RATINGS`` rows) with its norm, once to each pair
    of blocks it belongs to, and a task multiplies two sparse blocks: only
    products of shared keys are formed, a step of them at a time, and k rows
    per entity leave the task. With many blocks a few of them meet the blocks
    up to them at a time, and what was shipped for it is let go before the next.
    """
    spark = long_df.sparkSession
    base = long_df.select(F.col(ent).alias("e"), F.col(key).alias("k"), F.col(val).cast("double").alias("v")).filter("e is not null")
    pieces = base.groupBy("e").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("n"), F.ceil(F.count(F.lit(1)) / PIECE_RATINGS).alias("__p"))
    j = base.join(pieces, "e").withColumn("__p", F.pmod(F.xxhash64("k"), F.col("__p")))
    u = j.groupBy("e", "__p", "n").agg(F.collect_list(F.struct("k", "v")).alias("x"))
    u, u_path = store(u.select("e", "n", F.transform("x", lambda x: x["k"]).alias("ks"), F.transform("x", lambda x: x["v"]).alias("vs")))
    entities, rows = u.agg(F.countDistinct("e"), F.coalesce(F.sum(F.size("ks")), F.lit(0))).first()
    blocks = max(1, -(-entities // block_rows), -(-rows // BLOCK_RATINGS), min(MIN_BLOCKS, rows // 50_000))
    e = u.schema["e"].dataType.simpleString()
    order = [F.desc(F.round("sim", tie_digits)), F.col("b")]

    def best(highs: range, state: DataFrame | None = None) -> DataFrame:
        """The k best of the blocks ``highs`` with the blocks up to them, and of ``state``."""
        others = F.flatten(F.transform(F.sequence(F.lit(highs.start).cast("long"), F.lit(highs.stop - 1).cast("long")),
                                       lambda h: F.when(F.col("own") == h, F.sequence(F.lit(0).cast("long"), h)).when(F.col("own") < h, F.array(h)).otherwise(F.array().cast("array<bigint>"))))
        pair = (u.withColumn("own", F.pmod(F.xxhash64("e"), F.lit(blocks))).filter(F.col("own") < highs.stop).withColumn("other", F.explode(others))
                .select("e", "n", "ks", "vs", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")))
        part = pair.groupBy("low", "high").applyInPandas(_sparse_product(k, tie_digits), f"a {e}, b {e}, sim double")
        part = part if state is None else part.unionByName(state.drop("rank"))
        return (part.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(*order)).cast("long"))
                    .filter(F.col("rank") <= k))

    if blocks <= max(MIN_BLOCKS, WAVE_BLOCKS):
        return best(range(blocks))
    state, path = None, None
    for start in range(0, blocks, WAVE_BLOCKS):
        got, at = store(best(range(start, min(blocks, start + WAVE_BLOCKS)), state))
        if path:
            drop_stored(spark, path)
        state, path = got, at
    drop_stored(spark, u_path)
    return state


def user_cosine(ratings: DataFrame, user: str = "user", item: str = "item", rating: str = "rating") -> DataFrame:
    """User-user cosine with unrated = 0."""
    return entity_cosine(ratings, user, item, rating)


def item_cosine(ratings: DataFrame, user: str = "user", item: str = "item", rating: str = "rating") -> DataFrame:
    """Item-item cosine (N01 with the roles swapped)."""
    return entity_cosine(ratings, item, user, rating)


def top_k_neighbours(sim: DataFrame, k: int = 5, a: str = "a", b: str = "b", s: str = "sim",
                     tie_digits: int = 9) -> DataFrame:
    """K most similar partners per entity, self removed; ties by partner id.

    Similarities are compared after rounding to ``tie_digits`` places so that
    mathematically equal values tie regardless of summation order.
    """
    d = sim.filter(F.col(a) != F.col(b))
    return top_k_per_key(d, a, [F.desc(F.round(F.col(s), tie_digits)), F.col(b)], k, rank_col="rank",
                         salt_cols=[b])


def pair_cosine_sparse(pairs: DataFrame, vecs: DataFrame, id_a: str = "id_a", id_b: str = "id_b",
                       id_col: str = "id", term: str = "term", weight: str = "weight") -> DataFrame:
    """Cosine of the asked pairs only, from long unit vectors.

    ``sum(wa * wb)`` over shared terms; a pair with no shared term gets 0.
    Vectors are expected L2-normalised (as ``tfidf`` returns them).
    """
    va = vecs.select(F.col(id_col).alias(id_a), F.col(term).alias("__t"), F.col(weight).alias("__wa"))
    vb = vecs.select(F.col(id_col).alias(id_b), F.col(term).alias("__t"), F.col(weight).alias("__wb"))
    pk = pairs.select(id_a, id_b).distinct()
    # terms are far more than the planner takes them for (it sees the texts' file): they are merged, never broadcast
    shared = (pk.join(va.hint("merge"), id_a).join(vb.hint("merge"), [id_b, "__t"])
                .groupBy(id_a, id_b).agg(F.sum(F.col("__wa") * F.col("__wb")).alias("cosine")))
    return (pairs.join(shared.hint("merge"), [id_a, id_b], "left")
                 .withColumn("cosine", F.coalesce("cosine", F.lit(0.0))))


def pair_cosine_dense(pairs: DataFrame, vecs: DataFrame, id_a: str = "id_a", id_b: str = "id_b",
                      id_col: str = "id", vec: str = "embedding") -> DataFrame:
    """Cosine of the asked pairs on dense vectors; a zero norm gives 0."""
    va = vecs.select(F.col(id_col).alias(id_a), F.col(vec).alias("__va"))
    vb = vecs.select(F.col(id_col).alias(id_b), F.col(vec).alias("__vb"))
    d = pairs.join(va.hint("merge"), id_a).join(vb.hint("merge"), id_b)  # vectors may be far larger than the planner takes them for
    den = l2_norm("__va") * l2_norm("__vb")
    return (d.withColumn("cosine", F.when(den == 0, F.lit(0.0)).otherwise(dot("__va", "__vb") / den))
             .drop("__va", "__vb"))


def vectors_long(vecs: DataFrame, id_col: str, vec: str) -> DataFrame:
    """Dense array column -> long ``(id, dim, value)`` form (for join-driven dots)."""
    return vecs.select(id_col, F.posexplode(vec).alias("dim", "value")).withColumn(
        "value", F.col("value").cast("double"))


#: Rows of one block of a dense product, and entries of the strip of it that is held at a time.
DENSE_BLOCK = 16_384
DENSE_STRIP = 4_000_000


def _block_topk(k: int, tie_digits: int, exclude_same: bool = False, keep_own: bool = False):
    import numpy as np
    import pandas as pd

    def fn(q: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
        if q.empty or cands.empty:
            return pd.DataFrame({"a": pd.Series([], "int64"), "b": pd.Series([], "int64"),
                                 "sim": pd.Series([], "float64")})
        cands = cands.sort_values("id", kind="stable")  # ties go by partner id
        qa = np.stack(q["v"].to_numpy()).astype(np.float64)
        ca = np.stack(cands["v"].to_numpy()).astype(np.float64)
        qn = np.linalg.norm(qa, axis=1)
        cn = np.linalg.norm(ca, axis=1)
        qid, cid = q["id"].to_numpy(), cands["id"].to_numpy()
        qg, cg = q["g"].to_numpy(), cands["g"].to_numpy()
        out = []
        step = max(1, DENSE_STRIP // len(cid))
        for at in range(0, len(qid), step):
            s = slice(at, at + step)
            den = np.outer(qn[s], cn)
            with np.errstate(divide="ignore", invalid="ignore"):
                sims = np.where(den == 0, 0.0, (qa[s] @ ca.T) / den)
            if not keep_own:
                sims[qid[s][:, None] == cid[None, :]] = -np.inf  # the query itself is removed
            if exclude_same:  # hard negatives: only partners of another group compete
                sims[qg[s][:, None] == cg[None, :]] = -np.inf
            out.append(_best_of_rows(sims, qid[s], cid, k, tie_digits))
        a, b, sim = (np.concatenate([x[i] for x in out]) for i in range(3))
        return pd.DataFrame({"a": a.astype("int64"), "b": b.astype("int64"), "sim": sim})
    return fn


def _blocked_topk(queries: DataFrame, cands: DataFrame, k: int, block_rows: int, tie_digits: int,
                  exclude_same: bool, keep_own: bool = False) -> DataFrame:
    """Top-k candidates per query over (query block x candidate block) cogrouped NumPy products.

    ``queries``/``cands`` have columns (id long, v array, g). Block counts come
    from the row counts so a task holds at most ~block_rows rows of each side.
    """
    nq = max(1, -(-queries.count() // block_rows))
    nc = max(1, -(-cands.count() // block_rows))
    qb = F.pmod(F.xxhash64("id"), F.lit(nq))
    cb = F.pmod(F.xxhash64("id"), F.lit(nc))
    q = queries.select("id", "v", "g", qb.alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nc - 1).cast("long"))).alias("cb"))
    c_ = cands.select("id", "v", "g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nq - 1).cast("long"))).alias("qb"), cb.alias("cb"))
    part = (q.groupBy("qb", "cb").cogroup(c_.groupBy("qb", "cb"))
              .applyInPandas(_block_topk(k, tie_digits, exclude_same, keep_own), "a long, b long, sim double"))
    order = [F.desc(F.round("sim", tie_digits)), F.col("b")]
    return top_k_per_key(part, "a", order, k, rank_col="rank", salt_cols=["b"])


def knn_join(vecs: DataFrame, k: int, id_col: str = "id", vec: str = "embedding",
             block_rows: int = DENSE_BLOCK, tie_digits: int = 9, exclude_same: str | None = None, asked=None) -> DataFrame:
    """Exact top-k nearest rows by cosine (self removed), for every row or those where ``asked`` holds.

    Rows are hashed into B blocks (B from the row count and ``block_rows``).
    Each (query block, candidate block) pair is one cogrouped task that runs
    a NumPy matrix product and keeps its own top-k per query; the final top-k
    per query then ranks at most B*k survivors. A task holds two blocks and a
    strip of their product whatever the table size; no cross join, no pair table.
    ``exclude_same`` names a group column whose members may not be partners
    (hard negatives, J12).
    """
    g = F.col(exclude_same) if exclude_same else F.lit(0)
    base = vecs.select(F.col(id_col).cast("long").alias("id"), F.col(vec).alias("v"), g.alias("g"))
    q = base if asked is None else vecs.filter(asked).select(F.col(id_col).cast("long").alias("id"), F.col(vec).alias("v"), g.alias("g"))
    return _blocked_topk(q, base.toDF("id", "v", "g"), k, block_rows, tie_digits, exclude_same is not None)


def nearest(vecs: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vec: str = "embedding",
            q_id: str = "query", q_vec: str = "embedding", block_rows: int = DENSE_BLOCK, tie_digits: int = 9,
            keep_own: bool = False) -> DataFrame:
    """Top-k rows of ``vecs`` nearest (cosine) to each query vector; a row with the query's id is removed
    (``keep_own`` for two tables of counterparts, where it is the one looked for)."""
    c_ = vecs.select(F.col(id_col).cast("long").alias("id"), F.col(vec).alias("v"), F.lit(0).alias("g"))
    q = queries.select(F.col(q_id).cast("long").alias("id"), F.col(q_vec).alias("v"), F.lit(0).alias("g"))
    return _blocked_topk(q, c_, k, block_rows, tie_digits, False, keep_own).withColumnRenamed("a", "query")


def paired_distance(a: DataFrame, b: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """Cosine of each item with its own counterpart (matched by key)."""
    j = a.select(key, F.col(vec).alias("__va")).join(b.select(key, F.col(vec).alias("__vb")), key)
    den = l2_norm("__va") * l2_norm("__vb")
    return j.select(key, F.when(den == 0, 0.0).otherwise(dot("__va", "__vb") / den).alias("cosine"))


def matched_against_random(a: DataFrame, b: DataFrame, key: str, group: str, vec: str = "embedding", seed: int = 0) -> DataFrame:
    """Per group and overall, the mean cosine of items of ``a`` with their own counterparts in ``b`` and with another
    item's: ``(bucket, n, mean_matched, mean_random, correlation)``.

    The other is the next item in md5 order (round to the first from the last), so every item serves once; the order is a
    distributed index and the partner an equi-join on it.
    """
    from tessera.functions.exprs import md5_order
    from tessera.functions.rows import attach_row
    from tessera.functions.skew import dense_index
    j = a.select(key, group, F.col(vec).alias("x")).join(b.select(key, F.col(vec).alias("y")), key)
    i = dense_index(j.withColumn("__o", md5_order(seed, key)), ["__o", key], "__i")
    i = attach_row(i, i.agg(F.count(F.lit(1)).alias("__n")))
    nxt = i.select(F.col("__i").alias("__p"), F.col("y").alias("z"))
    d = i.withColumn("__p", F.pmod(F.col("__i") + 1, F.col("__n"))).join(nxt, "__p")

    def cosine(p, q):
        den = l2_norm(p) * l2_norm(q)
        return F.when(den == 0, 0.0).otherwise(dot(p, q) / den)

    d = cut_lineage(d.select(F.col(group).cast("string").alias("bucket"), cosine("x", "y").alias("m"), cosine("x", "z").alias("r")))
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("m").alias("mean_matched"), F.avg("r").alias("mean_random"), F.corr("m", "r").alias("correlation")]
    return d.groupBy("bucket").agg(*aggs).unionByName(d.agg(F.lit("all").alias("bucket"), *aggs))


def class_centroids(vecs: DataFrame, label: str, vec: str = "embedding") -> DataFrame:
    """Mean vector per class in long form ``(label, dim, value)`` (a partial aggregate)."""
    return (vecs.select(label, F.posexplode(vec).alias("dim", "value"))
                .groupBy(label, "dim").agg(F.avg(F.col("value").cast("double")).alias("value")))


def centroid_scores(vecs: DataFrame, centroids: DataFrame, label: str, vec: str = "embedding") -> DataFrame:
    """Rows of ``vecs`` plus ``scores``: map from class to (v . c) / |c| (0 for a class vector without length).

    The classes (few) travel as one row of class vectors that is attached to
    every row, so vectors are neither exploded nor shuffled.
    """
    c = centroids.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("__e"), F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("__n"))
    one = c.agg(F.collect_list(F.struct(F.col(label).alias("c"), F.transform("__e", lambda x: x["value"]).alias("x"), F.col("__n").alias("n"))).alias("__classes"))
    from tessera.functions.rows import attach_row
    score = lambda k: F.when(k["n"] == 0, F.lit(0.0)).otherwise(F.aggregate(F.zip_with(F.col(vec), k["x"], lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v) / k["n"])
    return attach_row(vecs, one).withColumn("scores", F.map_from_entries(F.transform("__classes", lambda k: F.struct(k["c"], score(k))))).drop("__classes")


def nearest_centroid(vecs: DataFrame, centroids: DataFrame, id_col: str, label: str,
                     vec: str = "embedding", tie_digits: int = 9) -> DataFrame:
    """Class of the nearest class vector by cosine (ties by class) -> (id, predicted, score), in the row."""
    s = centroid_scores(vecs.select(id_col, vec), centroids, label, vec)
    best = F.array_sort(F.transform(F.map_entries("scores"), lambda x: F.struct((-F.round(x["value"], tie_digits)).alias("s"), x["key"].alias("c"), x["value"].alias("v"))))
    return s.select(id_col, F.get(best, F.lit(0)).alias("b")).select(id_col, F.col("b.c").alias("predicted"), F.col("b.v").alias("score"))
