"""Benchmark decontamination by spaced-seed hashing (operator 2). DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.skew import salted_self_join
from tessera.llm.common import Wide, let, materialise, pick

#: Token offsets that count, of the fixed masks; the others are ignored. These three meet every alignment of 8 to
#: 13 tokens of which at most one in five differs (checked by enumeration in the tests).
MASKS = ((0, 1, 2, 3, 5), (0, 1, 3, 4, 5), (0, 1, 5, 6, 7))
#: The same for items of 5 to 7 tokens.
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 4), (0, 1, 2, 4))
WINDOW = 13
SIMILARITY = 0.8
LEAST = 5
LONG = 8
#: Most benchmark seeds that are broadcast (about 40 MB); a larger benchmark is joined by shuffle instead.
BROADCAST_SEEDS = 1_000_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits of a text; null gives none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def seeds(hashes: Column, mask: tuple[int, ...], tag: int) -> Column:
    """One 64-bit hash per place of the mask: the tokens at its counting offsets, and the mask's number."""
    span = mask[-1] + 1
    return F.when(F.size(hashes) >= span, F.transform(F.slice(hashes, 1, F.size(hashes) - span + 1), lambda x, i: F.xxhash64(
        F.lit(tag), x, *[F.get(hashes, i + o) for o in mask[1:]]))).otherwise(F.array().cast("array<bigint>"))


def _hashes(t: Column) -> Column:
    return F.transform(t, lambda x: F.xxhash64(x))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps: ``doc_id, item_id, n_tokens, n_match, similarity, doc_pos, item_pos``, one row per document and item.

    A document overlaps an item when some alignment has a window of
    ``min(WINDOW, item tokens)`` tokens of which at least SIMILARITY agree
    place by place. Reported is the best window: most agreeing tokens, then
    the earliest document and item place. Only documents with an overlap get
    rows. Documents that share doc_id are told apart by their text but
    reported under that id once per item (the best of them).

    Items with fewer than LEAST tokens are too short to be told from chance
    and are left out, as are null texts on either side and null item_ids;
    a null doc_id is reported as null. Repeated rows give one row per
    (doc_id, item_id). Either table may be empty; extra columns are ignored.
    """
    out = _verified(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max("r").alias("r"))
    n_tokens = -F.col("r.w")
    return out.select("doc_id", "item_id", n_tokens.cast("long").alias("n_tokens"), F.col("r.n_match").cast("long").alias("n_match"),
                      (F.col("r.n_match") / n_tokens).alias("similarity"), (-F.col("r.d")).cast("long").alias("doc_pos"), (-F.col("r.i")).cast("long").alias("item_pos"))


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _verified(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, doc_key, item_id, r``: the best window of every verified alignment, ``doc_key`` the text's hash (see ``overlaps``)."""
    b = pick(benchmark, "item_id", "text").where("item_id is not null")
    items = materialise(b.select("item_id", tokens(F.col("text")).alias("t")).where(F.size("t") >= LEAST).distinct()
                        .select("item_id", "t", _hashes(F.col("t")).alias("h"), F.xxhash64("t").alias("item_key")))
    all_masks = [(i, m, F.size("h") >= LONG) for i, m in enumerate(MASKS)] + [(i + len(MASKS), m, F.size("h") < LONG) for i, m in enumerate(SHORT_MASKS)]
    short = not items.where(F.size("h") < LONG).isEmpty()
    used = all_masks if short else all_masks[:len(MASKS)]  # masks that no item can meet need no seeds
    want = reduce(DataFrame.unionByName, [items.where(fit).select("item_id", "item_key", F.posexplode(seeds(F.col("h"), m, i)).alias("item_pos", "seed"))
                                          for i, m, fit in used])
    want = materialise(want)
    keys = want.select("seed").distinct()
    n_seeds = want.count()
    d = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # one array of all masks' seeds; a seed's place in it gives mask and token place for the few that hit
    both = let(_hashes(tokens(F.col("text"))), lambda h: F.struct(F.size(h).alias("n"), F.concat(*[seeds(h, m, i) for i, m, _ in used]).alias("s")))
    lists = d.select("doc_id", F.xxhash64("text").alias("doc_key"), both.alias("b"))
    # the outer form, as the plain one would first compute everything once more to drop texts without seeds
    found = lists.select("doc_id", "doc_key", F.col("b.n").alias("n"), F.posexplode_outer("b.s").alias("at", "seed"))
    # distinct keys first: a join with the items' places would repeat the row of a common seed per place
    hits = materialise(found.join(F.broadcast(keys) if n_seeds <= BROADCAST_SEEDS else keys, "seed", "left_semi"))
    start, place = F.col("at"), F.lit(None)
    for _, m, _ in used:
        count = F.greatest(F.col("n") - m[-1], F.lit(0))
        place = F.coalesce(place, F.when((start >= 0) & (start < count), start))
        start = start - count
    # a common seed meets every place that items have it at: its documents are dealt over salted tasks
    diag = (salted_self_join(hits.select("doc_id", "doc_key", "seed", place.alias("doc_place")), want, "seed", "doc_key")
            .select("doc_id", "doc_key", "item_id", "item_key", (F.col("doc_place") - F.col("item_pos")).alias("diag")).distinct())
    diag = materialise(diag)
    # only documents with a hit are read and cut into tokens again
    texts = d.withColumn("doc_key", F.xxhash64("text")).join(
        materialise(diag.select("doc_id", "doc_key").distinct()).toDF("hit_id", "hit_key"),
        F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("doc_key") == F.col("hit_key")), "left_semi")
    texts = texts.dropDuplicates(["doc_id", "doc_key"]).select(F.col("doc_id").alias("text_id"), F.col("doc_key").alias("text_key"), _hashes(tokens(F.col("text"))).alias("dh"))
    line = F.col("item_id").eqNullSafe(F.col("i_id")) & (F.col("item_key") == F.col("i_key"))
    ready = (diag.join(items.select(F.col("item_id").alias("i_id"), F.col("item_key").alias("i_key"), F.col("h").alias("ih")), line).drop("i_id", "i_key")
             .join(texts, F.col("doc_id").eqNullSafe(F.col("text_id")) & (F.col("doc_key") == F.col("text_key"))).drop("text_id", "text_key"))
    first = F.greatest(F.lit(0), -F.col("diag"))
    last = F.least(F.size("ih"), F.size("dh") - F.col("diag"))
    width = F.least(F.lit(WINDOW), F.size("ih"))
    ready = ready.withColumn("first", first).withColumn("width", width).withColumn("room", last - first).where("room >= width")
    same = F.zip_with(F.slice("ih", F.col("first") + 1, F.col("room")), F.slice("dh", F.col("first") + F.col("diag") + 1, F.col("room")),
                      lambda x, y: (x == y).cast("int"))
    best = let(same, lambda a: F.array_max(F.transform(F.sequence(F.lit(0), F.col("room") - F.col("width")), lambda i: F.struct(
        F.aggregate(F.slice(a, i + 1, F.col("width")), F.lit(0), lambda s, x: s + x).alias("n"), (-i).alias("back")))))
    best = ready.withColumn("best", best).drop("ih", "dh").where(F.col("best.n") >= F.col("width") * F.lit(SIMILARITY) - F.lit(1e-9))
    doc_pos = F.col("first") + F.col("diag") - F.col("best.back")
    return best.select("doc_id", "doc_key", "item_id", F.struct(F.col("best.n").alias("n_match"), (-F.col("width")).alias("w"), (-doc_pos).alias("d"),
                                                                (-(F.col("first") - F.col("best.back"))).alias("i")).alias("r"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that overlap an item; all columns pass through.

    Rows that share a doc_id, or have none, are judged each by their own text;
    null and empty texts hold no passage and stay; repeated rows go or stay
    together. An empty table on either side leaves ``docs`` as it is.
    """
    w = Wide(docs)
    bad = materialise(_verified(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("doc_key").alias("bad_key")).distinct())
    return w.restore(w.frame.join(bad, w.col("doc_id").eqNullSafe(F.col("bad_id")) & (_text_key(w.col("text")) == F.col("bad_key")), "left_anti"))
