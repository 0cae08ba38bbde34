"""Mixing sources to target weights (operator 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.skew import dense_index, running_in_group
from tessera.llm.common import Wide, materialise, unit_draw, word_count

#: Production weights: sources in code-point order (null last) take these in turn.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Target words of each source from ``sizes`` (source, size).

    Returns one row per source (a null source is one of its own, last):
    ``source, source_size, target``. ``share`` of all sizes is dealt by weight;
    a target stops at ``cap`` times its source's size and the excess is dealt
    anew by weight among the others until none is above (the fixed point of
    that rule is reached after at most one round per source; each round is one
    distributed sum whose two numbers go to the driver). Sources of size 0
    get target 0; an empty table gives an empty result.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    idx = dense_index(per, [F.col("source").isNull(), F.col("source")], out="i")
    k = len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("i"), F.lit(k)) + 1).cast("int"))
    t = materialise(idx.select("source", "source_size", w.alias("w"), (F.col("source_size") * F.lit(float(cap))).alias("cap")))
    total = t.agg(F.sum("source_size")).first()[0] or 0
    budget, level = float(total) * share, None
    while True:
        # a source is at its cap when the common rate per unit of weight would lift it above the cap
        full = F.lit(False) if level is None else F.col("w") * F.lit(level) > F.col("cap")
        r = t.agg(F.sum(F.when(full, F.col("cap"))).alias("given"), F.sum(F.when(~full, F.col("w"))).alias("open")).first()
        now = (budget - (r["given"] or 0.0)) / r["open"] if r["open"] else None
        if now is None or now == level:
            level = now
            break
        level = now
    target = F.col("cap") if level is None else F.least(F.col("w") * F.lit(level), F.col("cap"))
    return t.select("source", "source_size", F.greatest(target, F.lit(0.0)).alias("target"))


def numbered(rows: DataFrame, doc_id: Column, text_hash: Column, source: Column) -> DataFrame:
    """``rows`` plus ``draw_key``: what the Bernoulli draw of a row is hashed from.

    A doc_id that stands once is its own key. Rows without an id, or whose id
    is repeated, add the hash of their text, their source, and a number among
    the rows equal in all three, so that they draw on their own; which of two equal rows gets
    which number makes no difference to the mix. Only such rows are numbered
    (by a range sort, however many are equal); the others stay in place.
    """
    r = rows.withColumn("draw_id", doc_id.cast("string")).withColumn("text_hash", text_hash)
    r = r.withColumn("draw_source", F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("")))
    again = materialise(r.where("draw_id is not null").groupBy("draw_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("draw_id").alias("again")))
    r = r.join(again, F.col("draw_id") == F.col("again"), "left")
    alone = F.col("draw_id").isNotNull() & F.col("again").isNull()
    own = r.where(alone).withColumn("draw_key", F.col("draw_id"))
    same = r.where(~alone).withColumn("draw_key", F.concat_ws("|", F.coalesce("draw_id", F.lit("")), "text_hash", "draw_source"))
    if not same.isEmpty():
        same = running_in_group(same, "draw_key", [F.xxhash64("draw_key")], out="number")
        own = own.unionByName(same.withColumn("draw_key", F.concat_ws("|", "draw_key", F.col("number").cast("string"))).drop("number"))
    return own.drop("again", "draw_id", "text_hash", "draw_source")


def _copies(seed: str) -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (F.floor(rate) + F.when(unit_draw(seed, F.col("draw_key")) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def plan_mix(narrow: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = "mix") -> DataFrame:
    """Copies of each document: ``narrow`` (doc_id, source, size, text_hash) plus ``source_size, target, copies, taken``.

    rate = target / source_size; copies = floor(rate) plus one with probability
    equal to the fraction, drawn from a hash of the seed and the row's key (see
    ``numbered``), so reruns agree. As rate <= cap, nothing exceeds ``ceil(cap)``
    times its size. A source without words has rate 0.
    """
    t = materialise(targets(narrow.select("source", "size"), weights, share, cap)).withColumnRenamed("source", "t_source")
    d = numbered(narrow, F.col("doc_id"), F.col("text_hash"), F.col("source")).join(t, F.col("source").eqNullSafe(F.col("t_source")), "left").drop("t_source")
    return d.withColumn("copies", _copies(seed)).drop("draw_key").withColumn("taken", F.col("size") * F.col("copies"))


def _text_hash(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, text_hash`` of documents (size in words; null text has none)."""
    w = Wide(docs)
    return w.frame.select(w.col("doc_id").alias("doc_id"), w.col("source").alias("source"), word_count(w.col("text")).alias("size"), _text_hash(w.col("text")).alias("text_hash"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = "mix") -> DataFrame:
    """The mixed corpus: every document of ``docs`` as often as its source's rate says, all columns kept.

    Nulls: a null text has size 0 and follows its source's rate; a null source
    is a source of its own. Rows without a doc_id, and rows that repeat one,
    draw each on their own. An empty table gives an empty one; extra columns,
    clashing or not, pass through untouched.
    """
    w = Wide(docs)
    t = materialise(targets(measured(docs).select("source", "size"), weights, share, cap)).withColumnRenamed("source", "t_source")
    d = numbered(w.frame, w.col("doc_id"), _text_hash(w.col("text")), w.col("source")).join(t, w.col("source").eqNullSafe(F.col("t_source")), "left")
    out = d.withColumn("copies", _copies(seed).cast("int")).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return w.restore(out)
