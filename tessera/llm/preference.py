"""Preference formatting of chosen and rejected conversations (operator 6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.skew import dense_index, running_in_group
from tessera.llm.common import materialise, pick

#: Role whose turns are trained on inside a completion.
TRAINED = "assistant"


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


FOOTER = "<|end|>\n"


def preference_segments(turns: DataFrame, trained: str = TRAINED) -> DataFrame:
    """Rendered turns of every pair: ``pair_id, part, seq, role, rendered, mask_start, mask_end``.

    ``turns`` holds ``pair_id, side ('chosen' or 'rejected'), turn, role,
    text``. The longest common prefix of turns (equal role and text, in turn
    order) becomes the part ``prompt``, rendered once; what follows on each
    side is its completion (part ``chosen`` or ``rejected``). ``seq`` counts a
    part's turns from 1. The code points [mask_start, mask_end) of a rendered
    turn are trained on: text and end mark of a completion's ``trained``
    turns; elsewhere both are 0.

    A conversation is never gathered: turns are numbered by a range sort and
    compared place by place, so a conversation of any length spreads over
    tasks. Nulls: a null pair_id is dropped (nothing pairs it), as are sides
    other than the two; a null text or role equals only another null and
    renders as empty; a null turn comes first. Ties of turn are put in the
    order of role, then text; repeated rows are turns of their own. A pair
    with one side only, or with equal sides, has no or empty completions and
    is kept that way. An empty table gives an empty result; extra columns are
    ignored.
    """
    t = pick(turns, "pair_id", "side", "turn", "role", "text").where("pair_id is not null and side in ('chosen', 'rejected')")
    t = materialise(running_in_group(t, ["pair_id", "side"], [F.col("turn"), F.col("role"), F.col("text")], out="pos"))
    key = F.struct(F.col("role"), F.col("text"))
    # one row per place of a pair; where the two sides differ or one has ended, the prefix is over
    place = t.groupBy("pair_id", "pos").agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64(F.lit(0), key, F.col("role").isNull(), F.col("text").isNull())).alias("lo"),
                                            F.max(F.xxhash64(F.lit(0), key, F.col("role").isNull(), F.col("text").isNull())).alias("hi"),
                                            F.min(F.struct("role", "text")).alias("a"), F.max(F.struct("role", "text")).alias("b"))
    differs = (F.col("n") < 2) | (F.col("lo") != F.col("hi")) | ~F.col("a").eqNullSafe(F.col("b"))
    # a pair without any difference ends after its last place
    over = place.groupBy("pair_id").agg(F.coalesce(F.min(F.when(differs, F.col("pos"))), F.max("pos") + 1).alias("over"))
    d = t.join(materialise(over), "pair_id")
    shared = F.col("pos") < F.col("over")
    d = d.where(~shared | (F.col("side") == "chosen"))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    lead = header(role)
    on = ~shared & (role == trained)
    rendered = F.concat(lead, text, F.lit(FOOTER))
    return d.select("pair_id", F.when(shared, "prompt").otherwise(F.col("side")).alias("part"),
                    F.when(shared, F.col("pos")).otherwise(F.col("pos") - F.col("over") + 1).cast("long").alias("seq"), F.col("role"),
                    rendered.alias("rendered"), F.when(on, F.length(lead)).otherwise(0).cast("long").alias("mask_start"),
                    F.when(on, F.length(rendered)).otherwise(0).cast("long").alias("mask_end"))


def assemble(segments: DataFrame) -> DataFrame:
    """One training example per pair: ``pair_id, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    The texts join a part's rendered turns; a mask is the array of trained
    [start, end) code points of its completion. A part without turns is the
    empty text. This gathers each conversation into one row, as an example
    is one row by its nature; use the segments where conversations are
    unbounded.
    """
    one = lambda part: F.transform(F.array_sort(F.collect_list(F.when(F.col("part") == part, F.struct("seq", "rendered", "mask_start", "mask_end")))), lambda s: s)
    g = segments.groupBy("pair_id").agg(*[one(p).alias(p) for p in ("prompt", "chosen", "rejected")])
    text = lambda p: F.array_join(F.transform(p, lambda s: s["rendered"]), "")

    def mask(p):
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out"))
        return F.aggregate(p, start, lambda acc, s: F.struct((acc["at"] + F.length(s["rendered"])).alias("at"), F.when(
            s["mask_end"] > 0, F.concat(acc["out"], F.array(F.struct((acc["at"] + s["mask_start"]).alias("start"), (acc["at"] + s["mask_end"]).alias("end"))))).otherwise(
            acc["out"]).alias("out")))["out"]

    return g.select("pair_id", text("prompt").alias("prompt"), text("chosen").alias("chosen"), text("rejected").alias("rejected"),
                    mask("chosen").alias("chosen_mask"), mask("rejected").alias("rejected_mask"))


def borrowed_rejections(conversations: DataFrame, trained: str = TRAINED) -> DataFrame:
    """Pairs made from ``conversations`` (conv_id, turn, role, text), for data that holds no rejected answers.

    Chosen is every conversation with a ``trained`` turn, as it is. Rejected
    is the same conversation with the text of its last such turn replaced by
    that of the next conversation in conv_id order (the last takes the
    first's). Of several turns with the last number, the one with the
    greatest text is last. Null conv_ids are dropped.
    """
    c = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null").withColumn("turn", F.coalesce("turn", F.lit(-1)))
    last = c.where(F.col("role") == trained).groupBy("conv_id").agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("l"))
    ring = dense_index(last.select("conv_id", F.col("l.turn").alias("last_turn"), F.col("l.text").alias("last_text")), [F.col("conv_id")], out="i")
    ring = materialise(ring)
    n = ring.count()
    donor = ring.select(F.pmod(F.col("i") - 1, F.lit(max(n, 1))).alias("i"), F.col("last_text").alias("donor_text"))
    swap = materialise(ring.join(donor, "i").select("conv_id", "last_turn", "last_text", "donor_text"))
    t = c.join(swap, "conv_id")
    own = (F.col("turn") == F.col("last_turn")) & (F.col("role") == trained) & (F.coalesce("text", F.lit("")) == F.col("last_text"))
    side = lambda s, text: t.select(F.col("conv_id").alias("pair_id"), F.lit(s).alias("side"), "turn", "role", text.alias("text"))
    return side("chosen", F.col("text")).union(side("rejected", F.when(own, F.col("donor_text")).otherwise(F.col("text"))))


def pair_summary(segments: DataFrame) -> DataFrame:
    """Per pair: turns, characters and trained characters of its parts, and an order-bound checksum of all rendered turns."""
    part = lambda p, x: F.coalesce(F.sum(F.when(F.col("part") == p, x)), F.lit(0)).cast("long")
    chars, trained = F.length("rendered"), F.col("mask_end") - F.col("mask_start")
    sign = F.conv(F.substring(F.md5(F.concat_ws("|", "part", F.col("seq").cast("string"), "rendered")), 1, 8), 16, 10).cast("long")
    return segments.groupBy("pair_id").agg(
        part("prompt", F.lit(1)).alias("prompt_turns"), part("chosen", F.lit(1)).alias("chosen_turns"), part("rejected", F.lit(1)).alias("rejected_turns"),
        part("prompt", chars).alias("prompt_chars"), part("chosen", chars).alias("chosen_chars"), part("rejected", chars).alias("rejected_chars"),
        part("chosen", trained).alias("chosen_trained"), part("rejected", trained).alias("rejected_trained"), F.sum(sign).cast("long").alias("checksum"))
