"""Exact set-similarity join (N09): every pair of token sets whose Jaccard index reaches a threshold.

Prefix filtering: if the tokens of all sets are put in one global order, rare
ones first, two sets with Jaccard >= t share a token among the first
``n - ceil(t n) + 1`` of each. Only those prefixes are joined, on (token,
length class), and only tokens that at least two sets hold; length and
position bounds drop most of what meets, the rest is verified exactly.
Equal sets are one class first, so exact copies never meet in pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import bind
from tessera.functions.skew import salted_self_join
from tessera.session import cut_lineage


def shingle_sets(docs: DataFrame, id_col: str, text: str, k: int = 5) -> DataFrame:
    """``(id, tokens)``: the distinct k-word shingles of each whole text as sorted 64-bit hashes.

    Texts are lower-cased and cut at whitespace; a text with fewer than k words is one shingle, one
    without words (or null) has none.
    """
    def tokens(w):
        many = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k)))
        return F.when(F.size(w) >= k, many).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")
    return docs.select(F.col(id_col).alias("id"), F.array_sort(F.array_distinct(bind(words, tokens))).alias("tokens"))


def set_classes(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rep, tokens)`` of each distinct non-empty set (rep: its smallest id) and ``(id, rep)`` of every row that has one.

    Sets are grouped by a 128-bit digest of the sorted tokens, never by the tokens themselves.
    """
    d = cut_lineage(sets.filter(F.size("tokens") > 0).select("id", "tokens", F.md5(F.array_join(F.col("tokens").cast("array<string>"), ",")).alias("digest")))
    rep = cut_lineage(d.groupBy("digest").agg(F.min("id").alias("rep")))
    members = d.select("id", "digest").join(rep, "digest").select("id", "rep")
    reps = d.join(rep.select("digest", F.col("rep").alias("id")), ["digest", "id"]).select(F.col("id").alias("rep"), "tokens").dropDuplicates(["rep"])
    return cut_lineage(reps), members


def _prefixes(reps: DataFrame, threshold: float) -> DataFrame:
    """``(rep, n, token, pos)``: the prefix tokens of each set that other sets hold too; pos counts from 1 in the global order."""
    uses = reps.select("rep", F.size("tokens").cast("long").alias("n"), F.explode("tokens").alias("token"))
    df = uses.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = uses.join(df, "token")
    of_set = Window.partitionBy("rep")  # at most one set's tokens
    # tokens that only this set holds come first in the order, so their number places the shared ones
    pos = F.col("n") - F.count(F.lit(1)).over(of_set) + F.row_number().over(of_set.orderBy("df", "token"))
    keep = F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9) + 1
    return cut_lineage(shared.withColumn("pos", pos).filter(F.col("pos") <= keep).select("rep", "n", "token", "pos"))


def similarity_pairs(reps: DataFrame, threshold: float = 0.8, salt_above: int = 20000) -> DataFrame:
    """``(id_a, id_b, jaccard)``, id_a > id_b: all pairs of distinct sets ``(rep, tokens)`` with Jaccard >= threshold.

    Hot tokens are split over salted tasks; a pair that meets in several tokens is verified once.
    """
    base = math.log(1 / threshold)
    level = F.floor(F.log(F.col("n").cast("double")) / F.lit(base)).cast("long")
    p = _prefixes(reps, threshold).withColumn("level", level)
    # the smaller set (x) meets larger ones of its own length class or the next
    x = p.select(F.struct("token", "level").alias("k"), F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"))
    y = p.select(F.explode(F.array("level", F.col("level") - 1)).alias("at"), "token", "rep", "n", "pos").select(
        F.struct("token", F.col("at").alias("level")).alias("k"), F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"))
    met = salted_self_join(x, y, "k", "x", threshold=salt_above).filter(
        ((F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))) & (F.col("nx") >= F.col("ny") * F.lit(threshold) - 1e-9))
    need = F.ceil((F.col("nx") + F.col("ny")) * F.lit(threshold / (1 + threshold)) - 1e-9)
    # past the first common token there is room for no more than what is left of either set
    cand = (met.groupBy("x", "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"), F.min("px").alias("px"), F.min("py").alias("py"))
            .filter(1 + F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) >= need))
    sets = reps.select(F.col("rep").alias("x"), F.col("tokens").alias("tx"))
    both = cand.select("x", "y").join(sets, "x").join(sets.toDF("y", "ty"), "y")
    inter = F.size(F.array_intersect("tx", "ty"))
    j = both.select(F.greatest("x", "y").alias("id_a"), F.least("x", "y").alias("id_b"), (inter / (F.size("tx") + F.size("ty") - inter)).alias("jaccard"))
    return j.filter(F.col("jaccard") >= threshold - 1e-12)


def near_duplicate_links(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, threshold: float = 0.8) -> DataFrame:
    """``(id_a, id_b, jaccard)`` — every text linked to the smallest id with the same shingles (jaccard 1), and all
    similar pairs of those representatives. Nothing is lost: two texts are similar exactly if their
    representatives are equal or linked. Texts without words are linked with nothing.
    """
    reps, members = set_classes(shingle_sets(docs, id_col, text, k))
    copies = members.filter("id <> rep").select(F.col("id").alias("id_a"), F.col("rep").alias("id_b"), F.lit(1.0).alias("jaccard"))
    return copies.unionByName(similarity_pairs(reps, threshold))
