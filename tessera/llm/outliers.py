"""Quality rules by robust multivariate outliers (operator 13).

Every whole text gives counts of words, symbols, repeated lines and repeated
8-word windows. Documents that fail a fixed base rule are out. The others of
one language and source get a minimum-covariance-determinant estimate of the
centre and spread of their transformed statistics: concentration steps keep
the three quarters nearest to the current estimate and estimate anew, from two
deterministic starts, and the smaller determinant wins. Documents whose
Mahalanobis distance from it is beyond a chi-square bound are rejected. All of
it is DataFrame functions; sums are of integers, so that no order of rows,
tasks or retries changes a verdict.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD_PATTERN, Wide, let, materialise, pick, word_count

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
#: Documents that an estimate needs; sources with fewer are pooled within their language, then over all.
LEAST_GROUP = 100
SHARE = 0.75
STEPS = 6
#: Share of ordinary documents within the bound.
CERTAINTY = 0.99999
#: Transformed statistics are integers in units of 1 / UNIT.
UNIT = 1024
#: Least standard deviation of each statistic: words, word length, symbols, repeated lines, repeated words.
FLOORS = (0.5, 0.15, 0.5, 1.0, 1.0)
DIM = len(FLOORS)
#: Squared distances are counted in bins of 1/8 of a doubling.
BINS_PER_DOUBLING = 8

_SPACE = " \t\n\x0b\f\r"


def repeated_words(text: Column, n_words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the text, first occurrences included."""
    def covered(words: Column) -> Column:
        def of_hashes(h: Column) -> Column:
            place = F.array_sort(F.zip_with(h, F.sequence(F.lit(1), F.size(h)), lambda a, i: F.struct(a.alias("h"), i.alias("i"))))
            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(place, of_places))

        def of_places(p: Column) -> Column:
            # equal windows are neighbours in hash order; their words are compared, so hashes only propose
            same = lambda a, b: F.coalesce((a["h"] == b["h"]) & (F.slice(words, a["i"], window) == F.slice(words, b["i"], window)), F.lit(False))
            twice = F.filter(p, lambda x, k: same(x, F.get(p, k + 1)) | same(x, F.get(p, k - 1)))
            return let(F.array_sort(F.transform(twice, lambda x: x["i"])), lambda at: F.aggregate(
                F.transform(at, lambda i, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - i, F.lit(window)))), F.lit(0), lambda a, b: a + b))

        return let(F.transform(words, lambda w: F.xxhash64(w)), lambda hw: let(
            F.transform(F.sequence(F.lit(1), F.size(hw) - (window - 1)), lambda i: F.xxhash64(F.slice(hw, i, window))), of_hashes))

    cut = F.split(F.btrim(text, F.lit(_SPACE)), r"[\x20\x09-\x0D]+", -1)
    return F.when(n_words > window, let(cut, covered)).otherwise(F.lit(0)).cast("long")


def statistics(text: Column) -> dict[str, Column]:
    """Counts of one whole text (null: none), all long: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    n_lines counts the lines that hold a word, n_dup_lines those of them equal to an earlier line.
    """
    t = F.coalesce(text, F.lit(""))
    n = word_count(t)
    lines = let(F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD_PATTERN)),
                lambda x: F.struct(F.size(x).cast("long").alias("all"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    return {"n_words": n, "word_chars": (F.length(t) - F.regexp_count(t, F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
            "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"), "lines": lines, "n_repeat_words": repeated_words(t, n)}


def _measured(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` plus the statistics, base_failed and x (transformed statistics of those that pass)."""
    d = rows.withColumns(statistics(text))
    d = d.withColumn("n_lines", F.col("lines")["all"]).withColumn("n_dup_lines", F.col("lines")["dup"]).drop("lines")
    d = d.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    per = lambda a, b: F.log1p(100 * F.col(a) / F.col(b))
    x = F.array(*[F.round(v * UNIT).cast("long") for v in (
        F.log1p(F.col("n_words")), F.log(F.col("word_chars") / F.col("n_words")), per("n_symbols", "n_words"), per("n_dup_lines", "n_lines"), per("n_repeat_words", "n_words"))])
    return d.withColumn("x", F.when(~F.col("base_failed"), x))


def chi_square(x: float, k: int) -> float:
    """Probability that a chi-square of odd ``k`` degrees of freedom is at most x."""
    p, j = math.erf(math.sqrt(x / 2)), 1
    while j < k:
        p, j = p - (x / 2) ** (j / 2) * math.exp(-x / 2) / math.gamma(j / 2 + 1), j + 2
    return p


def chi_square_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, k) < p else (low, mid)
    return high


#: Squared distance up to which a document is kept.
BOUND = chi_square_quantile(CERTAINTY, DIM)
#: The nearest SHARE of a normal sample is narrower than the whole by this factor (of variances).
WIDEN = SHARE / chi_square(chi_square_quantile(SHARE, DIM), DIM + 2)


def _state(mean: list[Column], cov) -> Column:
    """Struct (m, inv, logdet) of a centre and a covariance ``cov(i, j)``: inverse by sweeping each pivot once."""
    floor = lambda i, j: F.lit(FLOORS[i] ** 2 if i == j else 0.0)
    flat = F.array(*[(cov(min(i, j), max(i, j)) + floor(i, j)).cast("double") for i in range(DIM) for j in range(DIM)])

    def sweep(s: Column, k: Column) -> Column:
        a = s["a"]

        def cell(v: Column, ij: Column, pivot: Column) -> Column:
            i, j = F.floor(ij / DIM).cast("int"), ij % DIM
            row, col = F.get(a, i * DIM + k), F.get(a, k * DIM + j)
            return (F.when((i == k) & (j == k), -1 / pivot).when((i == k) | (j == k), v / pivot).otherwise(v - row * col / pivot))

        return let(F.get(a, k * DIM + k), lambda pivot: F.struct(F.transform(a, lambda v, ij: cell(v, ij, pivot)).alias("a"), (s["logdet"] + F.log(pivot)).alias("logdet")))

    swept = F.aggregate(F.sequence(F.lit(0), F.lit(DIM - 1)), F.struct(flat.alias("a"), F.lit(0.0).alias("logdet")), sweep)
    return let(swept, lambda s: F.struct(F.array(*[m.cast("double") for m in mean]).alias("m"), F.transform(s["a"], lambda v: -v).alias("inv"), s["logdet"].alias("logdet")))


def distance(x: Column, state: Column) -> Column:
    """Squared Mahalanobis distance of transformed statistics from an estimate."""
    dev = [F.get(x, F.lit(i)) / UNIT - F.get(state["m"], F.lit(i)) for i in range(DIM)]
    terms = [dev[i] * dev[j] * F.get(state["inv"], F.lit(i * DIM + j)) * (1 if i == j else 2) for i in range(DIM) for j in range(i, DIM)]
    return sum(terms[1:], terms[0])


_PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]


def _moments() -> list[Column]:
    x = lambda i: F.get("x", F.lit(i))
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x(i)).alias(f"s{i}") for i in range(DIM)], *[F.sum(x(i) * x(j)).alias(f"q{i}{j}") for i, j in _PAIRS]]


def _of_moments(widen: float) -> Column:
    mean = [F.col(f"s{i}") / F.col("n") / UNIT for i in range(DIM)]
    return _state(mean, lambda i, j: (F.col(f"q{i}{j}") / F.col("n") / UNIT / UNIT - mean[i] * mean[j]) * widen)


def _starts(rows: DataFrame) -> DataFrame:
    """``key, start, state``: medians with quartile distances, and plain mean and covariance."""
    plain = rows.groupBy("key").agg(*_moments()).select("key", F.lit(0).alias("start"), _of_moments(1.0).alias("state"))
    values = rows.select("key", F.posexplode("x").alias("dim", "v")).groupBy("key", "dim", "v").agg(F.count(F.lit(1)).alias("c"))
    # distinct values of one statistic are few: logarithms in steps of 1 / UNIT
    w = Window.partitionBy("key", "dim")
    cum = values.withColumn("upto", F.sum("c").over(w.orderBy("v"))).withColumn("n", F.sum("c").over(w))
    at = lambda p: F.min(F.when(F.col("upto") >= F.col("n") * p, F.col("v"))) / UNIT
    q = cum.groupBy("key").pivot("dim", list(range(DIM))).agg(at(0.5).alias("m"), ((at(0.75) - at(0.25)) / 1.349).alias("s"))
    robust = q.select("key", F.lit(1).alias("start"), _state([F.col(f"{i}_m") for i in range(DIM)],
                                                             lambda i, j: F.pow(F.col(f"{i}_s"), 2) if i == j else F.lit(0.0)).alias("state"))
    return plain.unionByName(robust)


def _concentrate(rows: DataFrame, states: DataFrame, size: DataFrame) -> DataFrame:
    """One step: estimates from the SHARE of each key's rows nearest to its current ones (whole bins of distance)."""
    near = rows.join(states, "key")
    bin_ = F.floor(F.log2(distance(F.col("x"), F.col("state")) + F.lit(1.0 / UNIT)) * BINS_PER_DOUBLING)
    per = near.groupBy("key", "start", bin_.cast("int").alias("bin")).agg(*_moments()).join(size, "key")
    before = F.sum("n").over(Window.partitionBy("key", "start").orderBy("bin")) - F.col("n")
    names = ["n", *[f"s{i}" for i in range(DIM)], *[f"q{i}{j}" for i, j in _PAIRS]]
    got = per.withColumn("before", before).where(F.col("before") < F.ceil(F.col("key_n") * SHARE)).groupBy("key", "start").agg(*[F.sum(c).alias(c) for c in names])
    return got.select("key", "start", _of_moments(WIDEN).alias("state"))


def _key(level: int, *cols: str) -> Column:
    return F.to_json(F.struct(F.lit(level).alias("level"), *[F.col(c).alias(c) for c in cols]))


def _keys(passed: DataFrame) -> DataFrame:
    """``g_lang, g_source, key, key_n``: the pool that each language and source is estimated in (key null: too few documents everywhere)."""
    g = passed.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < LEAST_GROUP
    g = g.withColumn("key", F.when(~small, _key(0, "lang", "source")).otherwise(_key(1, "lang")))
    pools = g.groupBy("key").agg(F.sum("n").alias("pool"))
    g = g.join(pools, "key").withColumn("key", F.when(F.col("pool") < LEAST_GROUP, _key(2)).otherwise(F.col("key")))
    pools = g.groupBy("key").agg(F.sum("n").alias("key_n"))
    return g.join(pools, "key").select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"),
                                       F.when(F.col("key_n") >= LEAST_GROUP, F.col("key")).alias("key"), "key_n")


def estimates(narrow: DataFrame) -> DataFrame:
    """``g_lang, g_source, key, state`` for each language and source with enough documents, from (lang, source, x).

    Rows are pre-aggregated by key and distance bin before any shuffle, so a
    hot source costs no more than its share of the scans.
    """
    passed = narrow.where(F.col("x").isNotNull()).select("lang", "source", "x")
    keys = materialise(_keys(passed))
    rows = materialise(passed.join(keys.where("key is not null"), F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))).select("key", "x"))
    size = keys.where("key is not null").select("key", "key_n").distinct()
    states = materialise(_starts(rows))
    for _ in range(STEPS):
        states = materialise(_concentrate(rows, states, size))
    best = states.groupBy("key").agg(F.min_by("state", F.struct(F.col("state")["logdet"], F.col("start"))).alias("state"))
    return materialise(keys.join(best, "key").select("g_lang", "g_source", "key", "state"))


def _judged(measured: DataFrame, known: DataFrame, lang: Column, source: Column) -> DataFrame:
    out = measured.join(known, lang.eqNullSafe(F.col("g_lang")) & source.eqNullSafe(F.col("g_source")), "left")
    out = out.withColumn("distance", distance(F.col("x"), F.col("state")))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= BOUND, F.lit(True)))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the statistics, ``base_failed, distance, kept``.

    distance is the squared Mahalanobis distance (null where the base rule
    failed, or where fewer than ``LEAST_GROUP`` documents pass in the source,
    in the small sources of its language and in all such pools together: such
    documents are kept). Null and empty texts have no words and fail the base
    rule. Null languages and sources are groups of their own. Repeated rows and
    ids are judged once each; an empty table gives no rows; extra columns are
    ignored. Whole texts are read, however long.
    """
    d = pick(docs, "doc_id", "text", "lang", "source")
    narrow = materialise(_measured(d, F.col("text")).drop("text"))
    out = _judged(narrow, estimates(narrow), F.col("lang"), F.col("source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept")


def keep_ordinary(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that :func:`judge` rejects; all columns pass through.

    The statistics are computed a second time beside the text instead of
    shuffling texts to a table of verdicts.
    """
    d = pick(docs, "text", "lang", "source")
    known = estimates(materialise(_measured(d, F.col("text")).select("lang", "source", "x")))
    w = Wide(docs)
    return w.restore(_judged(_measured(w.frame, w.col("text")), known, w.col("lang"), w.col("source")).where("kept"))
