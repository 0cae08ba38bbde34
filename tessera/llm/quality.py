"""Quality classifier with hierarchical empirical Bayes (operator 10).

A logistic classifier turns a document's own text into evidence. Grouped sums
of that evidence give each host a posterior mean that is shrunk towards the
global prior, and each path of a host one that is shrunk towards its host;
how strongly is estimated from the spread between sites (method of moments).
A document's score is its evidence with the prior replaced by its path's,
which is made of the other documents of the path and its host.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Wide, materialise, pick

THRESHOLD = 0.5
#: Bounds of the shrinkage strength, in documents.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 10_000.0
_SYMBOL = re.compile(rb"[^A-Za-z0-9\s\x80-\xff.,;:'\"!?()-]")
FEATURES = ("bias_words", "mean_word", "distinct", "top_word", "repeats", "symbols", "odd_words", "lone_symbols", "digits", "upper", "ends", "line_repeats")


def text_features(data: bytes | None) -> list[float]:
    """Numbers in about [0, 1] of one whole text (UTF-8 bytes); an empty or null text gives zeros."""
    words = data.split() if data else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    count = Counter(words)
    size = len(data)
    marks = _SYMBOL.findall(data)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [float(np.log1p(n) / 10), min(size / n / 20, 2.0), len(count) / n, max(count.values()) / n, sum(map(eq, words, words[1:])) / n,
            min(len(marks) / n, 3.0), sum(bool(_SYMBOL.search(w)) * c for w, c in count.items()) / n,
            sum(c for w, c in count.items() if len(w) == 1 and _SYMBOL.match(w)) / n,
            sum(data.count(d) for d in (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9")) / size,
            sum(c for w, c in count.items() if w[:1].isupper()) / n, sum(c for w, c in count.items() if w[-1:] in b".!?") / n,
            1 - len(set(lines)) / len(lines)]


def features(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([text_features(b) for b in s])

    return udf(F.coalesce(text.cast("binary"), F.lit(b"")))


def fit_evidence(narrow: DataFrame, labels: DataFrame) -> tuple[list[float], float, float]:
    """Weights, intercept and prior of the document classifier, fitted on every labelled row of ``narrow`` (doc_id, f).

    A doc_id with several labels counts once per distinct label. Without
    labels of both classes the weights are zero and the prior is the share of
    good labels (one half without any).
    """
    y = pick(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)").distinct()
    known = materialise(narrow.join(y, "doc_id").select("f", F.col("quality").cast("double").alias("label")))
    n, good = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or good in (0.0, float(n)):
        p = (good + 1) / (n + 2) if n else 0.5
        return [0.0] * len(FEATURES), float(np.log(p / (1 - p))), p
    m = LogisticRegression(featuresCol="v", labelCol="label", maxIter=100, regParam=1e-5, standardization=True).fit(
        known.select(array_to_vector("f").alias("v"), "label"))
    return [float(x) for x in m.coefficients], float(m.intercept), float(good / n)


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(sites: DataFrame, mean: Column) -> float:
    """Documents' worth of prior that a site's own mean is weighed against: within-site variance over the variance of sites.

    Both come from grouped sums (n, s, squares) by the method of moments: the
    spread of site means round their prior beyond what the scatter of
    documents round their own site's mean explains. One row to the driver.
    """
    r = sites.withColumn("prior", mean).where("n > 0").agg(
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within"), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("prior"), 2)).alias("spread"),
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count(F.lit(1)).alias("k")).first()
    if not r["n"] or r["n"] <= r["k"]:
        return MOST_STRENGTH
    within = max(0.0, r["within"]) / (r["n"] - r["k"])
    between = (r["spread"] - r["k"] * within) / r["n"]
    if between <= 0:
        return MOST_STRENGTH
    return float(min(MOST_STRENGTH, max(LEAST_STRENGTH, within / between)))


class Fitted:
    """The classifier's weights, and what every site's posterior is made of (a table: sums of hosts and of their paths)."""

    def __init__(self, narrow: DataFrame, labels: DataFrame):
        self.weights, self.bias, prior = fit_evidence(narrow, labels)
        scored = narrow.withColumn("p_text", self.p_text(F.col("f")))
        paths = materialise(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p_text").alias("s"), F.sum(F.col("p_text") * F.col("p_text")).alias("q")))
        hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
        world = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
        self.mean = world["s"] / world["n"] if world["n"] else prior
        self.k_host = _strength(hosts, F.lit(self.mean))
        hosts = hosts.select(F.col("host").alias("site_host"), F.col("n").alias("host_n"), F.col("s").alias("host_s"))
        sites = materialise(paths.join(hosts, F.col("host").eqNullSafe(F.col("site_host"))))
        self.k_path = _strength(sites, (F.col("host_s") + self.k_host * self.mean) / (F.col("host_n") + self.k_host))
        self.sites = materialise(sites.select("site_host", F.col("path").alias("site_path"), "host_n", "host_s", F.col("n").alias("path_n"), F.col("s").alias("path_s")))

    def p_text(self, f: Column) -> Column:
        """Probability of good quality from the features alone."""
        z = F.lit(self.bias)
        for i, x in enumerate(self.weights):
            z = z + F.get(f, F.lit(i)) * F.lit(x)
        return 1 / (1 + F.exp(-z))

    def scored(self, rows: DataFrame, host: Column, path: Column) -> DataFrame:
        """``rows`` (with p_text) plus host_posterior, path_posterior and score.

        A document's own evidence is taken out of its host's and its path's
        sums first: it must not count twice.
        """
        out = rows.join(self.sites, host.eqNullSafe(F.col("site_host")) & path.eqNullSafe(F.col("site_path")), "left")
        own = F.col("p_text")
        out = out.withColumn("host_posterior", (F.col("host_s") - own + self.k_host * self.mean) / (F.col("host_n") - 1 + self.k_host))
        out = out.withColumn("path_posterior", (F.col("path_s") - own + self.k_path * F.col("host_posterior")) / (F.col("path_n") - 1 + self.k_path))
        odds = _logit(F.col("p_text")) - _logit(F.lit(self.mean)) + _logit(F.col("path_posterior"))
        return out.withColumn("score", 1 / (1 + F.exp(-odds)))


def _narrow(docs: DataFrame, host: str, path: str) -> DataFrame:
    d = pick(docs, doc_id="doc_id", text="text", host=host, path=path)
    return materialise(d.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.col("host").cast("string").alias("host"),
                                F.col("path").cast("string").alias("path"), features(F.col("text")).alias("f")))


def score_documents(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, text_hash, p_text, host_posterior, path_posterior, score, keep``.

    ``host`` and ``path`` name the columns of the two site levels (of
    ``documents``: source, and lang within it). p_text is the classifier's
    probability from the text alone, the posteriors are those that the site's
    other documents give; keep is ``score >= threshold``.

    Nulls: a null or empty text has zero features; null hosts and paths are
    sites of their own; null doc_ids are scored but never labelled. Repeated
    rows are scored once each. Empty tables: no documents give no rows, no
    labels give a flat classifier (prior one half, everything kept). Extra
    columns are ignored.
    """
    narrow = _narrow(docs, host, path)
    m = Fitted(narrow, labels)
    out = m.scored(narrow.withColumn("p_text", m.p_text(F.col("f"))), F.col("host"), F.col("path"))
    return out.select("doc_id", "text_hash", "p_text", "host_posterior", "path_posterior", "score", (F.col("score") >= threshold).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents the classifier rejects; all columns pass through.

    Null, empty and repeated rows, null sites and empty tables are treated as
    in ``score_documents``: judged like any other row, so an empty table gives
    an empty one and without labels everything stays.

    Once fitted, a row is judged by its own text and its site, so the features
    are computed a second time beside the text instead of shuffling the texts
    to a table of decisions.
    """
    m = Fitted(_narrow(docs, host, path), labels)
    w = Wide(docs)
    rows = w.frame.withColumn("f", features(w.col("text"))).withColumn("p_text", m.p_text(F.col("f")))
    return w.restore(m.scored(rows, w.col(host).cast("string"), w.col(path).cast("string")).where(F.col("score") >= threshold))
