"""Language identification by word-first backoff (operator 7).

Known words score by their log frequency in each language; an unseen word
falls back to its character n-grams, the longest order of which any n-gram is
known, down to single letters. The counts are tables, whole whatever their
size, and the words of the texts are joined to them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialise, pick

ORDERS = (4, 3, 2, 1)
SMOOTH = 0.1
#: Distinct (language, n-gram) counts a task holds before it hands them on, and texts of a batch it hands on.
FLUSH = 400_000
TEXTS = 256
#: How the words of the rows are written: a file's distinct words take more than the 1 MB at which Parquet gives up
#: its dictionary and writes every word out, which would take about as much disk as the texts.
WRITTEN = {"parquet.dictionary.page.size": str(16 << 20), "compression": "zstd"}
#: Most (feature, language) entries of the commonest features that are broadcast; texts meet the others by shuffle.
HOT = 200_000
#: Kind of an unseen word none of whose n-grams is known: it adds nothing.
UNKNOWN = 1 + max(ORDERS)
_WORD = regex.compile(r"\p{L}+")


def grams(word: str, order: int) -> list[str]:
    """Character n-grams of ``_word_`` (single letters without the border mark)."""
    if order == 1:
        return list(word)
    w = f"_{word}_"
    return [w[i:i + order] for i in range(len(w) - order + 1)]


def held_out(doc_id: Column) -> Column:
    """Whether crc32(doc_id as text) mod 4 is 2; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def best_of(total: np.ndarray, langs: list[str]) -> tuple[str, float]:
    """Language of the highest score, of equal ones (but for rounding) the first by code point, and its posterior."""
    top = total.max()
    best = int(np.argmax(total >= top - 1e-12 * (1 + abs(top))))
    return langs[best], float(1.0 / np.exp(total - total[best]).sum())


@dataclass
class Model:
    """All counts, as tables: of every learned word and n-gram ``by_lang``, what each language that has it adds to ``base``, and its ``total`` count.

    ``base`` (kind: 0 for words, else the order, by language) is the log score of a feature
    the language lacks, 0 for kind ``UNKNOWN``; it is all that goes through the driver.
    """

    words: DataFrame
    grams: DataFrame
    base: np.ndarray
    langs: list[str]


def counted(docs: DataFrame, teach: bool = True) -> DataFrame:
    """``row, doc_id, held_out, lang, words, counts``: the distinct words of each row; lang is null if the row doesn't teach."""
    d = pick(docs, "doc_id", "text", "lang") if teach else pick(docs, "doc_id", "text").withColumn("lang", F.lit(None).cast("string"))
    d = d.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out(F.col("doc_id")).alias("held_out"),
                 F.when(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull(), F.col("lang")).alias("lang"), "text")
    keep = d.columns[:-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                b = whole.slice(at, TEXTS)
                c = [Counter(_WORD.findall(t.lower())) if t else {} for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array([list(x) for x in c], pa.list_(pa.string())),
                                                  pa.array([list(x.values()) for x in c], pa.list_(pa.int64()))], names=[*keep, "words", "counts"])

    schema = T.StructType([*d.schema.fields[:-1], T.StructField("words", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    return materialise(d.mapInArrow(count, schema), WRITTEN)


def _uses(c: DataFrame, *cols: str) -> DataFrame:
    return c.select(*cols, F.inline(F.arrays_zip("words", "counts"))).withColumnsRenamed({"words": "word", "counts": "n"})


def _count_grams(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts of the n-grams of a task's words, weighted by the word's count."""
    def flush(c):
        return pd.DataFrame([(*k, n) for k, n in c.items()], columns=["lang", "kind", "feature", "n"])

    c = Counter()
    for pdf in parts:
        for lang, word, n in zip(pdf["lang"], pdf["word"], pdf["n"]):
            for order in ORDERS:
                for g in grams(word, order):
                    c[lang, order, g] += n
            if len(c) > FLUSH:
                yield flush(c)
                c.clear()
    if c:
        yield flush(c)


def _fit(c: DataFrame) -> Model:
    spark = c.sparkSession
    words = materialise(_uses(c.where("lang is not null"), "lang").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    count = materialise(words.mapInPandas(_count_grams, "lang string, kind int, feature string, n long")
                        .groupBy("lang", "kind", "feature").agg(F.sum("n").alias("n")))
    sums = [(0, r["lang"], r["n"]) for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()]
    langs = sorted(x for _, x, _ in sums)
    sums += [(r["kind"], r["lang"], r["n"]) for r in count.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()]
    place = F.broadcast(spark.createDataFrame(list(enumerate(langs)), "l int, lang string"))  # one row per language

    def by_lang(d: DataFrame, *key: str) -> DataFrame:
        gain = F.log((F.col("n") + SMOOTH) / SMOOTH)
        return materialise(d.join(place, "lang").groupBy(*key).agg(F.collect_list(F.struct("l", gain.alias("b"))).alias("by_lang"), F.sum("n").alias("total")))

    words, kinds = by_lang(words, "word"), by_lang(count, "kind", "feature")
    size = {0: words.count()} | {r["kind"]: r["count"] for r in kinds.groupBy("kind").count().collect()}
    total, at = np.zeros((1 + max(ORDERS), len(langs))), {x: i for i, x in enumerate(langs)}
    for kind, lang, n in sums:
        total[kind, at[lang]] = n
    base = np.log(SMOOTH / (total + SMOOTH * (np.array([[size.get(k, 0)] for k in range(len(total))]) + 1)))
    return Model(words, kinds, np.vstack([base, np.zeros(len(langs))]), langs)


def fit(docs: DataFrame) -> Model:
    """Learn from the text and non-null lang of all documents of ``docs`` that are not held out: every word, n-gram and language."""
    return _fit(counted(docs))


def _commonest(table: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows of the commonest features, of ``HOT`` entries at most, and the others; None if there are no such rows."""
    bucket = F.floor(4 * F.log2("total"))
    sizes = sorted(table.groupBy(bucket.alias("at")).agg(F.sum(F.size("by_lang")).alias("n")).collect(), reverse=True)
    fit = 0
    while fit < len(sizes) and sum(r["n"] for r in sizes[:fit + 1]) <= HOT:
        fit += 1
    if not fit:
        return None, table.drop("total")
    return (table.where(bucket >= sizes[fit - 1]["at"]).drop("total"),
            None if fit == len(sizes) else table.where(bucket < sizes[fit - 1]["at"]).drop("total"))


def _meet(left: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``left`` joined to the whole ``table``: its commonest keys are broadcast, the rows of ``left`` with others are joined by shuffle."""
    hot, cold = _commonest(table)
    if hot is None:
        return left.join(cold.hint("shuffle_hash"), key)
    out = left.join(F.broadcast(hot), key)
    if cold is None:
        return out
    return out.unionByName(left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold.hint("shuffle_hash"), key))


def _unseen(c: DataFrame, model: Model) -> list[DataFrame]:
    """``word, kind, by_lang, total`` of the words the model lacks, by the longest order of which it has an n-gram (the mean over those it has)."""
    # a row that teaches has no word the model lacks; the commonest words, which most tasks have, leave before the shuffle
    hot, cold = _commonest(model.words)
    rest = _uses(c.where("lang is null")).select("word")
    if hot is not None:
        rest = rest.join(F.broadcast(hot.select("word")), "word", "left_anti")
    rest = rest.distinct()
    rest = materialise(rest if cold is None else rest.join(cold.select("word"), "word", "left_anti"))
    out = []
    for order in ORDERS:
        if rest.isEmpty():
            break

        def cut(parts: Iterator[pd.DataFrame], order: int = order) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                yield pd.DataFrame([(w, g) for w in pdf["word"] for g in grams(w, order)], columns=["word", "feature"])

        known = model.grams.where(F.col("kind") == order).select("feature", "by_lang", "total")
        # language -1 counts the n-grams
        each = (_meet(rest.mapInPandas(cut, "word string, feature string"), known, "feature")
                .select("word", F.inline(F.concat(F.array(F.struct(F.lit(-1).alias("l"), F.lit(1.0).alias("b"))), "by_lang")))
                .groupBy("word", "l").agg(F.sum("b").alias("b")))
        found = each.groupBy("word").agg(F.sum(F.when(F.col("l") < 0, F.col("b"))).alias("m"), F.collect_list(F.when(F.col("l") >= 0, F.struct("l", "b"))).alias("g"))
        found = materialise(found.select("word", F.lit(order).alias("kind"), F.transform("g", lambda x: F.struct(
            x["l"].alias("l"), (x["b"] / F.col("m")).alias("b"))).alias("by_lang"), F.lit(1).cast("long").alias("total")))
        out.append(found)
        rest = materialise(rest.join(found, "word", "left_anti"))
    none = F.array().cast("array<struct<l:int,b:double>>")
    return [*out, rest.select("word", F.lit(UNKNOWN).alias("kind"), none.alias("by_lang"), F.lit(1).cast("long").alias("total"))]


def _predict(c: DataFrame, model: Model) -> DataFrame:
    langs, base = model.langs, model.base
    scores = reduce(DataFrame.unionByName, [model.words.withColumn("kind", F.lit(0)), *_unseen(c, model)])
    # language -1 - kind counts the text's words of that kind; those of kind 0 are all the others and need no entries
    kind = F.array(F.struct((-1 - F.col("kind")).alias("l"), F.lit(1.0).alias("b")))
    each = (_meet(_uses(c, "row"), scores, "word")
            .select("row", "n", F.inline(F.when(F.col("kind") > 0, F.concat(kind, "by_lang")).otherwise(F.col("by_lang")))))
    total = each.groupBy("row", "l").agg(F.sum(F.col("n") * F.col("b")).alias("s")).groupBy("row").agg(F.collect_list(F.struct("l", "s")).alias("t"))

    @F.pandas_udf("lang_pred string, score double")
    def score(words: pd.Series, l: pd.Series, s: pd.Series) -> pd.DataFrame:  # noqa: E741
        out = []
        for n, at, x in zip(words, l, s):
            if not n or not langs:
                out.append(("und", 0.0))
                continue
            total = np.zeros(len(langs))
            for i, v in zip(at, x) if at is not None else ():
                if i < 0:
                    total += v * base[-1 - i]
                    n -= v
                else:
                    total[i] += v
            out.append(best_of(total + n * base[0], langs))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    n = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    d = c.select("row", "doc_id", "held_out", n.alias("n")).join(total, "row", "left")
    return d.select("doc_id", "held_out", score("n", F.col("t.l"), F.col("t.s")).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, from its whole text alone.

    ``und`` with score 0 if the text is null or has no letter (or nothing was
    learned); else the language with the highest sum of word scores and its
    posterior. Ties go to the first language by code point. Null doc_ids
    count as not held out (and teach nothing); repeated rows come out once
    each; an empty table gives an empty result; extra columns are ignored.
    """
    return _predict(counted(docs, teach=False), model)


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the documents that aren't held out, predict all (see ``fit`` and ``predict``); every text is cut into words once."""
    c = counted(docs)
    return _predict(c, _fit(c))
