"""Text preparation (T01-T19) in long form.

Tokens become rows (``posexplode``) whenever they must meet a vocabulary or
be counted; per-row arrays stay arrays for pure transformations. Vocabulary
ids come from a distributed dense index, never a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import WORD, bind, c, char_ngrams, collapse_spaces, simple_tokens, word_ngrams, word_tokens
from tessera.functions.rows import attach_row
from tessera.functions.skew import dense_index, salted_left_join, salted_self_join
from tessera.session import cut_lineage

# Special token ids of the sequence models.
PAD, SOS, EOS, UNK = 0, 1, 2, 3
SPECIALS = ["<PAD>", "<SOS>", "<EOS>", "<UNK>"]


def tokenize_simple(col) -> Column:
    """Lower, space out ? . ! , , collapse spaces, split."""
    return simple_tokens(col)


def tokenize_dialogue(col) -> Column:
    """Lower, speaker tags <usr1>/<usr2> -> " usr1speaker "/" usr2speaker ", then words or single punctuation marks."""
    # fixed values: the speaker tags and the words they become
    s = F.lower(c(col))
    s = F.replace(F.replace(s, F.lit("<usr1>"), F.lit(" usr1speaker ")), F.lit("<usr2>"), F.lit(" usr2speaker "))
    return F.regexp_extract_all(s, F.lit(f"{WORD}+|[^\\p{{L}}\\p{{N}}_\\s]"), 0)


def clean_text(col) -> Column:
    """Null -> "", newlines -> space, collapse spaces, trim."""
    return collapse_spaces(F.regexp_replace(F.coalesce(c(col), F.lit("")), r"[\r\n]+", " "))


def token_rows(df: DataFrame, key: list[str], tokens: Column) -> DataFrame:
    """Explode a token array to ``(key..., pos, token)`` rows (pos 0-based)."""
    return df.select(*key, F.posexplode(tokens).alias("pos", "token"))


def build_vocab(tok_rows: DataFrame, min_freq: int = 2) -> DataFrame:
    """Tokens with frequency >= min_freq; ids after the 4 special ids, by frequency desc then token."""
    cnt = tok_rows.groupBy("token").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= min_freq)
    return dense_index(cnt, [F.desc("count"), F.asc("token")], "id").withColumn("id", F.col("id") + 4)


def encode_tokens(tok_rows: DataFrame, key: list[str], vocab: DataFrame, sos_eos: bool = True) -> DataFrame:
    """Token ids (unknown -> UNK) re-collected in position order, wrapped in SOS ... EOS."""
    v = vocab.select("token", F.col("id").alias("__id"))
    j = salted_left_join(tok_rows, v, "token", [*key, "pos"]).withColumn("__id", F.coalesce("__id", F.lit(UNK)).cast("long"))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("pos", "__id"))), lambda s: s["__id"])
    out = j.groupBy(*key).agg(ids.alias("ids"))
    if sos_eos:
        out = out.withColumn("ids", F.concat(F.array(F.lit(SOS).cast("long")), "ids", F.array(F.lit(EOS).cast("long"))))
    return out


def pad_ids(ids, n: int) -> Column:
    """Truncate to n, then right-pad with PAD to length n."""
    s = F.slice(c(ids), 1, n)
    return F.concat(s, F.array_repeat(F.lit(PAD).cast("long"), F.lit(n) - F.size(s)))


def shift_targets(ids, n: int) -> tuple[Column, Column]:
    """Decoder input = SOS + t[:n-2] ... and output = t[:n-2] + EOS, both padded to n-1.

    ``ids`` are raw token ids (no SOS/EOS).
    """
    t = F.slice(c(ids), 1, n - 2)
    inp = F.concat(F.array(F.lit(SOS).cast("long")), t)
    outp = F.concat(t, F.array(F.lit(EOS).cast("long")))
    return pad_ids(inp, n - 1), pad_ids(outp, n - 1)


def decode_ids(df: DataFrame, key: list[str], ids: str, vocab: DataFrame) -> DataFrame:
    """Ids -> words, stopping at the first EOS, dropping PAD and SOS; unknown ids -> <UNK>."""
    e = df.select(*key, F.posexplode(ids).alias("pos", "id"))
    first_eos = e.filter(F.col("id") == EOS).groupBy(*key).agg(F.min("pos").alias("__eos"))
    e = e.join(first_eos, key, "left").filter(F.col("__eos").isNull() | (F.col("pos") < F.col("__eos")))
    e = e.filter(~F.col("id").isin(PAD, SOS))
    v = vocab.select(F.col("id"), F.col("token"))
    j = e.join(v, "id", "left").withColumn("token", F.coalesce("token", F.lit("<UNK>")))
    words = F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda s: s["token"])
    return j.groupBy(*key).agg(F.array_join(words, " ").alias("text"))


def oov_report(tok_rows: DataFrame, vocab: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Unknown-token rate and the share of distinct tokens covered by the vocabulary."""
    # tokens are counted first, so that a hot one is a single row of the join and distinct tokens are rows
    c_ = tok_rows.groupBy(*(by or []), "token").agg(F.count(F.lit(1)).alias("__n"))
    j = c_.join(vocab.select("token", F.lit(True).alias("__in")), "token", "left")
    unknown = F.col("__in").isNull()
    return j.groupBy(*(by or [])).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_tokens"),
        (F.sum(F.when(unknown, F.col("__n")).otherwise(0)) / F.sum("__n")).alias("unk_rate"),
        (F.sum((~unknown).cast("long")) / F.count(F.lit(1))).alias("type_coverage"))


def ngram_rows(df: DataFrame, key: list[str], text: str, kind: str = "word", lo: int = 1, hi: int = 2,
               min_len: int = 2) -> DataFrame:
    """(key..., term) rows of word n-grams (tokens of >= min_len word chars) or
    character n-grams of the lower-cased, space-collapsed text (across word borders)."""
    # the token array / normalised string is materialised as a column first: an expression used
    # inside the n-gram lambda would otherwise be re-evaluated for every position
    if kind == "word":
        d = df.select(*key, word_tokens(text, min_len).alias("__src"))
        arrs = [word_ngrams("__src", n) for n in range(lo, hi + 1)]
    else:
        d = df.select(*key, collapse_spaces(F.lower(F.col(text))).alias("__src"))
        arrs = [char_ngrams("__src", n) for n in range(lo, hi + 1)]
    return d.select(*key, F.explode(F.concat(*arrs)).alias("term"))


def idf_table(tf: DataFrame, doc: str, min_df: int = 1, max_features: int | None = None) -> DataFrame:
    """Smoothed idf ln((1+N)/(1+df)) + 1 per term from a ``(doc, term, tf)`` table."""
    N = tf.select(doc).distinct().agg(F.count(F.lit(1)).alias("__N"))
    st = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("__tot")).filter(F.col("df") >= min_df)
    if max_features:
        st = st.orderBy(F.desc("__tot"), "term").limit(max_features)  # the vocabulary cap is the feature
    return attach_row(st, N).select("term", "df", (F.log((1 + F.col("__N")) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf(term_rows: DataFrame, doc: str, min_df: int = 1, max_features: int | None = None) -> DataFrame:
    """Raw tf x (ln((1+N)/(1+df)) + 1), rows L2-normalised; min_df filter; keep the
    ``max_features`` terms of highest total count (ties by term). Long output ``(doc, term, weight)``."""
    # the counts are read by the idf and the weights: terms are cut and counted once
    tf = cut_lineage(term_rows.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf")))
    return tfidf_from_tf(tf, doc, idf_table(tf, doc, min_df, max_features))


def tfidf_from_tf(tf: DataFrame, doc: str, idf: DataFrame) -> DataFrame:
    """T12 from a ``(doc, term, tf)`` table and an idf table: tf x idf, L2-normalised per document."""
    # a term's documents meet one idf row: the documents of a hot term are salted. The planner only knows the size of the
    # texts' file, not of the rows cut from it, and would broadcast them
    w = salted_self_join(tf, idf.select("term", "idf"), "term", doc, merge=True).withColumn("w", F.col("tf") * F.col("idf"))
    w = w.groupBy(doc).agg(F.collect_list(F.struct("term", "w")).alias("__t"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("__n"))
    return w.select(doc, "__n", F.explode("__t").alias("__x")).select(doc, F.col("__x.term").alias("term"), (F.col("__x.w") / F.col("__n")).alias("weight"))


def sessionize_on_change(df: DataFrame, part: str, order: str, key: str, out: str = "session") -> DataFrame:
    """A new session starts whenever ``key`` differs from the previous row (in ``order``,
    within ``part``); a key that comes back starts a new session. Session numbers count from 1.
    Ranks, the previous row and the running count are skew-safe (no window over a whole part)."""
    from tessera.functions.skew import previous_in_group, running_in_group
    r = running_in_group(df, part, [F.col(order)], out="__rk")
    p = previous_in_group(r, part, "__rk", [key], prefix="__prev_")
    chg = F.when(F.col(f"__prev_{key}").isNull() | (F.col(f"__prev_{key}") != F.col(key)), 1).otherwise(0)
    p = p.withColumn("__chg", chg).drop(f"__prev_{key}", "__rk")
    # session number = running count of changes, again without a window over the whole group
    return running_in_group(p, part, [F.col(order)], "__chg", out).drop("__chg")


def dialogue_examples(df: DataFrame, session: str, turn: str, speaker: str, text: str,
                      tags: dict[str, str]) -> DataFrame:
    """history = earlier non-empty turns of the session, each prefixed by its speaker tag,
    joined by a space; rows with an empty target and the first turn give no example."""
    tag = None
    for k, v in tags.items():
        tag = F.when(F.col(speaker) == k, F.lit(v)) if tag is None else tag.when(F.col(speaker) == k, F.lit(v))
    t = clean_text(text)
    d = df.withColumn("__t", t).withColumn("__h", F.when(F.col("__t") != "", F.concat_ws(" ", tag, F.col("__t"))))
    w = Window.partitionBy(session).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__hist", F.collect_list("__h").over(w))
    return (d.filter((F.col("__t") != "") & (F.size("__hist") > 0))
             .select(session, turn, F.array_join("__hist", " ").alias("history"), F.col("__t").alias("target")))


def attach_document(df: DataFrame, docs: DataFrame, on: list[str], text: str = "text",
                    out: str = "document") -> DataFrame:
    """Attach the grounding text by key; not found -> ""."""
    return df.join(docs.select(*on, F.col(text).alias(out)), on, "left").withColumn(
        out, F.coalesce(F.col(out), F.lit("")))


def chunk_words(df: DataFrame, key: str, text: str, size: int, overlap: int) -> DataFrame:
    """Fixed word windows of ``size`` with ``overlap`` over the whole text -> (key, chunk_id, chunk_text)."""
    toks = F.split(F.trim(F.col(text)), r"\s+")
    step = size - overlap
    d = df.select(key, F.when(F.trim(F.col(text)) == "", F.array().cast("array<string>")).otherwise(toks).alias("__w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("__w") - overlap - 1, F.lit(0)), F.lit(step))
    d = d.filter(F.size("__w") > 0).select(key, "__w", F.posexplode(starts).alias("chunk_id", "__s"))
    return d.select(key, "chunk_id", F.array_join(F.slice("__w", F.col("__s") + 1, F.lit(size)), " ").alias("chunk_text"))


def chunk_sentences(df: DataFrame, key: str, text: str) -> DataFrame:
    """T16 (sentence mode): split after . ! ? followed by space -> (key, chunk_id, chunk_text)."""
    one_line = F.trim(F.regexp_replace(F.col(text), r"\s+", " "))  # no newline left after this
    s = F.split(F.regexp_replace(one_line, r"([.!?]) ", "$1\n"), "\n")
    return df.select(key, F.posexplode(s).alias("chunk_id", "chunk_text")).filter(F.col("chunk_text") != "")


def chunk_paragraphs(df: DataFrame, key: str, text: str) -> DataFrame:
    """T16 (paragraph mode): split at blank lines -> (key, chunk_id, chunk_text), trimmed, empty paragraphs left out of the numbering."""
    p = F.filter(F.transform(F.split(F.col(text), r"\n[ \t\r]*\n"), lambda x: F.btrim(x, F.lit(" \t\r\n"))), lambda x: x != "")
    return df.select(key, F.posexplode(p).alias("chunk_id", "chunk_text"))


def mix_ratio(tok_rows: DataFrame, key: list[str], wordlist: DataFrame, bins: list[float]) -> DataFrame:
    """Share of a row's tokens found in a word list, and its bucket (index of the bin it reaches)."""
    j = tok_rows.join(wordlist.select("token", F.lit(1).alias("__in")), "token", "left")
    r = j.groupBy(*key).agg(F.avg(F.coalesce("__in", F.lit(0)).cast("double")).alias("mix_ratio"))
    arr = F.array(*[F.lit(b) for b in bins])
    return r.withColumn("bucket", F.size(F.filter(arr, lambda b: F.col("mix_ratio") >= b)).cast("long"))


def repetition_report(texts: DataFrame, key: list[str], tokens: str, n: int = 2) -> DataFrame:
    """Per row of ``(key, tokens array)`` distinct-1 and distinct-n ratios, the longest run of one repeated token, and
    whether it is empty. One pass over the rows' own arrays: nothing is exploded or shuffled.

    An empty row has null ratios and a run of 0; a row of fewer than n tokens has a null distinct-n.
    """
    def of(t):
        grams = F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - (n - 1)), lambda i: F.array_join(F.slice(t, i, n), " ")))
        # (length of the run that ends here, longest so far)
        run = F.aggregate(F.sequence(F.lit(1), F.size(t)), F.struct(F.lit(0).cast("long").alias("now"), F.lit(0).cast("long").alias("best")), lambda s, i: bind(
            F.when((i > 1) & (F.get(t, i - 1) == F.get(t, i - 2)), s["now"] + 1).otherwise(F.lit(1).cast("long")),
            lambda now: F.struct(now.alias("now"), F.greatest(now, s["best"]).alias("best"))))
        empty = F.size(t) == 0
        return F.struct(F.when(~empty, F.size(F.array_distinct(t)) / F.size(t)).alias("distinct_1"),
                        bind(grams, lambda g: F.when(g.isNotNull(), F.size(F.array_distinct(g)) / F.size(g))).alias(f"distinct_{n}"),
                        F.when(empty, F.lit(0).cast("long")).otherwise(run["best"]).alias("longest_run"), empty.alias("is_empty"))

    d = texts.select(*key, bind(F.coalesce(tokens, F.array().cast("array<string>")), of).alias("r"))
    return d.select(*key, "r.*")


def bag_of_words(tok_rows: DataFrame, key: list[str]) -> DataFrame:
    """Term counts per row -> (key..., token, count)."""
    return tok_rows.groupBy(*key, "token").agg(F.count(F.lit(1)).alias("count"))


def text_vectors(df: DataFrame, tokens: str, dim: int = 32, seed: int = 42, min_count: int = 2):
    """Corpus-trained word vectors (MLlib Word2Vec); a text's vector = mean of its word vectors."""
    from pyspark.ml.feature import Word2Vec
    w2v = Word2Vec(vectorSize=dim, minCount=min_count, seed=seed, inputCol=tokens, outputCol="vector")
    model = w2v.fit(df)
    return model.transform(df)
