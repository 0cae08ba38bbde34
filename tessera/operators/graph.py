"""Graph retrieval, grounding and extractive summaries (G01-G15), rule-based and join-driven.

Entities are rule-matched spans; the graph is an edge table; communities come
from synchronous weighted label propagation (a join + group-by per round);
retrieval is an inverted-index join on terms or entities. Pair emission is
bounded by construction: co-occurrence pairs live inside fixed-size chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import bind, word_tokens
from tessera.functions.rows import attach_row
from tessera.functions.skew import dense_index, meet, salted_left_join, salted_self_join, top_k_per_key
from tessera.session import cut_lineage, store

# Fixed value: a capitalised word, optionally followed by more capitalised words.
ENTITY_PATTERN = r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*"
# Capitalised function words that start sentences and are not entities.
ENTITY_STOPWORDS = ["The", "A", "An", "It", "In", "Of", "And", "To", "That", "This", "Le", "La", "Les", "Un", "Une",
                    "De", "Des", "Et", "Der", "Die", "Das", "Und", "Ein", "Eine", "El", "Los", "Las", "Y", "En", "Que"]
# Negation markers used by the claim rules.
NEGATIONS = ["not", "no", "never", "ne", "pas", "jamais", "nicht", "kein", "keine", "nunca"]
#: Queries that walk the graph at once: a bit each in the masks of entities.
QUERIES_AT_ONCE = 256
#: Rows of a table that is broadcast at most.
SMALL = 100_000
#: Masks that a task spreads into bits at a time.
MARKS = 50_000


def extract_entities(chunks: DataFrame, key: list[str], text: str, stop: DataFrame) -> DataFrame:
    """Distinct entity mentions per chunk by the capitalised-span rule, stop words removed."""
    m = chunks.select(*key, F.explode(F.regexp_extract_all(F.col(text), F.lit(ENTITY_PATTERN), 0)).alias("entity"))
    return m.distinct().join(stop.select(F.col("word").alias("entity")), "entity", "left_anti")


def build_edges(mentions: DataFrame, chunk_key: list[str]) -> DataFrame:
    """Co-occurrence edges a < b inside a chunk; weight = number of chunks with both.

    A chunk is a fixed-size window, so the pairs per chunk are bounded by the
    window size, not by the data.
    """
    a = mentions.select(*chunk_key, F.col("entity").alias("a"))
    b = mentions.select(*chunk_key, F.col("entity").alias("b"))
    return a.join(b, chunk_key).filter(F.col("a") < F.col("b")).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("weight"))


def communities(edges: DataFrame, rounds: int = 3, checkpoint_every: int = 2) -> DataFrame:
    """Synchronous label propagation: each node takes the label of largest total edge weight
    among its neighbours (ties: smallest label), for a fixed number of rounds."""
    und = cut_lineage(edges.select("a", "b", "weight").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")))
    lab = und.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    for r in range(1, rounds + 1):
        # a hub's edges are salted on the way to its label; its votes are summed map-side first
        votes = (salted_self_join(und, lab.select(F.col("node").alias("b"), "label"), "b", "a")
                 .groupBy(F.col("a").alias("node"), "label").agg(F.sum("weight").alias("score")))
        lab = top_k_per_key(votes, "node", [F.desc("score"), F.col("label")], 1, salt_cols=["label"]).select(
            "node", "label")
        if r % checkpoint_every == 0:
            lab = cut_lineage(lab)
    return lab


def summarise_communities(labels: DataFrame, edges: DataFrame, top: int = 3) -> DataFrame:
    """Per community: size and its top entities by weighted degree (ties by name)."""
    deg = (edges.select(F.col("a").alias("node"), "weight").unionByName(edges.select(F.col("b").alias("node"), "weight"))
                .groupBy("node").agg(F.sum("weight").alias("degree")))
    d = labels.join(deg, "node")
    size = d.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    t = top_k_per_key(d, "label", [F.desc("degree"), F.col("node")], top, salt_cols=["node"])
    names = t.groupBy("label").agg(F.array_sort(F.collect_list(F.struct((-F.col("degree")).alias("k"), F.col("node").alias("n")))).alias("__s"))
    return size.join(names.select("label", F.array_join(F.transform("__s", lambda s: s["n"]), ", ").alias("top_entities")), "label")


def community_terms(labels: DataFrame, chunks: DataFrame, mentions: DataFrame, chunk_key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(TF-IDF vectors ``(label, term, weight, tf)`` with each community as one document, its chunks ``(label, chunk_text)``).

    A community's text is every chunk that mentions one of its entities, once.
    """
    own = mentions.join(labels.select(F.col("node").alias("entity"), "label"), "entity").select("label", *chunk_key).distinct()
    own = store(own.join(chunks, chunk_key).select("label", "chunk_text"))[0]
    from tessera.operators.text import idf_table
    tf = store(own.select("label", F.explode(word_tokens("chunk_text", 2)).alias("term")).groupBy("label", "term").agg(F.count(F.lit(1)).alias("tf")))[0]
    # a community may hold most of the terms: they are never gathered in a row
    w = meet(tf, cut_lineage(idf_table(tf, "label")), "term", "df").withColumn("w", F.col("tf") * F.col("idf"))
    norm = w.groupBy("label").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("__n"))
    return salted_left_join(w, norm, "label", ["term"]).select("label", "term", (F.col("w") / F.col("__n")).alias("weight"), "tf"), own


def community_digest(vectors: DataFrame, chunks: DataFrame, terms: int = 5, sentences: int = 2) -> DataFrame:
    """``(label, top_terms, best_sentences)`` of each community, lists in order.

    A sentence scores the sum of its distinct terms' weights in the
    community's vector over the root of their number (its cosine to the
    centroid but for the community's constant); ties go by text.
    """
    listed = lambda d, v, name: d.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("rank", v))).alias("__l")).select(
        "label", F.transform("__l", lambda x: x[v]).alias(name))
    t = top_k_per_key(vectors.select("label", "term", "weight"), "label", [F.desc(F.round("weight", 9)), F.col("term")], terms, rank_col="rank", salt_cols=["term"])
    # a sentence's words travel with its number, not with its text
    s = store(split_sentences(chunks, ["label"], "chunk_text").select("label", "sentence").distinct().withColumn("__s", F.monotonically_increasing_id()))[0]
    w = meet(s.select("label", "__s", F.explode(F.array_distinct(word_tokens("sentence", 2))).alias("term")), vectors.select("label", "term", "weight", "tf"), ["label", "term"], "tf")
    sc = w.groupBy("__s").agg((F.sum("weight") / F.sqrt(F.count(F.lit(1)))).alias("score")).join(s, "__s").drop("__s")
    best = top_k_per_key(sc, "label", [F.desc(F.round("score", 9)), F.col("sentence")], sentences, rank_col="rank", salt_cols=["sentence"])
    return listed(t, "term", "top_terms").join(listed(best, "sentence", "best_sentences"), "label", "left")


def _marked(asked: DataFrame, words: int) -> DataFrame:
    """``(entity, m0, m1, ..)`` of ``(entity, __bit)`` rows: the bits of the queries that hold the entity, 64 to a column."""
    bit = F.expr("shiftleft(1L, CAST(__bit % 64 AS INT))")
    return asked.groupBy("entity").agg(*[F.bit_or(F.when(F.floor(F.col("__bit") / 64) == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"m{i}") for i in range(words)])


def _step(edges: DataFrame, frontier: DataFrame, seen: DataFrame, words: int) -> DataFrame:
    """Entities one edge away from the frontier with the marks that ``seen`` does not have of them yet."""
    und = edges.select(F.col("a").alias("entity"), F.col("b").alias("near")).unionByName(edges.select(F.col("b").alias("entity"), F.col("a").alias("near")))
    marks = [f"m{i}" for i in range(words)]
    met = und.join(F.broadcast(frontier), "entity") if frontier.count() <= SMALL else salted_self_join(und, frontier, "entity", "near", merge=True)
    met = met.groupBy(F.col("near").alias("entity")).agg(*[F.bit_or(x).alias(x) for x in marks])
    old = seen.groupBy("entity").agg(*[F.bit_or(x).alias(f"__{x}") for x in marks])
    new = met.join(old, "entity", "left").select("entity", *[F.col(x).bitwiseAND(F.bitwise_not(F.coalesce(f"__{x}", F.lit(0).cast("long")))).alias(x) for x in marks])
    return cut_lineage(new.filter(" OR ".join(f"{x} <> 0" for x in marks)))


def _marks_to_scores(weights: list[float], words: int, k: int | None):
    """Rows ``(doc, marks, wanted)`` -> ``(__i, doc, score)``: of each batch the k best documents of each query (all, if None) and the wanted ones."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t.take(pc.sort_indices(t.column("doc"), null_placement="at_start")).combine_chunks()  # ties go by document
            if not t.num_rows:
                continue
            marks, size = t.column("marks").combine_chunks(), pc.list_value_length(t.column("marks")).to_numpy()
            vals, end = marks.flatten(), np.cumsum(size)
            hop = vals.field("h").to_numpy()
            m = np.stack([vals.field(f"m{i}").to_numpy() for i in range(words)], axis=1)
            total, at = np.zeros((t.num_rows, 64 * words)), 0
            while at < t.num_rows:  # documents of about MARKS marks at a time
                upto = max(at + 1, int(np.searchsorted(end, (end[at - 1] if at else 0) + MARKS, "right")))
                span = slice(end[at] - size[at], end[upto - 1])
                doc = np.repeat(np.arange(at, upto), size[at:upto])
                bits = np.unpackbits(np.ascontiguousarray(m[span], dtype="<i8").view(np.uint8), axis=1, bitorder="little")
                for h, w in enumerate(weights):
                    ok = hop[span] == h
                    if ok.any():
                        of = doc[ok]
                        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                        total[of[first]] += w * np.add.reduceat(bits[ok], first, axis=0, dtype=np.int32)
                at = upto
            if k is None:
                pick = np.flatnonzero(total)
            else:
                best = np.argsort(-total, axis=0, kind="stable")[:k]
                pick = (best * total.shape[1] + np.arange(total.shape[1])).ravel()
                wanted = t.column("wanted").combine_chunks()
                rows = np.repeat(np.arange(t.num_rows), pc.fill_null(pc.list_value_length(wanted), 0).to_numpy())
                pick = np.unique(np.r_[pick, rows * total.shape[1] + wanted.flatten().to_numpy()]).astype(int)
                pick = pick[total.ravel()[pick] > 0]
            row, i = np.divmod(pick, total.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), t.column("doc").combine_chunks().take(pa.array(row)), pa.array(total[row, i])], names=["__i", "doc", "score"])
    return fn


def graph_retrieve(q_entities: DataFrame, edges: DataFrame, doc_mentions: DataFrame, k: int | None,
                   query: str = "query", doc: str = "doc_id", hops: int = 1, decay: float = 0.5, among: DataFrame | None = None) -> DataFrame:
    """Documents ranked by the summed weight of the distinct entities they mention near the query's.

    A query's own entities weigh 2, those first reached after h steps
    2 * decay^h. All queries walk at once, as bits of a mask per entity (in
    blocks of ``QUERIES_AT_ONCE``): each hop joins the frontier with the edges,
    ORs the masks of a node's neighbours and drops what was visited. A document
    meets the masks of its entities, never a (query, entity) or (query,
    document) row; edges and mentions of a hot entity are salted. Top k per
    query (``k=None``: every scored document). With ``among``, ``(query, doc)``
    pairs, the result is unranked and holds at least each query's k best
    documents and the scored pairs of ``among``.
    """
    q = cut_lineage(q_entities.select(query, "entity").distinct())
    names = dense_index(q.select(query).distinct(), [F.col(query)], "__i")
    e, mentioned = cut_lineage(edges.select("a", "b")), doc_mentions.select(doc, "entity").distinct()
    n = names.count()
    if n > QUERIES_AT_ONCE:
        mentioned = cut_lineage(mentioned)
    of = q.join(names.withColumnRenamed(query, "__q"), F.col(query).eqNullSafe(F.col("__q"))).select("entity", "__i")
    types = dict(doc_mentions.dtypes)
    schema, out = f"__i long, doc {types[doc]}, score double", None
    for at in range(0, max(n, 1), QUERIES_AT_ONCE):
        words = max(1, -(-min(QUERIES_AT_ONCE, n - at) // 64))
        here = F.col("__i").between(at, at + QUERIES_AT_ONCE - 1)
        frontier = cut_lineage(_marked(of.filter(here).select("entity", (F.col("__i") - at).alias("__bit")), words))
        reached = frontier.withColumn("h", F.lit(0))
        for h in range(1, hops + 1):
            frontier = _step(e, frontier, reached.drop("h"), words)
            reached = reached.unionByName(frontier.withColumn("h", F.lit(h)))
        docs = (salted_self_join(mentioned, reached, "entity", doc, merge=True).groupBy(F.col(doc).alias("doc"))
                .agg(F.collect_list(F.struct("h", *[f"m{i}" for i in range(words)])).alias("marks")))
        if among is not None:
            asked = among.select(query, F.col(doc).alias("doc")).join(names.filter(here), query).groupBy("doc").agg(F.collect_set(F.col("__i") - at).alias("wanted"))
            docs = docs.join(asked, "doc", "left")
        else:
            docs = docs.withColumn("wanted", F.lit(None).cast("array<long>"))
        part = docs.select("doc", "marks", "wanted").mapInArrow(_marks_to_scores([2.0 * decay ** h for h in range(hops + 1)], words, k), schema).withColumn("__i", F.col("__i") + at)
        out = part if out is None else out.unionByName(part)
    if k is None or among is not None:
        return out.join(names, "__i").select(query, F.col("doc").alias(doc), "score")
    top = top_k_per_key(out, "__i", [F.desc("score"), F.col("doc")], k, rank_col="rank", salt_cols=["doc"])
    return top.join(names, "__i").select(query, F.col("doc").alias(doc), "score", "rank")


def shingles(df: DataFrame, key: list[str], text: str, n: int) -> DataFrame:
    """Whitespace-token n-word shingles -> (key..., shingle)."""
    w = F.split(F.trim(F.regexp_replace(F.col(text), r"\s+", " ")), " ")
    d = df.select(*key, w.alias("__w")).filter(F.size("__w") >= n)
    return d.select(*key, F.explode(F.transform(F.sequence(F.lit(1), F.size("__w") - n + 1),
                                                lambda i: F.array_join(F.slice("__w", i, n), " "))).alias("shingle"))


def containment_truth(passages: DataFrame, pid: str, ptext: str, docs: DataFrame, doc: str, dtext: str,
                      n: int = 8) -> DataFrame:
    """(passage, doc) pairs where the doc contains the whole passage (white space collapsed).

    A passage may begin or end inside a document's word, but the words between
    its first and last are whole words of the document: their first n (or
    all, if fewer) form a shingle that is joined with the document shingles of
    that length; an exact containment check follows. Passages without an
    inner word are joined on the end of a document's word and the start of the
    next (two words) or on a stretch of a word (one), in their own lengths.
    """
    norm = lambda x: F.regexp_replace(F.col(x), r"\s+", " ")
    p = passages.select(pid, norm(ptext).alias("__p")).filter(F.trim("__p") != "")
    p = cut_lineage(p.withColumn("__w", F.split(F.trim("__p"), " ")).withColumn(
        "__n", F.greatest(F.lit(0), F.least(F.lit(n), F.size("__w") - 2))))
    parts = []
    for r in p.groupBy("__n").count().collect():  # at most n + 1 lengths
        some = p.filter(F.col("__n") == r["__n"])
        if r["__n"]:
            # by hash: the check that follows drops what merely collides
            inner = some.select(pid, F.xxhash64(F.array_join(F.slice("__w", 2, r["__n"]), " ")).alias("__h"))
            held = shingles(docs, [doc], dtext, r["__n"]).select(doc, F.xxhash64("shingle").alias("__h"))
            parts.append(held.join(F.broadcast(inner) if r["count"] <= SMALL else inner.hint("merge"), "__h").select(pid, doc).distinct())
        else:
            parts.append(_short_passages(some, pid, docs, doc, norm(dtext)))
    if not parts:
        return passages.select(pid).join(docs.select(doc), F.lit(False))
    cand = parts[0]
    for x in parts[1:]:
        cand = cand.unionByName(x)
    return (cand.distinct().join(p.select(pid, "__p"), pid).join(docs.select(doc, norm(dtext).alias("__d")), doc)
                .filter(F.expr("instr(__d, __p) > 0")).select(pid, doc))


def _short_passages(short: DataFrame, pid: str, docs: DataFrame, doc: str, text: Column) -> DataFrame:
    """(pid, doc) candidates for passages of one or two words: equi-joins on pieces of the asked lengths."""
    words = docs.select(doc, F.split(F.trim(text), " ").alias("__w"))
    q = cut_lineage(short.select(pid, F.get("__w", F.lit(0)).alias("a"), F.get("__w", F.lit(1)).alias("b")))
    lengths = [(r["x"], r["y"]) for r in q.select(F.length("a").alias("x"), F.length("b").alias("y")).distinct().collect()]  # few: lengths of words
    one, two = sorted({x for x, y in lengths if y is None}), sorted((x, y) for x, y in lengths if y is not None)
    out = q.select(pid).join(docs.select(doc), F.lit(False))
    if one:
        w = words.select(doc, F.explode(F.array_distinct("__w")).alias("w")).select(doc, "w", F.explode(F.array(*[F.lit(n) for n in one])).alias("n"))
        piece = w.filter(F.length("w") >= F.col("n")).select(doc, F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - F.col("n") + 1), lambda i: F.substring("w", i, F.col("n")))).alias("a"))
        out = out.unionByName(q.filter("b is null").join(piece, "a").select(pid, doc))
    if two:
        pair = words.filter(F.size("__w") > 1).select(doc, F.explode(F.transform(F.sequence(F.lit(1), F.size("__w") - 1), lambda i: F.struct(
            F.get("__w", i - 1).alias("l"), F.get("__w", i).alias("r")))).alias("x")).select(doc, "x.l", "x.r").distinct()
        pair = pair.select(doc, "l", "r", F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.lit(n).alias("n")) for m, n in two])).alias("z"))
        pair = pair.select(doc, F.right("l", F.col("z.m")).alias("a"), F.left("r", F.col("z.n")).alias("b"))
        out = out.unionByName(q.join(pair, ["a", "b"]).select(pid, doc))
    return out.distinct()


def split_sentences(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """Sentences (after . ! ? followed by a space) with their 0-based position -> (key..., sent_id, sentence)."""
    one = F.trim(F.regexp_replace(F.col(text), r"\s+", " "))
    s = F.split(F.regexp_replace(one, r"([.!?]) ", "$1\n"), "\n")
    return df.select(*key, F.posexplode(s).alias("sent_id", "sentence")).filter(F.col("sentence") != "")


def answer_passages(top: DataFrame, queries: DataFrame, query: str, floor: float, score: str = "score") -> DataFrame:
    """Keep retrieved passages with score >= floor; every query of ``queries`` left with none gets one 'none' row."""
    kept = top.filter(F.col(score) >= floor)
    qs = queries.select(query).distinct().join(kept.select(query).distinct(), query, "left_anti")
    return kept.withColumn("status", F.lit("answer")).unionByName(
        qs.withColumn("status", F.lit("none")), allowMissingColumns=True)


def claim_verdicts(claims: DataFrame, evidence: DataFrame, key: str, claim: str, ev_text: str,
                   min_overlap: float = 0.6) -> DataFrame:
    """Corroborated / contradicted / unverifiable from term overlap plus number and negation rules.

    overlap = share of the claim's distinct word tokens present in the evidence;
    a number mismatch = the sorted digit strings differ; a negation mismatch =
    one side has a negation word and the other not.
    """
    neg = F.array(*[F.lit(w) for w in NEGATIONS])
    j = claims.join(evidence, key, "left")
    ct, et = word_tokens(claim), F.coalesce(word_tokens(ev_text), F.array().cast("array<string>"))
    cs = F.array_distinct(ct)
    ov = F.when(F.size(cs) == 0, 0.0).otherwise(F.size(F.array_intersect(cs, et)) / F.size(cs))
    nums = lambda x: F.array_sort(F.regexp_extract_all(F.coalesce(F.col(x), F.lit("")), F.lit(r"\d+"), 0))
    nmis = F.array_join(nums(claim), ",") != F.array_join(nums(ev_text), ",")
    gmis = (F.size(F.array_intersect(ct, neg)) > 0) != (F.size(F.array_intersect(et, neg)) > 0)
    verdict = (F.when(F.col(ev_text).isNull() | (F.col("overlap") < min_overlap), F.lit("unverifiable"))
                .when(F.col("__nm") | F.col("__gm"), F.lit("contradicted")).otherwise(F.lit("corroborated")))
    return (j.withColumn("overlap", ov).withColumn("__nm", nmis).withColumn("__gm", gmis)
             .withColumn("verdict", verdict).drop("__nm", "__gm"))


def sentence_scores(sents: DataFrame, key: str) -> DataFrame:
    """``(key, sent_id, score)``: mean TF-IDF weight of a sentence's word tokens, the sentences of a key being one document.

    The sentences are shuffled once, by key; a term's rows meet its idf where they are unless the term is rare, and
    sums per sentence are all that travels after that: of n x tf x idf for the score, of n x tf x idf^2, which over a
    document is its squared norm. A null key gives no row.
    """
    t = sents.select(key, "sent_id", "sentence").repartition(key).select(key, "sent_id", F.explode(word_tokens("sentence", 2)).alias("term"))
    here = Window.partitionBy(key, "term")
    t = t.groupBy(key, "sent_id", "term").agg(F.count(F.lit(1)).alias("n"))
    t = store(t.withColumns({"tf": F.sum("n").over(here), "first": (F.col("sent_id") == F.min("sent_id").over(here)).cast("int")}))[0]
    df = t.groupBy("term").agg(F.sum("first").alias("df"))
    size = t.select(key).distinct().agg(F.count(F.lit(1)).alias("__N"))
    idf = cut_lineage(attach_row(df, size).select("term", "df", (F.log((1 + F.col("__N")) / (1 + F.col("df"))) + 1).alias("idf")))
    w = meet(t.filter(F.col(key).isNotNull()).select(key, "sent_id", "term", "n", "tf"), idf, "term", "df")
    each = w.groupBy(key, "sent_id").agg(F.sum(F.col("n") * F.col("tf") * F.col("idf")).alias("__a"), F.sum(F.col("n") * F.col("tf") * F.col("idf") * F.col("idf")).alias("__b"), F.sum("n").alias("__m"))
    norm = F.sqrt(F.sum("__b").over(Window.partitionBy(key)))
    return each.select(key, "sent_id", (F.col("__a") / norm / F.col("__m")).alias("score"))


def summarise(sents: DataFrame, scores: DataFrame, key: list[str], n: int) -> DataFrame:
    """The n best sentences (score desc, earlier first on ties), emitted in text order."""
    s = sents.join(scores, [*key, "sent_id"])
    top = top_k_per_key(s, key, [F.desc(F.round("score", 9)), F.col("sent_id")], n, salt_cols=["sent_id"])
    return top.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sent_id", "sentence"))),
                                                          lambda x: x["sentence"]), " ").alias("summary"))


def drop_redundant(cands: DataFrame, key: str, n: int, limit: float = 0.7) -> DataFrame:
    """Greedy choice of n sentences per document from ``(key, sent_id, sentence, score)``, best first (earlier on ties);
    a sentence whose word set has a cosine of ``limit`` or more with a chosen one is passed over.

    n rounds, each a top-1 per document and an equi-join with its choice; a document's candidates never meet in pairs.
    """
    left = cut_lineage(cands.withColumn("__t", F.array_distinct(word_tokens("sentence", 2))))
    chosen = None
    for _ in range(n):
        best = cut_lineage(top_k_per_key(left, key, [F.desc(F.round("score", 9)), F.col("sent_id")], 1, salt_cols=["sent_id"]))
        chosen = best if chosen is None else chosen.unionByName(best)
        b = best.select(key, F.col("sent_id").alias("__s"), F.col("__t").alias("__b"))
        cosine = F.try_divide(F.size(F.array_intersect("__t", "__b")).cast("double"), F.sqrt(F.size("__t") * F.size("__b")))
        left = cut_lineage(left.join(b, key).filter((F.col("sent_id") != F.col("__s")) & ~F.coalesce(cosine >= limit - 1e-9, F.lit(False))).drop("__s", "__b"))
    return chosen.drop("__t")


def best_support(summary: DataFrame, source: DataFrame, key: str, floor: float = 0.5) -> DataFrame:
    """For every summary sentence ``(key, sent_id, words)`` the source sentence of the same document that holds the
    largest share of its distinct word pairs (the first on ties): ``(key, sent_id, passage, share, supported)``.

    Postings of word pairs inside a document are joined, so only sentences that share a pair meet; a sentence
    without a match (or without two words) has passage -1 and share 0.
    """
    pairs = lambda d: d.select(key, "sent_id", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.concat_ws(" ", F.get("words", i - 1), F.get("words", i))))).alias("pair")) if d is not None else None
    h, p = cut_lineage(pairs(summary.filter(F.size("words") > 1))), pairs(source.filter(F.size("words") > 1)).withColumnRenamed("sent_id", "passage")
    met = h.join(p, [key, "pair"]).groupBy(key, "sent_id", "passage").agg(F.count(F.lit(1)).alias("m"))
    best = top_k_per_key(met, [key, "sent_id"], [F.desc("m"), F.col("passage")], 1, salt_cols=["passage"])
    size = h.groupBy(key, "sent_id").agg(F.count(F.lit(1)).alias("n"))
    out = summary.select(key, "sent_id").join(size, [key, "sent_id"], "left").join(best, [key, "sent_id"], "left")
    share = F.coalesce(F.col("m") / F.col("n"), F.lit(0.0))
    return out.select(key, "sent_id", F.coalesce("passage", F.lit(-1)).alias("passage"), share.alias("share"), (share >= floor).alias("supported"))


def _supported(copies: list) -> tuple[int, int]:
    """(sentences, supported ones) of the texts of one key, each ``(source words, summary words, whether a word ends a sentence)``.

    The words of several texts are numbered together by position, as rows of one group.
    """
    known = {(a, b) for src, _, _ in copies for a, b in zip(src, src[1:])}
    ended, before, pairs = 0, [], {}
    for at in range(max(len(hyp) for _, hyp, _ in copies)):
        here = []
        for _, hyp, ends in copies:
            if at < len(hyp):
                here.append((hyp[at], ended))
                ended += bool(ends[at])
        for w, sent in before:
            for w2, sent2 in here:
                if sent == sent2:
                    n = pairs.setdefault(sent, [0, 0])
                    n[0] += 1
                    n[1] += (w, w2) in known
        before = here
    return len(pairs), sum(met / n >= 0.5 for n, met in pairs.values())


def bigram_support(docs: DataFrame, key: str, text: str, drop: int = 7) -> DataFrame:
    """``(key, n_sentences, n_supported)``: sentences of a text without each ``drop``-th word, half of whose word pairs its source holds.

    A key's texts are shuffled once; words and their pairs never leave the row. Keys without a pair give no row.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = [_supported([(list(c["src"]), list(c["hyp"]), list(c["ends"])) for c in x]) for x in pdf["t"]]
            out = pd.DataFrame({key: pdf[key], "n_sentences": [x for x, _ in n], "n_supported": [x for _, x in n]})
            yield out[out["n_sentences"] > 0]

    def cut(t: Column) -> Column:
        src = F.split(F.trim(F.regexp_replace(t, r"\s+", " ")), " ")
        return bind(src, lambda w: bind(F.filter(w, lambda x, i: i % drop != drop - 1), lambda h: F.struct(
            w.alias("src"), h.alias("hyp"), F.transform(h, lambda x: x.rlike(r"[.!?]$")).alias("ends"))))

    d = docs.filter((F.trim(text) != "") & F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(text).alias("t"))
    return d.select(key, F.transform("t", cut).alias("t")).mapInPandas(count, f"{key} {dict(docs.dtypes)[key]}, n_sentences long, n_supported long")


def html_to_text(col) -> Column:
    """Visible text of an HTML page: drop script/style/comments, tags -> space, common entities, collapse spaces."""
    s = F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    s = F.regexp_replace(s, r"<[^>]+>", " ")
    for a, b in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def route(df: DataFrame, rules: list[tuple[str, Column]], fallback: str = "direct") -> DataFrame:
    """First matching rule names the route; the trace lists every rule that matched."""
    r = None
    for name, cond in rules:
        r = F.when(cond, F.lit(name)) if r is None else r.when(cond, F.lit(name))
    trace = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]), lambda x: x.isNotNull())
    return df.withColumn("route", r.otherwise(F.lit(fallback))).withColumn("trace", trace)


def retrieve_rerank(cands: DataFrame, extra: DataFrame, w: float, k: int, query: str = "query", doc: str = "doc_id",
                    tie_digits: int = 9) -> DataFrame:
    """Re-rank cheap candidates by w * candidate score + (1 - w) * (extra score / the query's max extra score)."""
    mx = extra.groupBy(query).agg(F.max("score").alias("__mx"))
    e = extra.join(mx, query).select(query, doc, (F.col("score") / F.col("__mx")).alias("__x"))
    j = cands.select(query, doc, F.col("score").alias("__c")).join(e, [query, doc], "left").fillna(0.0, ["__x"])
    j = j.withColumn("score", F.lit(w) * F.col("__c") + F.lit(1 - w) * F.col("__x"))
    return top_k_per_key(j.select(query, doc, "score"), query, [F.desc(F.round("score", tie_digits)), F.col(doc)], k,
                         rank_col="rank", salt_cols=[doc])
