"""Graph retrieval, grounding and summary queries over documents and benchmark passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import r6, word_tokens
from tessera.functions.skew import top_k_per_key
from tessera.operators import graph as gr
from tessera.operators import retrieval as rt
from tessera.operators import text as tx
from tessera.plans.common import round_doubles
from tessera.plans.registry import register
from tessera.session import cut_lineage, store
from tessera.sources.tables import table

STOP_SQL = "stop AS (SELECT unnest([" + ", ".join(f"'{w}'" for w in gr.ENTITY_STOPWORDS) + "]) AS word)"

CHUNK_SQL = r"""w AS (SELECT doc_id, regexp_split_to_array(trim(text), '\s+') AS w FROM documents WHERE trim(text) <> ''),
chunks AS (SELECT doc_id, CAST(k - 1 AS INTEGER) AS chunk_id, array_to_string(w[s + 1:s + 50], ' ') AS chunk_text
           FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 10, 1), 40)) AS s,
                        generate_subscripts(range(0, greatest(len(w) - 10, 1), 40), 1) AS k FROM w))"""

MENTION_SQL = CHUNK_SQL + ",\n" + STOP_SQL + r""",
mentions AS (SELECT DISTINCT doc_id, chunk_id, entity
             FROM (SELECT doc_id, chunk_id, unnest(regexp_extract_all(chunk_text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*')) AS entity FROM chunks)
             WHERE entity NOT IN (SELECT word FROM stop)),
edges AS (SELECT x.entity AS a, y.entity AS b, count(*) AS weight FROM mentions x JOIN mentions y
          ON x.doc_id = y.doc_id AND x.chunk_id = y.chunk_id AND x.entity < y.entity GROUP BY 1, 2)"""


def _stop(spark):
    return spark.createDataFrame([(w,) for w in gr.ENTITY_STOPWORDS], "word string")


def chunks(spark, sf):
    return tx.chunk_words(table(spark, sf, "documents"), "doc_id", "text", 50, 10)


def mentions(spark, sf):
    return gr.extract_entities(chunks(spark, sf), ["doc_id", "chunk_id"], "chunk_text", _stop(spark))


def edges(spark, sf, m=None):
    return gr.build_edges(m if m is not None else mentions(spark, sf), ["doc_id", "chunk_id"])


@register("G01_entity_mentions", "WITH " + MENTION_SQL + " SELECT doc_id, chunk_id, entity FROM mentions")
def q_g01(spark, sf):
    return mentions(spark, sf)


@register("G02_cooccurrence_edges", "WITH " + MENTION_SQL + " SELECT a, b, weight FROM edges")
def q_g02(spark, sf):
    return edges(spark, sf)


def _lpa_round(prev: str, name: str) -> str:
    return f"""{name} AS (SELECT node, label FROM (
    SELECT v.node, v.label, row_number() OVER (PARTITION BY v.node ORDER BY v.score DESC, v.label) AS r
    FROM (SELECT u.a AS node, p.label, sum(u.weight) AS score FROM und u JOIN {prev} p ON p.node = u.b GROUP BY 1, 2) v)
  WHERE r = 1)"""


LPA_SQL = MENTION_SQL + """,
und AS (SELECT a, b, weight FROM edges UNION ALL SELECT b, a, weight FROM edges),
l0 AS (SELECT DISTINCT a AS node, a AS label FROM und),
""" + ",\n".join(_lpa_round(f"l{i}", f"l{i + 1}") for i in range(3))


def labels(spark, sf):
    return gr.communities(edges(spark, sf), 3)


@register("G03_communities_lpa3", "WITH " + LPA_SQL + " SELECT node, label FROM l3")
def q_g03(spark, sf):
    return labels(spark, sf)


@register("G04_community_summary", "WITH " + LPA_SQL + r""",
deg AS (SELECT node, sum(weight) AS degree FROM (SELECT a AS node, weight FROM edges UNION ALL SELECT b, weight FROM edges) GROUP BY 1),
d AS (SELECT l3.label, l3.node, deg.degree FROM l3 JOIN deg USING (node)),
t AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY degree DESC, node) AS r FROM d),
ents AS (SELECT label, count(*) AS size, string_agg(CASE WHEN r <= 3 THEN node END, ', ' ORDER BY degree DESC, node) AS top_entities FROM t GROUP BY label),
own AS (SELECT DISTINCT l3.label, m.doc_id, m.chunk_id FROM mentions m JOIN l3 ON l3.node = m.entity),
txt AS (SELECT own.label, c.chunk_text FROM own JOIN chunks c USING (doc_id, chunk_id)),
ctok AS (SELECT label, unnest(regexp_extract_all(lower(chunk_text), '[\p{L}\p{N}_]{2,}')) AS term FROM txt),
ctf AS (SELECT label, term, count(*) AS tf FROM ctok GROUP BY 1, 2),
cidf AS (SELECT term, ln((1 + (SELECT count(DISTINCT label) FROM ctf)) / (1 + count(*))) + 1 AS idf FROM ctf GROUP BY term),
cw AS (SELECT label, term, tf * idf AS w FROM ctf JOIN cidf USING (term)),
cv AS (SELECT label, term, w / sqrt(sum(w * w) OVER (PARTITION BY label)) AS weight FROM cw),
tt AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(weight, 9) DESC, term) AS r FROM cv),
terms AS (SELECT label, string_agg(term, ' ' ORDER BY r) AS top_terms FROM tt WHERE r <= 5 GROUP BY label),
cs AS (SELECT DISTINCT label, unnest(string_split(regexp_replace(trim(regexp_replace(chunk_text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(10), 'g'), chr(10))) AS sentence FROM txt),
cst AS (SELECT label, sentence, unnest(list_distinct(regexp_extract_all(lower(sentence), '[\p{L}\p{N}_]{2,}'))) AS term FROM cs WHERE sentence <> ''),
csc AS (SELECT label, sentence, sum(weight) / sqrt(count(*)) AS score FROM cst JOIN cv USING (label, term) GROUP BY 1, 2),
cr AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(score, 9) DESC, sentence) AS r FROM csc),
best AS (SELECT label, md5(string_agg(sentence, ' ' ORDER BY r)) AS best_sentences_md5 FROM cr WHERE r <= 2 GROUP BY label)
SELECT label, size, top_entities, top_terms, best_sentences_md5 FROM ents JOIN terms USING (label) LEFT JOIN best USING (label)""")
def q_g04(spark, sf):
    ch, m = chunks(spark, sf), cut_lineage(mentions(spark, sf))
    e = cut_lineage(edges(spark, sf, m))
    lab = cut_lineage(gr.communities(e, 3))
    v, own = gr.community_terms(lab, ch, m, ["doc_id", "chunk_id"])
    digest = gr.community_digest(store(v)[0], own).select("label", F.array_join("top_terms", " ").alias("top_terms"),
                                                              F.md5(F.array_join("best_sentences", " ")).alias("best_sentences_md5"))
    return gr.summarise_communities(lab, e, 3).join(digest, "label")


QENT_SQL = STOP_SQL.replace("stop AS", "qstop AS") + r""",
qe AS (SELECT DISTINCT item_id AS query, entity FROM (
         SELECT item_id, unnest(regexp_extract_all(text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*')) AS entity FROM benchmark)
       WHERE entity NOT IN (SELECT word FROM qstop))"""

GRAPH_RET_SQL = MENTION_SQL + ",\n" + QENT_SQL + """,
und AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
nb AS (SELECT query, entity, max(w) AS w FROM (SELECT query, entity, 2 AS w FROM qe
        UNION ALL SELECT q.query, u.b, 1 FROM qe q JOIN und u ON u.a = q.entity) GROUP BY 1, 2),
dm AS (SELECT DISTINCT doc_id, entity FROM mentions),
gsc AS (SELECT query, doc_id, CAST(sum(w) AS BIGINT) AS score FROM nb JOIN dm USING (entity) GROUP BY 1, 2),
gtop AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS BIGINT) AS rank FROM gsc)
         WHERE rank <= 5)"""


def q_entities(spark, sf):
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("query"), "text")
    return gr.extract_entities(b, ["query"], "text", _stop(spark)).select("query", "entity")


def graph_scores(spark, sf, k, hops=1, among=None):
    m = cut_lineage(mentions(spark, sf))
    return gr.graph_retrieve(q_entities(spark, sf), edges(spark, sf, m), m.select("doc_id", "entity"), k, hops=hops, among=among)


def graph_top(spark, sf):
    return graph_scores(spark, sf, 5).withColumn("score", F.col("score").cast("long"))


@register("G05_graph_retrieve_top5", "WITH " + GRAPH_RET_SQL + " SELECT query, doc_id, score, rank FROM gtop")
def q_g05(spark, sf):
    return graph_top(spark, sf)


@register("G05_graph_retrieve_two_hops", "WITH RECURSIVE " + MENTION_SQL + ",\n" + QENT_SQL + """,
und AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
walk(query, entity, hop) AS (SELECT query, entity, 0 FROM qe UNION SELECT w.query, u.b, w.hop + 1 FROM walk w JOIN und u ON u.a = w.entity WHERE w.hop < 2),
nb AS (SELECT query, entity, 2.0::DOUBLE / power(2, min(hop)) AS w FROM walk GROUP BY 1, 2),
dm AS (SELECT DISTINCT doc_id, entity FROM mentions),
gsc AS (SELECT query, doc_id, sum(w) AS score FROM nb JOIN dm USING (entity) GROUP BY 1, 2)
SELECT query, doc_id, score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS BIGINT) AS rank FROM gsc) WHERE rank <= 5""")
def q_g05_two(spark, sf):
    return graph_scores(spark, sf, 5, hops=2)


FLAT_SQL = r"""dt AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY 1, 2),
nd AS (SELECT count(DISTINCT doc_id) AS n FROM dt),
idf AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM tf, nd GROUP BY term, n),
dw AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
dv AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM dw),
qt AS (SELECT item_id AS query, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM benchmark),
qw AS (SELECT query, term, count(*) * idf AS w FROM qt JOIN idf USING (term) GROUP BY query, term, idf),
qv AS (SELECT query, term, w / sqrt(sum(w * w) OVER (PARTITION BY query)) AS weight FROM qw),
fsc AS (SELECT q.query, d.doc_id, sum(q.weight * d.weight) AS score FROM qv q JOIN dv d USING (term) GROUP BY 1, 2),
ftop AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, doc_id) AS BIGINT) AS rank
                        FROM fsc) WHERE rank <= 5)"""


def doc_counts(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id")  # texts travel, not their words
    return rt.term_counts(d.select("doc_id", F.explode(word_tokens("text", 2)).alias("term")), "doc_id")


def flat_top(spark, sf, k=5):
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("query"), F.explode(word_tokens("text", 2)).alias("term"))
    return rt.retrieve(doc_counts(spark, sf), q, k)


@register("G06_flat_retrieve_top5", "WITH " + FLAT_SQL + " SELECT query, doc_id, round(score, 6) AS score, rank FROM ftop")
def q_g06(spark, sf):
    return round_doubles(flat_top(spark, sf))


TRUTH_SQL = r"""truth AS (SELECT b.item_id AS query, d.doc_id FROM benchmark b, documents d
          WHERE contains(regexp_replace(d.text, '\s+', ' ', 'g'), regexp_replace(b.text, '\s+', ' ', 'g'))),
qtype AS (SELECT item_id AS query, CASE WHEN contains(text, chr(10)) THEN 'multi-hop' ELSE 'lookup' END AS qtype FROM benchmark)"""


def truth(spark, sf):
    b = table(spark, sf, "benchmark")
    t = gr.containment_truth(b, "item_id", "text", table(spark, sf, "documents"), "doc_id", "text", 8)
    return t.withColumnRenamed("item_id", "query")


@register("G07_relevance_truth", "WITH " + TRUTH_SQL + " SELECT query, doc_id FROM truth")
def q_g07t(spark, sf):
    return truth(spark, sf)


@register("G07_compare_systems", "WITH " + GRAPH_RET_SQL + ",\n" + FLAT_SQL + ",\n" + TRUTH_SQL + """,
runs AS (SELECT 'graph' AS system, query, doc_id, rank FROM gtop UNION ALL SELECT 'flat', query, doc_id, rank FROM ftop),
nrel AS (SELECT query, count(*) AS n_rel FROM truth GROUP BY 1),
hits AS (SELECT r.system, r.query, min(r.rank) AS first_hit, count(*) AS found FROM runs r JOIN truth t USING (query, doc_id) GROUP BY 1, 2),
sq AS (SELECT s.system, n.query, n.n_rel FROM (SELECT 'graph' AS system UNION ALL SELECT 'flat') s, nrel n)
SELECT sq.system, qt.qtype, count(*) AS n_queries,
       round(avg(CASE WHEN h.first_hit = 1 THEN 1.0 ELSE 0.0 END), 6) AS hit_at_1,
       round(avg(coalesce(h.found, 0) / sq.n_rel), 6) AS recall_at_5
FROM sq JOIN qtype qt USING (query) LEFT JOIN hits h ON h.system = sq.system AND h.query = sq.query
GROUP BY sq.system, qt.qtype""")
def q_g07(spark, sf):
    t = truth(spark, sf)
    runs = graph_top(spark, sf).select(F.lit("graph").alias("system"), "query", "doc_id", "rank").unionByName(
        flat_top(spark, sf).select(F.lit("flat").alias("system"), "query", "doc_id", "rank"))
    nrel = t.groupBy("query").agg(F.count(F.lit(1)).alias("n_rel"))
    hits = runs.join(t, ["query", "doc_id"]).groupBy("system", "query").agg(F.min("rank").alias("first_hit"),
                                                                            F.count(F.lit(1)).alias("found"))
    qt = table(spark, sf, "benchmark").select(F.col("item_id").alias("query"), F.when(
        F.instr("text", "\n") > 0, "multi-hop").otherwise("lookup").alias("qtype"))
    sq = nrel.withColumn("system", F.explode(F.array(F.lit("graph"), F.lit("flat"))))
    j = sq.join(qt, "query").join(hits, ["system", "query"], "left")
    out = j.groupBy("system", "qtype").agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg(F.when(F.col("first_hit") == 1, 1.0).otherwise(0.0)).alias("hit_at_1"),
        F.avg(F.coalesce("found", F.lit(0)) / F.col("n_rel")).alias("recall_at_5"))
    return round_doubles(out)


SENT_SQL = r"""sents AS (SELECT doc_id, CAST(k - 1 AS INTEGER) AS sent_id, s AS sentence
          FROM (SELECT doc_id, unnest(a) AS s, generate_subscripts(a, 1) AS k
                FROM (SELECT doc_id, string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS a
                      FROM documents))
          WHERE s <> '')"""

SENT_RET_SQL = SENT_SQL + r""",
st AS (SELECT doc_id || ':' || sent_id AS sid, unnest(regexp_extract_all(lower(sentence), '[\p{L}\p{N}_]{2,}')) AS term FROM sents),
stf AS (SELECT sid, term, count(*) AS tf FROM st GROUP BY 1, 2),
snd AS (SELECT count(DISTINCT sid) AS n FROM st),
sidf AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM stf, snd GROUP BY term, n),
sw AS (SELECT sid, term, tf * idf AS w FROM stf JOIN sidf USING (term)),
sv AS (SELECT sid, term, w / sqrt(sum(w * w) OVER (PARTITION BY sid)) AS weight FROM sw)"""


def sentences(spark, sf):
    s = gr.split_sentences(table(spark, sf, "documents"), ["doc_id"], "text")
    return s.withColumn("sid", F.concat_ws(":", F.col("doc_id").cast("string"), F.col("sent_id").cast("string")))


def retrieve_sentences(spark, sf, queries, k):
    s = sentences(spark, sf).select("sid", "sentence").repartition("sid")  # sentences travel, not their words
    tf = rt.term_counts(s.select("sid", F.explode(word_tokens("sentence", 2)).alias("term")), "sid")
    return rt.retrieve(tf, queries.select("query", F.explode(word_tokens("text", 2)).alias("term")), k, doc="sid")


@register("G08_answer_passages", "WITH " + SENT_RET_SQL + r""",
qt AS (SELECT item_id AS query, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM benchmark),
qw AS (SELECT query, term, count(*) * idf AS w FROM qt JOIN sidf USING (term) GROUP BY query, term, idf),
qv AS (SELECT query, term, w / sqrt(sum(w * w) OVER (PARTITION BY query)) AS weight FROM qw),
sc AS (SELECT q.query, s.sid, sum(q.weight * s.weight) AS score FROM qv q JOIN sv s USING (term) GROUP BY 1, 2),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, sid) AS BIGINT) AS rank FROM sc)
        WHERE rank <= 3),
kept AS (SELECT query, sid, score, rank, 'answer' AS status FROM top WHERE score >= 0.3)
SELECT query, sid, round(score, 6) AS score, rank, status FROM kept
UNION ALL
SELECT DISTINCT item_id, '', 0.0, CAST(0 AS BIGINT), 'none' FROM benchmark WHERE item_id NOT IN (SELECT query FROM kept)""")
def q_g08(spark, sf):
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("query"), "text")
    top = retrieve_sentences(spark, sf, b, 3)
    a = gr.answer_passages(top, b, "query", 0.3).select("query", "sid", "score", "rank", "status")
    # a 'none' row carries empty values rather than nulls
    a = a.fillna({"sid": "", "score": 0.0, "rank": 0})
    return round_doubles(a)


# every sentence of every passage is a claim; those of odd passages are negated
CLAIMS_SQL = r"""claims AS (SELECT item_id || ':' || (k - 1) AS query, CASE WHEN item_id % 2 = 1 THEN 'not ' ELSE '' END || s AS text
           FROM (SELECT item_id, unnest(a) AS s, generate_subscripts(a, 1) AS k
                 FROM (SELECT item_id, string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS a
                       FROM benchmark)) WHERE s <> '')"""


def claims(spark, sf):
    s = gr.split_sentences(table(spark, sf, "benchmark"), ["item_id"], "text")
    return s.select(F.concat_ws(":", F.col("item_id").cast("string"), F.col("sent_id").cast("string")).alias("query"),
                    F.concat(F.when(F.col("item_id") % 2 == 1, F.lit("not ")).otherwise(F.lit("")), F.col("sentence")).alias("text"))


@register("G09_claim_verdicts", "WITH " + SENT_RET_SQL + ",\n" + CLAIMS_SQL + r""",
qt AS (SELECT query, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM claims),
qw AS (SELECT query, term, count(*) * idf AS w FROM qt JOIN sidf USING (term) GROUP BY query, term, idf),
qv AS (SELECT query, term, w / sqrt(sum(w * w) OVER (PARTITION BY query)) AS weight FROM qw),
sc AS (SELECT q.query, s.sid, sum(q.weight * s.weight) AS score FROM qv q JOIN sv s USING (term) GROUP BY 1, 2),
ev AS (SELECT query, sid FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, sid) AS r FROM sc) WHERE r = 1),
evt AS (SELECT ev.query, ev.sid, s.sentence AS evidence FROM ev JOIN sents s ON ev.sid = s.doc_id || ':' || s.sent_id),
j AS (SELECT c.query, c.text, e.sid, e.evidence,
             regexp_extract_all(lower(c.text), '[\p{L}\p{N}_]+') AS ct,
             coalesce(regexp_extract_all(lower(e.evidence), '[\p{L}\p{N}_]+'), []::VARCHAR[]) AS et
      FROM claims c LEFT JOIN evt e USING (query)),
f AS (SELECT query, sid, evidence,
             CASE WHEN len(list_distinct(ct)) = 0 THEN 0.0 ELSE len(list_intersect(list_distinct(ct), et)) / len(list_distinct(ct)) END AS overlap,
             array_to_string(list_sort(regexp_extract_all(coalesce(text, ''), '\d+')), ',') <> array_to_string(list_sort(regexp_extract_all(coalesce(evidence, ''), '\d+')), ',') AS nm,
             (len(list_intersect(ct, ['not', 'no', 'never', 'ne', 'pas', 'jamais', 'nicht', 'kein', 'keine', 'nunca'])) > 0)
               <> (len(list_intersect(et, ['not', 'no', 'never', 'ne', 'pas', 'jamais', 'nicht', 'kein', 'keine', 'nunca'])) > 0) AS gm
      FROM j)
SELECT query, sid, round(overlap, 6) AS overlap,
       CASE WHEN evidence IS NULL OR overlap < 0.6 THEN 'unverifiable' WHEN nm OR gm THEN 'contradicted' ELSE 'corroborated' END AS verdict
FROM f""")
def q_g09(spark, sf):
    c = claims(spark, sf)
    top1 = retrieve_sentences(spark, sf, c, 1)
    ev = top1.join(sentences(spark, sf).select("sid", F.col("sentence").alias("evidence")), "sid").select("query", "sid", "evidence")
    v = gr.claim_verdicts(c, ev, "query", "text", "evidence")
    return v.select("query", "sid", r6("overlap").alias("overlap"), "verdict")


SUMMARY_SQL = FLAT_SQL + ",\n" + SENT_SQL + r""",
stok AS (SELECT doc_id, sent_id, unnest(regexp_extract_all(lower(sentence), '[\p{L}\p{N}_]{2,}')) AS term FROM sents),
ssc AS (SELECT s.doc_id, s.sent_id, avg(coalesce(d.weight, 0.0)) AS score FROM stok s LEFT JOIN dv d USING (doc_id, term)
        GROUP BY 1, 2),
ranked AS (SELECT x.doc_id, x.sent_id, x.sentence, c.score,
                  row_number() OVER (PARTITION BY x.doc_id ORDER BY round(c.score, 9) DESC, x.sent_id) AS r
           FROM sents x JOIN ssc c USING (doc_id, sent_id))"""


def sentence_scores(spark, sf):
    s = sentences(spark, sf).select("doc_id", "sent_id", "sentence")
    return s, gr.sentence_scores(s, "doc_id")


@register("G10_extractive_summary_top3", "WITH " + SUMMARY_SQL + """
SELECT doc_id, md5(string_agg(sentence, ' ' ORDER BY sent_id)) AS summary_md5 FROM ranked WHERE r <= 3 GROUP BY doc_id""")
def q_g10(spark, sf):
    s, sc = sentence_scores(spark, sf)
    return gr.summarise(s, sc, ["doc_id"], 3).select("doc_id", F.md5("summary").alias("summary_md5"))


def _greedy_round(prev: str, i: int) -> str:
    """One choice per document from ``prev`` and what it leaves."""
    return f"""p{i} AS (SELECT doc_id, sent_id, sentence, t FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, sent_id) AS r FROM {prev}) WHERE r = 1),
c{i} AS (SELECT l.* FROM {prev} l JOIN p{i} p USING (doc_id) WHERE l.sent_id <> p.sent_id
       AND NOT coalesce(len(list_intersect(l.t, p.t)) / nullif(sqrt(len(l.t) * len(p.t)), 0) >= 0.7 - 1e-9, FALSE))"""


@register("G13_two_level_summary", "WITH " + SUMMARY_SQL + r""",
c0 AS (SELECT doc_id, sent_id, sentence, score, list_distinct(regexp_extract_all(lower(sentence), '[\p{L}\p{N}_]{2,}')) AS t
       FROM (SELECT x.doc_id, x.sent_id, x.sentence, c.score,
              row_number() OVER (PARTITION BY x.doc_id, x.sent_id // 10 ORDER BY round(c.score, 9) DESC, x.sent_id) AS r1
              FROM sents x JOIN ssc c USING (doc_id, sent_id)) WHERE r1 = 1),
""" + ",\n".join(_greedy_round(f"c{i}", i + 1) for i in range(3)) + """,
picked AS (SELECT doc_id, sent_id, sentence FROM p1 UNION ALL SELECT doc_id, sent_id, sentence FROM p2 UNION ALL SELECT doc_id, sent_id, sentence FROM p3)
SELECT doc_id, count(*) AS n_sentences, md5(string_agg(sentence, ' ' ORDER BY sent_id)) AS summary_md5 FROM picked GROUP BY doc_id""")
def q_g13(spark, sf):
    """Winners of chunks of ten sentences, then three of them per document that do not repeat each other."""
    s, sc = sentence_scores(spark, sf)
    j = s.join(sc, ["doc_id", "sent_id"]).withColumn("chunk", F.floor(F.col("sent_id") / 10).cast("long"))
    l1 = top_k_per_key(j, ["doc_id", "chunk"], [F.desc(F.round("score", 9)), F.col("sent_id")], 1, salt_cols=["sent_id"])
    picked = gr.drop_redundant(l1.select("doc_id", "sent_id", "sentence", "score"), "doc_id", 3)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sent_id", "sentence"))), lambda x: x["sentence"]), " ")
    return picked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"), F.md5(text).alias("summary_md5"))


@register("G12_supporting_passage", "WITH " + SENT_SQL + """,
sw AS (SELECT doc_id, sent_id, string_split(sentence, ' ') AS words FROM sents),
hw AS (SELECT doc_id, sent_id, CASE WHEN sent_id % 5 = 4 THEN list_reverse(words) ELSE list_filter(words, lambda x, i: (i - 1) % 7 <> 6) END AS words FROM sw),
hb AS (SELECT DISTINCT doc_id, sent_id, array_to_string(words[i:i + 1], ' ') AS pair FROM (SELECT *, unnest(range(1, len(words))) AS i FROM hw)),
sb AS (SELECT DISTINCT doc_id, sent_id AS passage, array_to_string(words[i:i + 1], ' ') AS pair FROM (SELECT *, unnest(range(1, len(words))) AS i FROM sw)),
met AS (SELECT doc_id, sent_id, passage, count(*) AS m FROM hb JOIN sb USING (doc_id, pair) GROUP BY 1, 2, 3),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, sent_id ORDER BY m DESC, passage) AS r FROM met) WHERE r = 1),
n AS (SELECT doc_id, sent_id, count(*) AS n FROM hb GROUP BY 1, 2)
SELECT hw.doc_id, hw.sent_id, coalesce(top.passage, -1) AS passage, round(coalesce(m / n, 0), 6) AS share, coalesce(m / n, 0) >= 0.5 AS supported
FROM hw LEFT JOIN n USING (doc_id, sent_id) LEFT JOIN top USING (doc_id, sent_id)""")
def q_g12_passage(spark, sf):
    """Every sentence with each seventh word dropped is the summary; every fifth one is reversed, which its source does not support."""
    w = sentences(spark, sf).select("doc_id", "sent_id", F.split("sentence", " ").alias("words"))
    h = w.withColumn("words", F.when(F.col("sent_id") % 5 == 4, F.reverse("words")).otherwise(F.filter("words", lambda x, i: i % 7 != 6)))
    return round_doubles(gr.best_support(h, w, "doc_id"))


@register("G12_faithfulness_bigram_support", r"""
WITH ref AS (SELECT doc_id, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') AS rw FROM documents WHERE trim(text) <> ''),
hyp AS (SELECT doc_id, rw, list_filter(rw, lambda x, i: (i - 1) % 7 <> 6) AS hw FROM ref),
ht AS (SELECT doc_id, unnest(hw) AS w, generate_subscripts(hw, 1) AS pos FROM hyp),
hs AS (SELECT doc_id, pos, w, coalesce(sum(CASE WHEN regexp_matches(w, '[.!?]$') THEN 1 ELSE 0 END)
          OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sent FROM ht),
hb AS (SELECT a.doc_id, a.sent, a.w || ' ' || b.w AS g FROM hs a JOIN hs b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 AND a.sent = b.sent),
rb AS (SELECT DISTINCT doc_id, array_to_string(rw[i:i + 1], ' ') AS g FROM (SELECT doc_id, rw, unnest(range(1, len(rw))) AS i FROM ref)),
ss AS (SELECT hb.doc_id, hb.sent, avg(CASE WHEN rb.g IS NOT NULL THEN 1.0 ELSE 0.0 END) AS share
       FROM hb LEFT JOIN rb ON hb.doc_id = rb.doc_id AND hb.g = rb.g GROUP BY 1, 2)
SELECT doc_id, count(*) AS n_sentences, CAST(sum(CASE WHEN share >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_supported
FROM ss GROUP BY doc_id""")
def q_g12(spark, sf):
    return gr.bigram_support(table(spark, sf, "documents"), "doc_id", "text")


@register("G15_route_inputs", r"""
WITH inp AS (SELECT 'doc' AS kind, doc_id AS id, lang, n_chars FROM documents
             UNION ALL SELECT 'page', page_id, NULL, length(html) FROM pages)
SELECT kind, id,
       CASE WHEN kind = 'page' THEN 'strip_html' WHEN lang <> 'en' THEN 'translate' WHEN n_chars > 10000 THEN 'chunk' ELSE 'direct' END AS route,
       concat_ws(',', CASE WHEN kind = 'page' THEN 'strip_html' END, CASE WHEN lang <> 'en' THEN 'translate' END,
                 CASE WHEN n_chars > 10000 THEN 'chunk' END) AS trace
FROM inp""")
def q_g15(spark, sf):
    d = table(spark, sf, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), "lang",
                                              F.col("n_chars").cast("long").alias("n_chars"))
    p = table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"),
                                          F.lit(None).cast("string").alias("lang"), F.char_length("html").cast("long").alias("n_chars"))
    rules = [("strip_html", F.col("kind") == "page"), ("translate", F.col("lang") != "en"),
             ("chunk", F.col("n_chars") > 10000)]
    r = gr.route(d.unionByName(p), rules)
    return r.select("kind", "id", "route", F.array_join("trace", ",").alias("trace"))


@register("G15_page_visible_text", r"""
SELECT page_id, md5(trim(regexp_replace(
  replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g'),
    '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '),
  '\s+', ' ', 'g'))) AS text_md5 FROM pages""")
def q_g15p(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(gr.html_to_text("html")).alias("text_md5"))


@register("N10_retrieve_rerank", "WITH " + GRAPH_RET_SQL + ",\n" + FLAT_SQL.replace("WHERE rank <= 5", "WHERE rank <= 20") + """,
gx AS (SELECT query, doc_id, score / max(score) OVER (PARTITION BY query) AS x FROM gsc),
rr AS (SELECT f.query, f.doc_id, 0.6 * f.score + 0.4 * coalesce(g.x, 0.0) AS score FROM ftop f LEFT JOIN gx g USING (query, doc_id))
SELECT query, doc_id, round(score, 6) AS score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, doc_id) AS BIGINT) AS rank FROM rr)
WHERE rank <= 5""")
def q_n10(spark, sf):
    cands = cut_lineage(flat_top(spark, sf, 20))
    gs = cut_lineage(graph_scores(spark, sf, 1, among=cands))  # the best score of a query and those of its candidates
    return round_doubles(gr.retrieve_rerank(cands, gs, 0.6, 5))
