"""Text preparation and text-generation metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import md5_bucket, r6, simple_tokens
from tessera.operators import text as tx
from tessera.operators import textmetrics as tm
from tessera.plans.common import round_doubles
from tessera.plans.registry import register
from tessera.sources.tables import table

# ---------------------------------------------------------------- SQL pieces
SIMPLE_TOKS_SQL = r"""CASE WHEN trim(regexp_replace(regexp_replace(lower({t}), '([?.!,])', ' \1 ', 'g'), '\s+', ' ', 'g')) = '' THEN []::VARCHAR[]
     ELSE string_split(trim(regexp_replace(regexp_replace(lower({t}), '([?.!,])', ' \1 ', 'g'), '\s+', ' ', 'g')), ' ') END"""
DIALOG_TOKS_SQL = r"""regexp_extract_all(replace(replace(lower({t}), '<usr1>', ' usr1speaker '), '<usr2>', ' usr2speaker '), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')"""

TURN_TOKS_SQL = f"""toks AS (SELECT conv_id, turn, {DIALOG_TOKS_SQL.format(t='text')} AS toks FROM conversations),
trows AS (SELECT conv_id, turn, unnest(toks) AS token, generate_subscripts(toks, 1) - 1 AS pos FROM toks)"""

VOCAB_SQL = TURN_TOKS_SQL + """,
vocab AS (SELECT token, count, CAST(row_number() OVER (ORDER BY count DESC, token) + 3 AS BIGINT) AS id
          FROM (SELECT token, count(*) AS count FROM trows GROUP BY token) WHERE count >= 2)"""

ENC_SQL = VOCAB_SQL + """,
enc AS (SELECT conv_id, turn, list(coalesce(v.id, 3) ORDER BY pos) AS raw_ids
        FROM trows LEFT JOIN vocab v USING (token) GROUP BY conv_id, turn)"""


def _turn_rows(spark, sf):
    c = table(spark, sf, "conversations")
    return tx.token_rows(c, ["conv_id", "turn"], tx.tokenize_dialogue("text"))


def _vocab(spark, sf):
    return tx.build_vocab(_turn_rows(spark, sf), 2)


def _raw_ids(spark, sf):
    return tx.encode_tokens(_turn_rows(spark, sf), ["conv_id", "turn"], _vocab(spark, sf), sos_eos=False)


def _ids_str(col):
    return F.array_join(F.transform(col, lambda x: x.cast("string")), " ")


@register("T01_simple_tokens", f"""
SELECT conv_id, turn, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT conv_id, turn, {SIMPLE_TOKS_SQL.format(t='text')} AS t FROM conversations)""")
def q_t01(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", tx.tokenize_simple("text").alias("t"))
    return c.select("conv_id", "turn", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@register("T02_dialogue_tokens", "WITH " + TURN_TOKS_SQL + """
SELECT conv_id, turn, CAST(len(toks) AS BIGINT) AS n_tokens, array_to_string(toks, ' ') AS tokens FROM toks""")
def q_t02(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", tx.tokenize_dialogue("text").alias("t"))
    return c.select("conv_id", "turn", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@register("T03_clean_text", r"""
SELECT conv_id, turn, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[\r\n]+', ' ', 'g'), '\s+', ' ', 'g')) AS text
FROM conversations""")
def q_t03(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", tx.clean_text("text").alias("text"))


@register("T04_build_vocab_min2", "WITH " + VOCAB_SQL + " SELECT token, count, id FROM vocab")
def q_t04(spark, sf):
    return _vocab(spark, sf).select("token", "count", "id")


@register("T05_encode_turns", "WITH " + ENC_SQL + """
SELECT conv_id, turn, '1 ' || array_to_string(raw_ids, ' ') || ' 2' AS ids FROM enc""")
def q_t05(spark, sf):
    e = tx.encode_tokens(_turn_rows(spark, sf), ["conv_id", "turn"], _vocab(spark, sf))
    return e.select("conv_id", "turn", _ids_str(F.col("ids")).alias("ids"))


SHIFT_SQL = ENC_SQL + """,
sh AS (SELECT conv_id, turn, [1] || raw_ids[1:10] AS inp, raw_ids[1:10] || [2] AS outp FROM enc),
padded AS (SELECT conv_id, turn, (inp || list_transform(range(11 - len(inp)), lambda x: 0))[1:11] AS input_ids,
                  (outp || list_transform(range(11 - len(outp)), lambda x: 0))[1:11] AS output_ids FROM sh)"""


def _shifted(spark, sf):
    inp, outp = tx.shift_targets("ids", 12)
    return _raw_ids(spark, sf).select("conv_id", "turn", inp.alias("input_ids"), outp.alias("output_ids"))


@register("T07_shift_pad_targets", "WITH " + SHIFT_SQL + """
SELECT conv_id, turn, array_to_string(input_ids, ' ') AS input_ids, array_to_string(output_ids, ' ') AS output_ids FROM padded""")
def q_t07(spark, sf):
    s = _shifted(spark, sf)
    return s.select("conv_id", "turn", _ids_str(F.col("input_ids")).alias("input_ids"),
                    _ids_str(F.col("output_ids")).alias("output_ids"))


@register("T08_decode_ids", "WITH " + ENC_SQL + """,
e AS (SELECT conv_id, turn, unnest(raw_ids) AS id, generate_subscripts(raw_ids, 1) AS pos FROM enc)
SELECT conv_id, turn, string_agg(coalesce(v.token, '<UNK>'), ' ' ORDER BY pos) AS text
FROM e LEFT JOIN vocab v USING (id) WHERE e.id NOT IN (0, 1) GROUP BY conv_id, turn""")
def q_t08(spark, sf):
    e = tx.encode_tokens(_turn_rows(spark, sf), ["conv_id", "turn"], _vocab(spark, sf))
    return tx.decode_ids(e, ["conv_id", "turn"], "ids", _vocab(spark, sf))


@register("T09_oov_report_test_convs", f"""
WITH toks AS (SELECT conv_id, {DIALOG_TOKS_SQL.format(t='text')} AS toks,
                     CAST(('0x' || substring(md5(concat_ws('|', '42', conv_id)), 1, 8))::BIGINT % 10000 AS BIGINT) < 8000 AS is_train
              FROM conversations),
trows AS (SELECT is_train, unnest(toks) AS token FROM toks),
vocab AS (SELECT token FROM trows WHERE is_train GROUP BY token HAVING count(*) >= 2)
SELECT count(*) AS n_tokens, round(avg(CASE WHEN v.token IS NULL THEN 1.0 ELSE 0.0 END), 6) AS unk_rate,
       round(count(DISTINCT v.token) / count(DISTINCT t.token), 6) AS type_coverage
FROM trows t LEFT JOIN vocab v USING (token) WHERE NOT is_train""")
def q_t09(spark, sf):
    c = table(spark, sf, "conversations").withColumn("is_train", md5_bucket(42, 10000, "conv_id") < 8000)
    rows = tx.token_rows(c, ["conv_id", "is_train"], tx.tokenize_dialogue("text"))
    vocab = tx.build_vocab(rows.filter("is_train"), 2)
    return round_doubles(tx.oov_report(rows.filter("NOT is_train"), vocab))


TITLE_SQL = "titles AS (SELECT p_partkey AS posting_id, concat_ws(' ', p_name, p_brand, p_type) AS title FROM part)"


def _titles(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("posting_id"),
                                           F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("title"))


WORD_TERMS_SQL = TITLE_SQL + r""",
toks AS (SELECT posting_id, regexp_extract_all(lower(title), '[\p{L}\p{N}_]{2,}') AS t FROM titles),
terms AS (SELECT posting_id, array_to_string(t[i:i + n - 1], ' ') AS term
          FROM (SELECT posting_id, t, n, unnest(range(1, len(t) - n + 2)) AS i FROM toks, range(1, 3) AS nn(n)))"""

CHAR_TERMS_SQL = TITLE_SQL + r""",
s AS (SELECT posting_id, trim(regexp_replace(lower(title), '\s+', ' ', 'g')) AS s FROM titles),
terms AS (SELECT posting_id, substring(s, i, n) AS term
          FROM (SELECT posting_id, s, n, unnest(range(1, length(s) - n + 2)) AS i FROM s, range(3, 6) AS nn(n)))"""

TFIDF_SQL = """,
tf AS (SELECT posting_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
st AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= {min_df}),
nd AS (SELECT count(DISTINCT posting_id) AS n FROM terms),
w AS (SELECT posting_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN st USING (term), nd),
tfidf AS (SELECT posting_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY posting_id)) AS weight FROM w)"""


def word_tfidf(spark, sf, min_df=2):
    return tx.tfidf(tx.ngram_rows(_titles(spark, sf), ["posting_id"], "title", "word", 1, 2), "posting_id", min_df)


def char_tfidf(spark, sf, min_df=1):
    return tx.tfidf(tx.ngram_rows(_titles(spark, sf), ["posting_id"], "title", "char", 3, 5), "posting_id", min_df)


WORD_TFIDF_SQL = WORD_TERMS_SQL + TFIDF_SQL.format(min_df=2)
CHAR_TFIDF_SQL = CHAR_TERMS_SQL + TFIDF_SQL.format(min_df=1)


@register("T12_tfidf_word_1_2", "WITH " + WORD_TFIDF_SQL + " SELECT posting_id, term, round(weight, 6) AS weight FROM tfidf")
def q_t12w(spark, sf):
    return round_doubles(word_tfidf(spark, sf))


@register("T12_tfidf_char_3_5", "WITH " + CHAR_TFIDF_SQL + " SELECT posting_id, term, round(weight, 6) AS weight FROM tfidf")
def q_t12c(spark, sf):
    return round_doubles(char_tfidf(spark, sf))


@register("T13_sessions_on_role_change", """
SELECT conv_id, turn, CAST(sum(chg) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session
FROM (SELECT conv_id, turn, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL
                                   OR lag(role) OVER (PARTITION BY conv_id ORDER BY turn) <> role THEN 1 ELSE 0 END AS chg
      FROM conversations)""")
def q_t13(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return tx.sessionize_on_change(c, "conv_id", "turn", "role").select("conv_id", "turn", "session")


TAGS = {"user": "<USR1>", "assistant": "<USR2>", "system": "<SYS>"}


@register("T14_dialogue_examples", r"""
WITH c AS (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[\r\n]+', ' ', 'g'), '\s+', ' ', 'g')) AS t,
                  CASE role WHEN 'user' THEN '<USR1>' WHEN 'assistant' THEN '<USR2>' WHEN 'system' THEN '<SYS>' END AS tag
           FROM conversations),
h AS (SELECT conv_id, turn, t,
             list(CASE WHEN t <> '' THEN concat_ws(' ', tag, t) END) OVER (PARTITION BY conv_id ORDER BY turn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hist
      FROM c)
SELECT conv_id, turn, array_to_string(list_filter(hist, lambda x: x IS NOT NULL), ' ') AS history, t AS target
FROM h WHERE t <> '' AND len(list_filter(hist, lambda x: x IS NOT NULL)) > 0""")
def q_t14(spark, sf):
    c = table(spark, sf, "conversations")
    return tx.dialogue_examples(c, "conv_id", "turn", "role", "text", TAGS)


@register("T15_attach_document", """
SELECT conv_id, turn, CAST(length(coalesce(d.text, '')) AS BIGINT) AS doc_chars
FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id * 13""")
def q_t15(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", (F.col("conv_id") * 13).alias("doc_id"))
    a = tx.attach_document(c, table(spark, sf, "documents"), ["doc_id"])
    return a.select("conv_id", "turn", F.char_length("document").cast("long").alias("doc_chars"))


@register("T16_chunk_word_windows", r"""
WITH w AS (SELECT doc_id, regexp_split_to_array(trim(text), '\s+') AS w FROM documents WHERE trim(text) <> '')
SELECT doc_id, CAST(k - 1 AS INTEGER) AS chunk_id, md5(array_to_string(w[s + 1:s + 50], ' ')) AS chunk_md5
FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 10, 1), 40)) AS s,
             generate_subscripts(range(0, greatest(len(w) - 10, 1), 40), 1) AS k FROM w)""")
def q_t16(spark, sf):
    ch = tx.chunk_words(table(spark, sf, "documents"), "doc_id", "text", 50, 10)
    return ch.select("doc_id", "chunk_id", F.md5("chunk_text").alias("chunk_md5"))


@register("T16_chunk_sentences", r"""
SELECT doc_id, CAST(k - 1 AS INTEGER) AS chunk_id, md5(s) AS chunk_md5
FROM (SELECT doc_id, unnest(a) AS s, generate_subscripts(a, 1) AS k
      FROM (SELECT doc_id, string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS a FROM documents))
WHERE s <> ''""")
def q_t16s(spark, sf):
    ch = tx.chunk_sentences(table(spark, sf, "documents"), "doc_id", "text")
    return ch.select("doc_id", "chunk_id", F.md5("chunk_text").alias("chunk_md5"))


@register("T16_chunk_paragraphs", r"""
SELECT doc_id, CAST(k - 1 AS INTEGER) AS chunk_id, md5(s) AS chunk_md5
FROM (SELECT doc_id, unnest(a) AS s, generate_subscripts(a, 1) AS k
      FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\n[ \t\r]*\n'), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(10))), lambda x: x <> '') AS a FROM documents))""")
def q_t16p(spark, sf):
    ch = tx.chunk_paragraphs(table(spark, sf, "documents"), "doc_id", "text")
    return ch.select("doc_id", "chunk_id", F.md5("chunk_text").alias("chunk_md5"))


# Function words whose share marks a French turn (code-mix share).
FRENCH_FUNCTION_WORDS = ["le", "la", "les", "de", "des", "du", "et", "un", "une", "en"]


@register("T17_mix_ratio", "WITH " + TURN_TOKS_SQL + """,
r AS (SELECT conv_id, turn, avg(CASE WHEN token IN ('le', 'la', 'les', 'de', 'des', 'du', 'et', 'un', 'une', 'en') THEN 1.0 ELSE 0.0 END) AS mix_ratio
      FROM trows GROUP BY 1, 2)
SELECT conv_id, turn, round(mix_ratio, 6) AS mix_ratio,
       CAST((mix_ratio >= 0.0)::INT + (mix_ratio >= 0.1)::INT + (mix_ratio >= 0.2)::INT + (mix_ratio >= 0.3)::INT AS BIGINT) AS bucket
FROM r""")
def q_t17(spark, sf):
    wl = spark.createDataFrame([(w,) for w in FRENCH_FUNCTION_WORDS], "token string")
    m = tx.mix_ratio(_turn_rows(spark, sf), ["conv_id", "turn"], wl, [0.0, 0.1, 0.2, 0.3])
    return round_doubles(m)


@register("T18_repetition_report", "WITH " + TURN_TOKS_SQL + """,
chg AS (SELECT conv_id, turn, pos, CASE WHEN lag(token) OVER (PARTITION BY conv_id, turn ORDER BY pos) = token THEN 0 ELSE 1 END AS c
        FROM trows),
isl AS (SELECT conv_id, turn, sum(c) OVER (PARTITION BY conv_id, turn ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM chg),
runs AS (SELECT conv_id, turn, CAST(max(l) AS BIGINT) AS longest_run FROM (SELECT conv_id, turn, run, count(*) AS l FROM isl GROUP BY 1, 2, 3) GROUP BY 1, 2),
d1 AS (SELECT conv_id, turn, count(DISTINCT token) / count(*) AS distinct_1 FROM trows GROUP BY 1, 2),
bi AS (SELECT a.conv_id, a.turn, concat_ws(' ', a.token, b.token) AS g FROM trows a JOIN trows b
       ON a.conv_id = b.conv_id AND a.turn = b.turn AND b.pos = a.pos + 1),
d2 AS (SELECT conv_id, turn, count(DISTINCT g) / count(*) AS distinct_2 FROM bi GROUP BY 1, 2)
SELECT t.conv_id, t.turn, round(distinct_1, 6) AS distinct_1, round(distinct_2, 6) AS distinct_2, coalesce(longest_run, 0) AS longest_run, longest_run IS NULL AS is_empty
FROM toks t LEFT JOIN d1 USING (conv_id, turn) LEFT JOIN d2 USING (conv_id, turn) LEFT JOIN runs USING (conv_id, turn)""")
def q_t18(spark, sf):
    t = table(spark, sf, "conversations").select("conv_id", "turn", tx.tokenize_dialogue("text").alias("tokens"))
    return round_doubles(tx.repetition_report(t, ["conv_id", "turn"], "tokens"))


@register("T19_bag_of_words", "WITH " + TURN_TOKS_SQL + """
SELECT conv_id, turn, token, count(*) AS count FROM trows GROUP BY 1, 2, 3""")
def q_t19(spark, sf):
    return tx.bag_of_words(_turn_rows(spark, sf), ["conv_id", "turn"])


# ------------------------------------------------- generated-text metrics
# hypothesis = the document's tokens with every 7th dropped and every 5th (of the rest) replaced
GEN_SQL = f"""gen AS (
  SELECT doc_id, ref, list_transform(list_filter(ref, lambda x, i: (i - 1) % 7 <> 6),
                                     lambda x, i: CASE WHEN (i - 1) % 5 = 4 THEN 'unk' ELSE x END) AS hyp
  FROM (SELECT doc_id, {SIMPLE_TOKS_SQL.format(t='text')} AS ref FROM documents))"""


def generated(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", simple_tokens("text").alias("ref"))
    hyp = F.transform(F.filter("ref", lambda x, i: i % 7 != 6), lambda x, i: F.when(i % 5 == 4, F.lit("unk")).otherwise(x))
    return d.withColumn("hyp", hyp)


def _grams_sql(side: str, ns: str) -> str:
    return f"""(SELECT doc_id, n, g, count(*) AS cnt FROM (
      SELECT doc_id, n, array_to_string({side}[i:i + n - 1], ' ') AS g
      FROM (SELECT doc_id, {side}, n, unnest(range(1, len({side}) - n + 2)) AS i FROM gen, {ns} AS nn(n)))
    GROUP BY 1, 2, 3)"""


CLIP_SQL = GEN_SQL + f""",
hg AS {_grams_sql('hyp', 'range(1, 5)')},
rg AS {_grams_sql('ref', 'range(1, 5)')},
clip AS (SELECT hg.doc_id, hg.n, hg.cnt, least(hg.cnt, coalesce(rg.cnt, 0)) AS clip
         FROM hg LEFT JOIN rg ON hg.doc_id = rg.doc_id AND hg.n = rg.n AND hg.g = rg.g)"""

BLEU_SQL = CLIP_SQL + """,
m AS (SELECT n, sum(clip) AS match FROM clip GROUP BY n),
t AS (SELECT nn.n, sum(greatest(len(hyp) - nn.n + 1, 0)) AS total FROM gen, range(1, 5) AS nn(n) WHERE len(ref) > 0 GROUP BY nn.n),
p AS (SELECT t.n, coalesce(m.match, 0) AS match, t.total FROM t LEFT JOIN m USING (n)),
l AS (SELECT sum(len(hyp)) AS hyp_len, sum(len(ref)) AS ref_len FROM gen WHERE len(ref) > 0),
bp AS (SELECT hyp_len, ref_len, CASE WHEN hyp_len > ref_len THEN 1.0 WHEN hyp_len = 0 THEN 0.0 ELSE exp(1 - ref_len / hyp_len) END AS bp FROM l)"""


@register("V13_corpus_bleu", "WITH " + BLEU_SQL + """
SELECT round(CASE WHEN (SELECT min(match) FROM p) = 0 THEN 0.0
                  ELSE bp * exp((SELECT sum(ln(match / total)) FROM p) / 4) END, 6) AS bleu,
       round(bp, 6) AS brevity_penalty, CAST(hyp_len AS BIGINT) AS hyp_len, CAST(ref_len AS BIGINT) AS ref_len FROM bp""",
          headline=True)
def q_v13(spark, sf):
    b = tm.corpus_bleu(generated(spark, sf), ["doc_id"])
    return round_doubles(b.select("bleu", "brevity_penalty", F.col("hyp_len").cast("long"), F.col("ref_len").cast("long")))


@register("V14_corpus_bleu_smoothed", "WITH " + BLEU_SQL + """
SELECT round(CASE WHEN (SELECT match FROM p WHERE n = 1) = 0 THEN 0.0
                  ELSE bp * exp((SELECT sum(ln(CASE WHEN match = 0 THEN 0.1 / total ELSE match / total END)) FROM p) / 4) END, 6) AS bleu,
       round(bp, 6) AS brevity_penalty, CAST(hyp_len AS BIGINT) AS hyp_len, CAST(ref_len AS BIGINT) AS ref_len FROM bp""")
def q_v14(spark, sf):
    b = tm.corpus_bleu(generated(spark, sf), ["doc_id"], smooth=0.1)
    return round_doubles(b.select("bleu", "brevity_penalty", F.col("hyp_len").cast("long"), F.col("ref_len").cast("long")))


def _rouge_sql(n: int) -> str:
    return GEN_SQL + f""",
hg AS {_grams_sql('hyp', f'range({n}, {n + 1})')},
rg AS {_grams_sql('ref', f'range({n}, {n + 1})')},
ov AS (SELECT hg.doc_id, sum(least(hg.cnt, coalesce(rg.cnt, 0))) AS overlap
       FROM hg LEFT JOIN rg ON hg.doc_id = rg.doc_id AND hg.g = rg.g GROUP BY 1),
b AS (SELECT doc_id, greatest(len(hyp) - {n} + 1, 0) AS nh, greatest(len(ref) - {n} + 1, 0) AS nr FROM gen),
r AS (SELECT doc_id, CASE WHEN nr = 0 THEN 0.0 ELSE coalesce(overlap, 0) / nr END AS recall,
             CASE WHEN nh = 0 THEN 0.0 ELSE coalesce(overlap, 0) / nh END AS precision FROM b LEFT JOIN ov USING (doc_id))
SELECT doc_id, round(recall, 6) AS recall, round(precision, 6) AS precision,
       round(CASE WHEN recall + precision = 0 THEN 0.0 ELSE 2 * recall * precision / (recall + precision) END, 6) AS f1 FROM r"""


@register("V15_rouge_1", "WITH " + _rouge_sql(1))
def q_v15a(spark, sf):
    return round_doubles(tm.rouge_n(generated(spark, sf), ["doc_id"], 1))


@register("V15_rouge_2", "WITH " + _rouge_sql(2))
def q_v15b(spark, sf):
    return round_doubles(tm.rouge_n(generated(spark, sf), ["doc_id"], 2))


@register("G11_copy_rate_bigrams", "WITH " + GEN_SQL + f""",
hg AS {_grams_sql('hyp', 'range(2, 3)')},
rs AS (SELECT DISTINCT doc_id, g FROM {_grams_sql('ref', 'range(2, 3)')})
SELECT hg.doc_id, round(sum(CASE WHEN rs.g IS NOT NULL THEN hg.cnt ELSE 0 END) / sum(hg.cnt), 6) AS copy_rate
FROM hg LEFT JOIN rs ON hg.doc_id = rs.doc_id AND hg.g = rs.g GROUP BY hg.doc_id""")
def q_g11(spark, sf):
    return round_doubles(tm.copy_rate(generated(spark, sf), ["doc_id"], 2))


@register("G14_qa_token_f1", "WITH " + GEN_SQL + f""",
hg AS {_grams_sql('hyp', 'range(1, 2)')},
rg AS {_grams_sql('ref', 'range(1, 2)')},
c AS (SELECT hg.doc_id, sum(least(hg.cnt, coalesce(rg.cnt, 0))) AS common
      FROM hg LEFT JOIN rg ON hg.doc_id = rg.doc_id AND hg.g = rg.g GROUP BY 1),
b AS (SELECT doc_id, len(hyp) AS np, len(ref) AS ng, CAST(array_to_string(hyp, ' ') = array_to_string(ref, ' ') AS INTEGER) AS exact_match FROM gen),
r AS (SELECT doc_id, exact_match, CASE WHEN np = 0 THEN 0.0 ELSE coalesce(common, 0) / np END AS p,
             CASE WHEN ng = 0 THEN 0.0 ELSE coalesce(common, 0) / ng END AS r FROM b LEFT JOIN c USING (doc_id))
SELECT doc_id, exact_match, round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 6) AS token_f1 FROM r""")
def q_g14(spark, sf):
    return round_doubles(tm.qa_score(generated(spark, sf), ["doc_id"]))


@register("V15_rouge_L")
def q_v15l(spark, sf):
    return round_doubles(tm.rouge_l(generated(spark, sf), ["doc_id"]))


# the length of the longest common subsequence row by row: a cell is the one before both sides plus a match, or the larger of its neighbours
@register("V15_rouge_L_turns", f"""WITH RECURSIVE t AS (SELECT conv_id, turn, {SIMPLE_TOKS_SQL.format(t='text')} AS w FROM conversations),
p AS (SELECT a.conv_id, a.turn, a.w AS hyp, b.w AS ref FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
dp(conv_id, turn, i, cells) AS (
  SELECT conv_id, turn, 0, list_transform(range(0, len(ref) + 1), lambda x: CAST(0 AS BIGINT)) FROM p
  UNION ALL
  SELECT dp.conv_id, dp.turn, i + 1, list_reduce(list_transform(range(1, len(ref) + 1), lambda j: [cells[j], cells[j + 1], CAST(ref[j] = hyp[i + 1] AS BIGINT)]),
    lambda acc, x: list_append(acc, CASE WHEN x[3] = 1 THEN x[1] + 1 ELSE greatest(x[2], acc[-1]) END), [CAST(0 AS BIGINT)])
  FROM dp JOIN p USING (conv_id, turn) WHERE i < len(hyp)),
l AS (SELECT conv_id, turn, arg_max(cells[-1], i) AS lcs FROM dp GROUP BY 1, 2),
r AS (SELECT conv_id, turn, lcs, CASE WHEN len(ref) = 0 THEN 0.0 ELSE lcs / len(ref) END AS recall, CASE WHEN len(hyp) = 0 THEN 0.0 ELSE lcs / len(hyp) END AS precision FROM l JOIN p USING (conv_id, turn))
SELECT conv_id, turn, lcs, round(recall, 6) AS recall, round(precision, 6) AS precision,
       round(CASE WHEN recall + precision = 0 THEN 0.0 ELSE 2 * recall * precision / (recall + precision) END, 6) AS f1 FROM r""")
def q_v15l_turns(spark, sf):
    """Each turn against the one that follows it in its conversation."""
    t = table(spark, sf, "conversations").select("conv_id", "turn", simple_tokens("text").alias("w"))
    nxt = t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("ref"))
    return round_doubles(tm.rouge_l(t.withColumnRenamed("w", "hyp").join(nxt, ["conv_id", "turn"]), ["conv_id", "turn"]))


EXAMPLES_SQL = r"""c AS (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[\r\n]+', ' ', 'g'), '\s+', ' ', 'g')) AS t,
                  CASE role WHEN 'user' THEN '<USR1>' WHEN 'assistant' THEN '<USR2>' WHEN 'system' THEN '<SYS>' END AS tag
           FROM conversations),
h AS (SELECT conv_id, turn, t,
             list(CASE WHEN t <> '' THEN concat_ws(' ', tag, t) END) OVER (PARTITION BY conv_id ORDER BY turn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hist
      FROM c),
ex AS (SELECT conv_id * 100000 + turn AS ex_id, conv_id, array_to_string(list_filter(hist, lambda x: x IS NOT NULL), ' ') AS history, t AS target,
              CAST(('0x' || substring(md5(concat_ws('|', '42', conv_id)), 1, 8))::BIGINT % 10000 AS BIGINT) < 8000 AS is_train
       FROM h WHERE t <> '' AND len(list_filter(hist, lambda x: x IS NOT NULL)) > 0),
tt AS (SELECT ex_id, unnest(regexp_extract_all(lower(history), '[\p{L}\p{N}_]{2,}')) AS term FROM ex WHERE is_train),
ttf AS (SELECT ex_id, term, count(*) AS tf FROM tt GROUP BY 1, 2),
tnd AS (SELECT count(DISTINCT ex_id) AS n FROM tt),
tidf AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM ttf, tnd GROUP BY term, n),
tw AS (SELECT ex_id, term, tf * idf AS w FROM ttf JOIN tidf USING (term)),
tv AS (SELECT ex_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY ex_id)) AS weight FROM tw),
qt AS (SELECT ex_id AS query, unnest(regexp_extract_all(lower(history), '[\p{L}\p{N}_]{2,}')) AS term FROM ex WHERE NOT is_train),
qw AS (SELECT query, term, count(*) * idf AS w FROM qt JOIN tidf USING (term) GROUP BY query, term, idf),
qv AS (SELECT query, term, w / sqrt(sum(w * w) OVER (PARTITION BY query)) AS weight FROM qw),
sc AS (SELECT q.query, t.ex_id, sum(q.weight * t.weight) AS score FROM qv q JOIN tv t USING (term) GROUP BY 1, 2),
pick AS (SELECT query, ex_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, ex_id) AS r FROM sc)
         WHERE r = 1)"""


@register("C12_retrieve_reply", "WITH " + EXAMPLES_SQL + """
SELECT p.query, p.ex_id AS reply_ex_id, round(p.score, 6) AS score, md5(e.target) AS reply_md5
FROM pick p JOIN ex e ON e.ex_id = p.ex_id""")
def q_c12(spark, sf):
    from tessera.operators import retrieval as rt
    c = table(spark, sf, "conversations")
    ex = tx.dialogue_examples(c, "conv_id", "turn", "role", "text", TAGS)
    ex = ex.select((F.col("conv_id") * 100000 + F.col("turn")).alias("ex_id"), "history", "target",
                   (md5_bucket(42, 10000, "conv_id") < 8000).alias("is_train"))
    tf = rt.term_counts(ex.filter("is_train").select("ex_id", F.explode(word_tokens_2("history")).alias("term")), "ex_id")
    q = ex.filter("NOT is_train").select(F.col("ex_id").alias("query"), F.explode(word_tokens_2("history")).alias("term"))
    pick = rt.retrieve(tf, q, 1, doc="ex_id")
    out = pick.join(ex.select("ex_id", F.md5("target").alias("reply_md5")), "ex_id")
    return out.select("query", F.col("ex_id").alias("reply_ex_id"), r6("score").alias("score"), "reply_md5")


def word_tokens_2(col):
    from tessera.functions.exprs import word_tokens
    return word_tokens(col, 2)
