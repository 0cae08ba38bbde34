"""DuckDB SQL for the training-data queries that SQL can express.

The others are held against brute force or held-out accuracy in tests/llm:
XXH64 (op5), patterns with look-around (op4), the fitted language and quality
models (op7, op10) and the recursive median cuts (op8) have no SQL form.
"""

from __future__ import annotations

from tessera.llm.licences import TEMPLATES, THRESHOLD
from tessera.llm.outliers import BOUND, STEPS, WIDEN

_OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(deg.n, 0)::BIGINT AS n_links, comp.component_id, v.vec_id = comp.component_id AS kept
FROM v JOIN comp ON comp.a = v.vec_id LEFT JOIN deg ON deg.a = v.vec_id
"""

# an alignment with at most one in five tokens differing always has two equal tokens in a row
_OP2 = r"""
WITH it AS (
  SELECT DISTINCT item_id, t FROM (
    SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL) WHERE len(t) >= 5),
dt AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t FROM documents WHERE text IS NOT NULL),
i1 AS (SELECT item_id, len(t) AS n, unnest(t) AS w, generate_subscripts(t, 1) - 1 AS p FROM it),
d1 AS (SELECT doc_id, len(t) AS n, unnest(t) AS w, generate_subscripts(t, 1) - 1 AS p FROM dt),
i2 AS (SELECT *, lead(w) OVER (PARTITION BY item_id ORDER BY p) AS nxt FROM i1),
d2 AS (SELECT *, lead(w) OVER (PARTITION BY doc_id ORDER BY p) AS nxt FROM d1),
diag AS (
  SELECT DISTINCT d2.doc_id, i2.item_id, d2.p - i2.p AS diag FROM d2 JOIN i2 ON d2.w = i2.w AND d2.nxt = i2.nxt),
aligned AS (
  SELECT g.doc_id, g.item_id, g.diag, i1.p AS ip, least(13, i1.n) AS width, (d1.w = i1.w)::INT AS same
  FROM diag g JOIN i1 ON i1.item_id = g.item_id JOIN d1 ON d1.doc_id = g.doc_id AND d1.p = i1.p + g.diag),
scored AS (
  SELECT doc_id, item_id, diag, ip, width,
    list_sum((list(same) OVER (PARTITION BY doc_id, item_id, diag ORDER BY ip ROWS BETWEEN 12 PRECEDING AND CURRENT ROW))[-width:]) AS n,
    row_number() OVER (PARTITION BY doc_id, item_id, diag ORDER BY ip) AS k
  FROM aligned),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n DESC, ip + diag, ip) AS r
  FROM scored WHERE k >= width AND n >= width * 0.8 - 1e-9)
SELECT doc_id, item_id, width::BIGINT AS n_tokens, n::BIGINT AS n_match, n / width AS similarity,
  (ip - width + 1 + diag)::BIGINT AS doc_pos, (ip - width + 1)::BIGINT AS item_pos
FROM best WHERE r = 1
"""
_OP3 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    CASE WHEN doc_id IS NOT NULL AND count(*) OVER (PARTITION BY doc_id) = 1 THEN doc_id::VARCHAR
      ELSE coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || '|' || coalesce('s' || source, '') || '|' || row_number() OVER (PARTITION BY doc_id, coalesce(text, ''), source) END AS draw_key FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, CASE i % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 2.0::DOUBLE * source_size AS cap FROM s),
r AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
    sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, sum(source_size) OVER () AS total FROM w),
level AS (
  SELECT (total::DOUBLE * 1.5::DOUBLE - given) / open AS level FROM r WHERE (total::DOUBLE * 1.5::DOUBLE - given) / open <= cap / w ORDER BY cap / w, i LIMIT 1),
t AS (SELECT source, source_size, least(w * level, cap) AS target FROM w, level),
m AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix|' || d.draw_key), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * (floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT) AS taken FROM m
"""

_OP6 = r"""
WITH c AS (SELECT conv_id, coalesce(turn, -1) AS turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
last AS (
  SELECT conv_id, turn AS last_turn, text AS last_text FROM (
    SELECT conv_id, turn, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, coalesce(text, '') DESC) AS r
    FROM c WHERE role = 'assistant') WHERE r = 1),
ring AS (SELECT *, row_number() OVER (ORDER BY conv_id) - 1 AS i, count(*) OVER () AS n FROM last),
swap AS (SELECT a.conv_id, a.last_turn, a.last_text, b.last_text AS donor_text FROM ring a JOIN ring b ON b.i = (a.i + 1) % a.n),
t AS (
  SELECT c.conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM c JOIN swap USING (conv_id)
  UNION ALL
  SELECT c.conv_id, 'rejected', turn, role,
    CASE WHEN turn = last_turn AND role = 'assistant' AND coalesce(text, '') = last_text THEN donor_text ELSE text END
  FROM c JOIN swap USING (conv_id)),
pos AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos FROM t),
place AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.pos, b.pos) AS pos,
    a.pos IS NULL OR b.pos IS NULL OR a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text AS differs
  FROM (SELECT * FROM pos WHERE side = 'chosen') a FULL JOIN (SELECT * FROM pos WHERE side = 'rejected') b ON a.pair_id = b.pair_id AND a.pos = b.pos),
over AS (SELECT pair_id, coalesce(min(CASE WHEN differs THEN pos END), max(pos) + 1) AS over_at FROM place GROUP BY pair_id),
seg AS (
  SELECT pair_id, CASE WHEN pos < over_at THEN 'prompt' ELSE side END AS part, CASE WHEN pos < over_at THEN pos ELSE pos - over_at + 1 END AS seq,
    '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS rendered,
    CASE WHEN pos >= over_at AND role = 'assistant' THEN length(coalesce(text, '')) + 8 ELSE 0 END AS trained
  FROM pos JOIN over USING (pair_id) WHERE pos >= over_at OR side = 'chosen')
SELECT pair_id, coalesce(sum(1) FILTER (part = 'prompt'), 0)::BIGINT AS prompt_turns, coalesce(sum(1) FILTER (part = 'chosen'), 0)::BIGINT AS chosen_turns,
  coalesce(sum(1) FILTER (part = 'rejected'), 0)::BIGINT AS rejected_turns, coalesce(sum(length(rendered)) FILTER (part = 'prompt'), 0)::BIGINT AS prompt_chars,
  coalesce(sum(length(rendered)) FILTER (part = 'chosen'), 0)::BIGINT AS chosen_chars, coalesce(sum(length(rendered)) FILTER (part = 'rejected'), 0)::BIGINT AS rejected_chars,
  coalesce(sum(trained) FILTER (part = 'chosen'), 0)::BIGINT AS chosen_trained, coalesce(sum(trained) FILTER (part = 'rejected'), 0)::BIGINT AS rejected_trained,
  sum(('0x' || substr(md5(part || '|' || seq || '|' || rendered), 1, 8))::BIGINT)::BIGINT AS checksum
FROM seg GROUP BY pair_id
"""

_VALUES = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in TEMPLATES)
_GRAMS = "CASE WHEN len(t) > 1 THEN list_distinct(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) ELSE t END"
_OP9 = rf"""
WITH tpl AS (
  SELECT DISTINCT license_id, {_GRAMS} AS tb FROM (
    SELECT license_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS t FROM (VALUES {_VALUES}) v(license_id, text))),
lines AS (SELECT doc_id, 0 AS kind, generate_subscripts(l, 1) - 1 AS place, unnest(l) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
parts AS (SELECT doc_id, 1 AS kind, generate_subscripts(l, 1) - 1 AS place, unnest(l) AS text FROM (SELECT doc_id, string_split_regex(text, '\n[ \t\r]*\n') AS l FROM documents)),
units AS (
  SELECT * FROM lines UNION ALL SELECT * FROM parts WHERE contains(text, chr(10))
  UNION ALL SELECT doc_id, 2, 0, text FROM documents WHERE regexp_matches(text, '\n[ \t\r]*\n')),
grams AS (
  SELECT doc_id, kind, place, {_GRAMS} AS ub FROM (
    SELECT *, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS t FROM units)),
dice AS (
  SELECT doc_id, license_id, kind, place, 2 * len(list_intersect(ub, tb)) / (len(ub) + len(tb)) AS dice
  FROM grams JOIN tpl ON len(ub) BETWEEN len(tb) * {THRESHOLD / (2 - THRESHOLD)} - 1e-9 AND len(tb) * {(2 - THRESHOLD) / THRESHOLD} + 1e-9),
hit AS (SELECT doc_id, license_id, kind, place, dice, 0 AS n FROM dice WHERE dice >= {THRESHOLD} - 1e-12),
twords AS (
  SELECT DISTINCT license_id, len(t) AS words, {_GRAMS} AS tb FROM (
    SELECT license_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS t FROM (VALUES {_VALUES}) v(license_id, text)) WHERE len(t) > 1),
dtok AS (SELECT row_number() OVER () AS id, doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS t FROM documents WHERE text IS NOT NULL),
dgram AS (SELECT id, doc_id, len(t) AS n, i AS place, t[i + 1] || ' ' || t[i + 2] AS g FROM (SELECT *, unnest(range(0, len(t) - 1)) AS i FROM dtok)),
begun AS (SELECT dgram.id, dgram.doc_id, dgram.place, license_id, words, tb FROM dgram JOIN (SELECT *, unnest(tb) AS g FROM twords) USING (g)),
win AS (
  SELECT b.id, b.doc_id, b.place, license_id, words, tb, list_distinct(list_transform(range(b.place + 1, least(b.place + words, len(t))), lambda i: t[i] || ' ' || t[i + 1])) AS ub
  FROM begun b JOIN dtok USING (id)),
good AS (
  SELECT *, 2 * len(list_intersect(ub, tb)) / (len(ub) + len(tb)) AS dice FROM win WHERE 2 * len(list_intersect(ub, tb)) / (len(ub) + len(tb)) >= {THRESHOLD} - 1e-12),
chain AS (SELECT *, coalesce(place - lag(place) OVER (PARTITION BY id, license_id, tb ORDER BY place) >= words, TRUE) AS fresh FROM good),
passage AS (SELECT doc_id, license_id, arg_max(place, (dice, -place)) AS place, max(dice) AS dice, sum(fresh::INT) AS n FROM chain GROUP BY id, doc_id, license_id, tb),
every AS (SELECT * FROM hit UNION ALL SELECT doc_id, license_id, 3, place, dice, n FROM passage),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license_id ORDER BY dice DESC, kind, place) AS r FROM every)
SELECT doc_id, license_id, max(dice) AS dice, max(CASE WHEN r = 1 THEN CASE kind WHEN 0 THEN 'line' WHEN 1 THEN 'paragraph' WHEN 2 THEN 'text' ELSE 'passage' END END) AS unit,
  max(CASE WHEN r = 1 THEN place END)::BIGINT AS place, count(DISTINCT CASE WHEN kind < 3 THEN (kind, place) END)::BIGINT AS n_units, max(n)::BIGINT AS n_passages
FROM ranked GROUP BY doc_id, license_id
"""

_OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS MATERIALIZED (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
gt AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
gp AS MATERIALIZED (
  SELECT gt.lang, gt.source, k.term, coalesce(c.n, 0) AS n, (1 + 1000000000 * (coalesce(c.n, 0) + 2) // (total + 2 * v))::BIGINT AS p
  FROM gt JOIN v USING (lang) JOIN kept k USING (lang) LEFT JOIN c ON c.lang = gt.lang AND c.source = gt.source AND c.term = k.term),
lt AS (SELECT lang, sum(total) AS total FROM gt GROUP BY lang),
lp AS (SELECT c.lang, c.term, (1 + 1000000000 * (sum(n) + 2) // (any_value(total) + 2 * any_value(v)))::BIGINT AS q
  FROM c JOIN lt USING (lang) JOIN v USING (lang) GROUP BY c.lang, c.term),
pv AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# books c0 (seeds), c1, c2; assignments a0, a1 (rounds) and a2 (final)
_NEAREST = """a{i} AS MATERIALIZED (
  SELECT vec_id, label, x.part, x.v, arg_min(entry, (list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), entry)) AS entry,
    min(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))::BIGINT AS d
  FROM x JOIN c{i} c ON c.part = x.part GROUP BY ALL)"""
_UPDATE = """l{j} AS (SELECT part, entry, unnest(v) AS v, unnest(range(1, len(v) + 1)) AS j FROM a{i}),
m{j} AS (SELECT part, entry, j, sum(v)::BIGINT AS s, count(*)::BIGINT AS n FROM l{j} GROUP BY ALL),
n{j} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM m{j} GROUP BY ALL),
c{j} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(n{j}.v, c.v) AS v FROM c{i} c LEFT JOIN n{j} ON n{j}.part = c.part AND n{j}.entry = c.entry)"""
_OP12 = f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda e: floor(e::DOUBLE * 256)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (
  SELECT vec_id, label, p AS part, e[p * len(e) // 16 + 1:(p + 1) * len(e) // 16] AS v FROM (SELECT *, unnest(range(16)) AS p FROM k)),
seed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT 64),
c0 AS MATERIALIZED (SELECT part, entry, v FROM x JOIN seed USING (vec_id)),
{_NEAREST.format(i=0)},
{_UPDATE.format(i=0, j=1)},
{_NEAREST.format(i=1)},
{_UPDATE.format(i=1, j=2)},
{_NEAREST.format(i=2)},
book AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2),
r AS (SELECT vec_id, label, lower(string_agg(printf('%02x', entry), '' ORDER BY part)) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM r, book
"""

def _moments(n: str = "count(*)", x=lambda i: f"x[{i + 1}]") -> str:
    return ", ".join([f"{n}::DOUBLE AS n", *[f"sum({x(i)})::DOUBLE AS s{i}" for i in range(5)],
                      *[f"sum({x(i)}::HUGEINT * {x(j)})::DOUBLE AS q{i}{j}" for i in range(5) for j in range(i, 5)]])


_AGAIN = ", ".join(["sum(n) AS n", *[f"sum(s{i}) AS s{i}" for i in range(5)], *[f"sum(q{i}{j}) AS q{i}{j}" for i in range(5) for j in range(i, 5)]])
_MEAN = [f"s{i} / n / 1024" for i in range(5)]


def _inverted(src: str, out: str, mean: list[str], cov) -> str:
    """CTEs that turn ``src`` (key, start, ..) into ``out`` (key, start, m, inv, ld): every pivot of the covariance is swept once."""
    cell = lambda i, j: f"({cov(min(i, j), max(i, j))}) + {(0.25, 0.0225, 0.25, 1.0, 1.0)[i] if i == j else 0.0}"
    parts = [f"{out}0 AS (SELECT key, start, [{', '.join(mean)}]::DOUBLE[] AS m, [{', '.join(cell(i, j) for i in range(5) for j in range(5))}]::DOUBLE[] AS a, 0.0::DOUBLE AS ld FROM {src})"]
    for k in range(5):
        pivot = f"a[{6 * k + 1}]"
        parts.append(f"""{out}{k + 1} AS (SELECT key, start, m, list_transform(a, lambda v, ij: CASE WHEN (ij - 1) // 5 = {k} AND (ij - 1) % 5 = {k} THEN -1 / {pivot}
  WHEN (ij - 1) // 5 = {k} OR (ij - 1) % 5 = {k} THEN v / {pivot} ELSE v - a[(ij - 1) // 5 * 5 + {k + 1}] * a[{5 * k + 1} + (ij - 1) % 5] / {pivot} END) AS a, ld + ln({pivot}) AS ld FROM {out}{k})""")
    return ",\n".join(parts) + f",\n{out} AS MATERIALIZED (SELECT key, start, m, list_transform(a, lambda v: -v) AS inv, ld FROM {out}5)"


_DEV = [f"(x[{i + 1}] / 1024.0::DOUBLE - m[{i + 1}])" for i in range(5)]
_FAR = " + ".join(f"{_DEV[i]} * {_DEV[j]} * inv[{5 * i + j + 1}]{'' if i == j else ' * 2'}" for i in range(5) for j in range(i, 5))
_COV = lambda widen: lambda i, j: f"(q{i}{j} / n / 1024 / 1024 - ({_MEAN[i]}) * ({_MEAN[j]})) * {widen!r}"


def _nearest(i: int) -> str:
    """One concentration step: the rows in the nearest whole bins that make up three quarters, estimated anew."""
    return f"""b{i} AS (SELECT key, start, bin, any_value(key_n) AS key_n, {_moments()} FROM (
  SELECT key, start, key_n, x, floor(log2({_FAR} + 1 / 1024.0::DOUBLE) * 8) AS bin FROM r JOIN z{i} USING (key)) GROUP BY key, start, bin),
k{i} AS (SELECT key, start, {_AGAIN} FROM (SELECT *, sum(n) OVER (PARTITION BY key, start ORDER BY bin) - n AS before FROM b{i}) WHERE before < ceil(key_n * 0.75) GROUP BY key, start),
""" + _inverted(f"k{i}", f"z{i + 1}", _MEAN, _COV(WIDEN))


_OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM d),
win AS (SELECT id, i, md5(array_to_string(w[i + 1:i + 8], ' ')) AS g FROM (SELECT id, w, unnest(range(0, len(w) - 7)) AS i FROM w WHERE len(w) >= 8)),
dup AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT id, sum(least(8, coalesce(nxt - i, 8))) AS r FROM (SELECT id, i, lead(i) OVER (PARTITION BY id ORDER BY i) AS nxt FROM dup) GROUP BY id),
st AS (
  SELECT id, doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(ln) AS n_lines, len(ln) - len(list_distinct(ln)) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words FROM w LEFT JOIN cov USING (id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM st),
v AS MATERIALIZED (
  SELECT *, CASE WHEN NOT base_failed THEN list_transform([ln(1 + n_words), ln(word_chars / n_words), ln(1 + 100 * n_symbols / n_words), ln(1 + 100 * n_dup_lines / n_lines), ln(1 + 100 * n_repeat_words / n_words)],
    lambda y: round(y * 1024)::BIGINT) END AS x FROM f),
g0 AS (SELECT lang, source, count(*) AS n FROM v WHERE x IS NOT NULL GROUP BY ALL),
g1 AS (SELECT *, CASE WHEN n >= 100 THEN 'a' || coalesce('v' || lang, 'n') || '|' || coalesce('v' || source, 'n') ELSE 'b' || coalesce('v' || lang, 'n') END AS k1 FROM g0),
g2 AS (SELECT *, CASE WHEN sum(n) OVER (PARTITION BY k1) < 100 THEN 'c' ELSE k1 END AS key FROM g1),
g AS (SELECT lang, source, key, sum(n) OVER (PARTITION BY key) AS key_n FROM g2),
r AS MATERIALIZED (SELECT key, key_n, x FROM v JOIN g ON v.lang IS NOT DISTINCT FROM g.lang AND v.source IS NOT DISTINCT FROM g.source WHERE x IS NOT NULL AND key_n >= 100),
""" + f"pm AS (SELECT key, 0 AS start, {_moments()} FROM r GROUP BY key),\n" + _inverted("pm", "p", _MEAN, _COV(1.0)) + r""",
val AS (SELECT key, dim, y, count(*) AS c FROM (SELECT key, unnest(x) AS y, unnest(range(0, 5)) AS dim FROM r) GROUP BY ALL),
cum AS (SELECT *, sum(c) OVER (PARTITION BY key, dim ORDER BY y) AS upto, sum(c) OVER (PARTITION BY key, dim) AS n FROM val),
quart AS (SELECT key, dim, min(CASE WHEN upto >= n * 0.5 THEN y END) / 1024.0::DOUBLE AS m, (min(CASE WHEN upto >= n * 0.75 THEN y END) / 1024.0::DOUBLE - min(CASE WHEN upto >= n * 0.25 THEN y END) / 1024.0::DOUBLE) / 1.349 AS s FROM cum GROUP BY key, dim),
""" + f"ro AS (SELECT key, 1 AS start, {', '.join(f'max(CASE WHEN dim = {i} THEN m END) AS m{i}, max(CASE WHEN dim = {i} THEN s END) AS d{i}' for i in range(5))} FROM quart GROUP BY key),\n" + _inverted(
    "ro", "o", [f"m{i}" for i in range(5)], lambda i, j: f"d{i} * d{i}" if i == j else "0.0") + ",\nz0 AS MATERIALIZED (SELECT * FROM p UNION ALL SELECT * FROM o),\n" + ",\n".join(_nearest(i) for i in range(STEPS)) + f""",
best AS (SELECT key, arg_min(m, (ld, start)) AS m, arg_min(inv, (ld, start)) AS inv FROM z{STEPS} GROUP BY key),
e AS (SELECT g.lang, g.source, m, inv FROM g JOIN best USING (key))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce({_FAR} <= {BOUND!r}, TRUE) AS kept
FROM v LEFT JOIN e ON v.lang IS NOT DISTINCT FROM e.lang AND v.source IS NOT DISTINCT FROM e.source
"""

ORACLES: dict[str, str] = {"op1_embedding_neardup": _OP1, "op2_decontamination": _OP2, "op3_mixing": _OP3, "op6_preference": _OP6, "op9_licences": _OP9,
                           "op11_source_divergence": _OP11, "op12_vector_codes": _OP12,
                           "op13_quality_rules": _OP13}
