"""Annotated source files derived from documents.

Each line of a document becomes a line of code by its md5: a directive with
clauses, a loop, or a plain statement; so files, lines and annotations grow
with the table and SQL can state them too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import corpus as co
from tessera.plans.common import round_doubles
from tessera.plans.registry import register
from tessera.sources.tables import table

#: The clauses that the derived directives carry, by number.
CLAUSE_TEXTS = ["private(i)", "reduction(+:s) private(j)", "schedule(static)", "", "firstprivate(a) shared(b)", "collapse(2) reduction(max:m)"]

_CLAUSE_SQL = "[" + ", ".join(f"'{x}'" for x in CLAUSE_TEXTS) + "]"
LINES_SQL = f"""raw AS (SELECT doc_id AS file, generate_subscripts(l, 1) AS line_no, unnest(l) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
num AS (SELECT *, ('0x' || substring(md5(concat_ws('|', file, line_no, t)), 1, 8))::BIGINT AS h FROM raw),
lines AS (SELECT file, line_no, h, CASE h % 5 WHEN 0 THEN '#pragma omp parallel for ' || {_CLAUSE_SQL}[h // 5 % 6 + 1] WHEN 1 THEN '  for (i = 0; i < n; i++) {{' WHEN 2 THEN 'for(;;)' ELSE 'x += ' || length(t) || ';' END AS line FROM num),
mark AS (SELECT *, h % 5 = 0 AS is_pragma, h % 5 IN (1, 2) AS is_loop,
                last_value(CASE WHEN h % 5 < 3 THEN {{'line_no': line_no, 'p': h % 5 = 0, 'line': line}} END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM lines),
lab AS (SELECT file, CAST(line_no AS INTEGER) AS loop_line, trim(line) AS loop, CASE WHEN prev.p THEN CAST(prev.line_no AS INTEGER) END AS pragma_line, CASE WHEN prev.p THEN trim(prev.line) END AS pragma FROM mark WHERE is_loop),
cl AS (SELECT *, list_sort(list_distinct(regexp_extract_all(coalesce(pragma, ''), '\\b(private|firstprivate|lastprivate|shared|reduction|schedule|collapse|nowait)\\s*\\(', 1))) AS clauses FROM lab),
pat AS (SELECT *, CASE WHEN pragma IS NULL THEN 'NONE' WHEN len(clauses) = 0 THEN 'PLAIN' ELSE upper(array_to_string(clauses, '+')) END AS pattern FROM cl)"""


def lines(spark, sf):
    d = table(spark, sf, "documents").filter("text is not null").select(F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "t"))
    d = d.withColumn("line_no", F.col("pos") + 1)
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("file").cast("string"), F.col("line_no").cast("string"), "t")), 1, 8), 16, 10).cast("long")
    d = d.withColumn("h", h)
    clause = F.get(F.array(*[F.lit(x) for x in CLAUSE_TEXTS]), (F.floor(F.col("h") / 5) % 6).cast("int"))
    line = (F.when(F.col("h") % 5 == 0, F.concat(F.lit("#pragma omp parallel for "), clause)).when(F.col("h") % 5 == 1, "  for (i = 0; i < n; i++) {")
            .when(F.col("h") % 5 == 2, "for(;;)").otherwise(F.concat(F.lit("x += "), F.char_length("t").cast("string"), F.lit(";"))))
    return d.select("file", "line_no", line.alias("line"))


@register("X05_loop_labels", "WITH " + LINES_SQL + " SELECT file, loop_line, loop, coalesce(pragma_line, 0) AS pragma_line, coalesce(pragma, '') AS pragma FROM lab")
def q_x05(spark, sf):
    return co.extract_labels(lines(spark, sf)).fillna({"pragma_line": 0, "pragma": ""})  # a loop without a directive: line 0


@register("X06_clause_labels", "WITH " + LINES_SQL + """
SELECT file, loop_line, pattern, array_to_string(clauses, ',') AS clauses, CAST(list_contains(clauses, 'private') AS INTEGER) AS has_private,
       CAST(list_contains(clauses, 'reduction') AS INTEGER) AS has_reduction FROM pat""")
def q_x06(spark, sf):
    c = co.clause_labels(co.extract_labels(lines(spark, sf)))
    return c.select("file", "loop_line", "pattern", F.array_join("clauses", ",").alias("clauses"), "has_private", "has_reduction")


@register("X07_annotation_stats", "WITH " + LINES_SQL + """
SELECT 'file' AS kind, CAST(file AS VARCHAR) AS name, count(*) AS n, round(count(pragma) / count(*), 6) AS share FROM pat GROUP BY file
UNION ALL SELECT 'pattern', pattern, count(*), round(count(*) / (SELECT count(*) FROM pat), 6) FROM pat GROUP BY pattern""")
def q_x07(spark, sf):
    from tessera.functions.rows import attach_row
    from tessera.session import cut_lineage
    c = cut_lineage(co.clause_labels(co.extract_labels(lines(spark, sf))).select("file", "pragma", "pattern"))
    files, patterns = co.annotation_stats(c)
    files = files.select(F.lit("file").alias("kind"), F.col("file").cast("string").alias("name"), F.col("n_loops").alias("n"), F.col("share_annotated").alias("share"))
    patterns = attach_row(patterns, c.agg(F.count(F.lit(1)).alias("a"))).select(F.lit("pattern").alias("kind"), F.col("pattern").alias("name"), F.col("count").alias("n"), (F.col("count") / F.col("a")).alias("share"))
    return round_doubles(files.unionByName(patterns))


@register("V26_clause_match", "WITH " + LINES_SQL + f""",
pr AS (SELECT pragma AS ref, CASE loop_line % 4 WHEN 0 THEN pragma WHEN 1 THEN replace(pragma, 'for ', 'for  ') WHEN 2 THEN replace(pragma, '(', ' ( ') ELSE '#pragma omp parallel for private(i)' END AS pred FROM lab WHERE pragma IS NOT NULL),
n AS (SELECT trim(regexp_replace(lower(ref), '\\s+', ' ', 'g')) AS r, trim(regexp_replace(lower(pred), '\\s+', ' ', 'g')) AS p,
             list_sort(list_transform(list_distinct(regexp_extract_all(lower(ref), '\\b(?:private|firstprivate|lastprivate|shared|reduction|schedule|collapse|nowait)\\s*\\([^)]*\\)')), lambda x: regexp_replace(x, '\\s+', '', 'g'))) AS rs,
             list_sort(list_transform(list_distinct(regexp_extract_all(lower(pred), '\\b(?:private|firstprivate|lastprivate|shared|reduction|schedule|collapse|nowait)\\s*\\([^)]*\\)')), lambda x: regexp_replace(x, '\\s+', '', 'g'))) AS ps FROM pr)
SELECT round(avg((r = p)::INT), 6) AS exact_rate, round(avg((rs = ps)::INT), 6) AS normalised_rate, """ + ", ".join(
    f"round(avg(((len(list_filter(rs, lambda x: starts_with(x, '{c}' || chr(40)))) > 0) = (len(list_filter(ps, lambda x: starts_with(x, '{c}' || chr(40)))) > 0))::INT), 6) AS acc_{c}"
    for c in co.CLAUSES) + " FROM n")
def q_v26(spark, sf):
    """Directives against copies with other spacing, and against one fixed guess."""
    lab = co.extract_labels(lines(spark, sf)).filter("pragma is not null")
    k = F.col("loop_line") % 4
    pred = (F.when(k == 0, F.col("pragma")).when(k == 1, F.replace("pragma", F.lit("for "), F.lit("for  "))).when(k == 2, F.replace("pragma", F.lit("("), F.lit(" ( ")))
            .otherwise(F.lit("#pragma omp parallel for private(i)")))
    return round_doubles(co.clause_match_report(co.clause_match(lab.select(F.col("pragma").alias("ref"), pred.alias("pred")), "pred", "ref")))
