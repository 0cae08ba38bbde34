"""Annotation labels from a source corpus read as text (X05-X07). Regex only, no C parser.

Each file is one row (``wholetext``), split into numbered lines; an
annotation line (``#pragma omp ...``) governs the next loop line of the same
file (``lead``-style search by a window over that file's lines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The directive pattern, the loop pattern and the clause names.
PRAGMA_PATTERN = r"^\s*#\s*pragma\s+omp\b"
LOOP_PATTERN = r"^\s*for\s*\("
CLAUSES = ["private", "firstprivate", "lastprivate", "shared", "reduction", "schedule", "collapse", "nowait"]


def read_source_lines(spark: SparkSession, glob: str) -> DataFrame:
    """(file, line_no, line) for every line of every file (1-based line numbers)."""
    raw = spark.read.text(glob, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return raw.select("file", F.posexplode(F.split("value", "\n")).alias("pos", "line")).select(
        "file", (F.col("pos") + 1).alias("line_no"), "line")


def extract_labels(lines: DataFrame) -> DataFrame:
    """Every loop line with the annotation governing it (the closest directive above it with no
    other loop in between), or null when unannotated. Output (file, loop_line, loop, pragma_line, pragma)."""
    d = lines.withColumn("is_pragma", F.col("line").rlike(PRAGMA_PATTERN)).withColumn(
        "is_loop", F.col("line").rlike(LOOP_PATTERN))
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    marker = F.when(F.col("is_pragma") | F.col("is_loop"), F.struct("line_no", "is_pragma", "line"))
    d = d.withColumn("__prev", F.last(marker, ignorenulls=True).over(w))
    loops = d.filter("is_loop")
    governed = F.col("__prev").isNotNull() & F.col("__prev.is_pragma")
    return loops.select("file", F.col("line_no").alias("loop_line"), F.trim("line").alias("loop"),
                        F.when(governed, F.col("__prev.line_no")).alias("pragma_line"),
                        F.when(governed, F.trim(F.col("__prev.line"))).alias("pragma"))


def clause_labels(labels: DataFrame) -> DataFrame:
    """Multi-label clause flags of each annotation and the combined pattern (e.g. PRIVATE+REDUCTION)."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("pragma", F.lit(""))),
                                                  F.lit(r"\b(" + "|".join(CLAUSES) + r")\s*\("), 1))
    d = labels.withColumn("clauses", F.array_sort(found))
    for c in CLAUSES:
        d = d.withColumn(f"has_{c}", F.array_contains("clauses", c).cast("int"))
    return d.withColumn("pattern", F.when(F.col("pragma").isNull(), F.lit("NONE")).when(
        F.size("clauses") == 0, F.lit("PLAIN")).otherwise(F.upper(F.array_join("clauses", "+"))))


def annotation_stats(clauses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per file loops / annotated / share, and the frequency of each clause pattern."""
    per_file = clauses.groupBy("file").agg(F.count(F.lit(1)).alias("n_loops"),
                                           F.count("pragma").alias("n_annotated")).withColumn(
        "share_annotated", F.col("n_annotated") / F.col("n_loops"))
    patterns = clauses.groupBy("pattern").agg(F.count(F.lit(1)).alias("count"))
    return per_file, patterns


def _clause_set(col):
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))),
                                                              F.lit(r"\b(" + "|".join(CLAUSES) + r")\s*\([^)]*\)"), 0)))


def clause_match(df: DataFrame, pred: str, ref: str) -> DataFrame:
    """Exact match (whitespace-normalised), normalised match (order-free clause set, spaces removed)
    and per-clause presence agreement of a predicted directive against the reference."""
    norm = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(c), F.lit(""))), r"\s+", " "))
    strip = lambda a: F.transform(a, lambda x: F.regexp_replace(x, r"\s+", ""))
    ps, rs = strip(_clause_set(F.col(pred))), strip(_clause_set(F.col(ref)))
    d = df.withColumn("exact", (norm(pred) == norm(ref)).cast("int")).withColumn(
        "normalised", (F.array_sort(ps) == F.array_sort(rs)).cast("int"))
    for c in CLAUSES:
        has = lambda a, c=c: F.exists(a, lambda x: x.startswith(c + "("))
        d = d.withColumn(f"agree_{c}", (has(ps) == has(rs)).cast("int"))
    return d


def clause_match_report(matched: DataFrame) -> DataFrame:
    """V26 summary: exact and normalised match rates and per-clause accuracy."""
    return matched.agg(F.avg("exact").alias("exact_rate"), F.avg("normalised").alias("normalised_rate"),
                       *[F.avg(f"agree_{c}").alias(f"acc_{c}") for c in CLAUSES])
