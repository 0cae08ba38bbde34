"""Projection, predicates and small row-wise helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_prefix(df: DataFrame, prefixes: list[str], keep: list[str] | None = None) -> DataFrame:
    """Columns whose name starts with any prefix (feature families)."""
    cols = [c for c in df.columns if any(c.startswith(p) for p in prefixes)]
    return df.select(*(keep or []), *cols)


def split_xy(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Features without the target, and the target alone."""
    return df.drop(label), df.select(label)


def case_when(conds: list[tuple[Column, object]], default) -> Column:
    """First matching condition wins, else the default label."""
    e = None
    for cond, val in conds:
        e = F.when(cond, F.lit(val)) if e is None else e.when(cond, F.lit(val))
    return e.otherwise(F.lit(default))


def fill_missing(df: DataFrame, cols: list[str], value: str = "MISSING") -> DataFrame:
    """Null -> constant, then the column as string (categorical missing = own category)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in cols})


def dropna_subset(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows null in any of the given columns."""
    return df.na.drop(subset=cols)


def indicator(cond: Column) -> Column:
    """Boolean predicate as 0/1 integer."""
    return cond.cast("int")


def predict(df: DataFrame, t: float, score: str = "score", out: str = "pred") -> DataFrame:
    """Threshold a score, ``score >= t``."""
    return df.withColumn(out, indicator(F.col(score) >= F.lit(t)))
