"""Reusable Column expressions.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen (or Spark's interpreted higher-order
functions for arrays) and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "c", "md5_order", "md5_bucket", "safe_div", "dot", "l2_norm", "scale_array",
    "WORD", "word_tokens", "simple_tokens", "word_ngrams", "char_ngrams",
    "collapse_spaces", "r6", "r6_ieee", "r6_robust",
]

# Fixed value: the word-character class used for tokenising. Java regex and
# RE2 agree on it (Python's ``\w`` minus combining marks), accents included.
WORD = r"[\p{L}\p{N}_]"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def r6(x) -> Column:
    """Round to 6 places, the cross-engine comparison precision, tie-safely (see ``r6_robust``)."""
    return r6_robust(x)


def r6_ieee(x) -> Column:
    """Round half up to 6 places with plain IEEE ops, ``floor(x * 1e6 + 0.5) / 1e6``.

    Spark's ``round`` rounds the exact decimal expansion of a double while
    other engines round the scaled double, so values that sit on a tie (linear
    blends of short decimals) can round apart; this form is identical anywhere.
    """
    return F.floor(c(x) * 1000000 + 0.5) / 1000000


def r6_robust(x) -> Column:
    """Tie-safe 6-place rounding of an aggregate: ``floor(round(x, 9) * 1e6 + 0.5) / 1e6``.

    A mean of short decimals can sit exactly on a 7th-digit tie, and its
    float sum lands a hair above or below the tie depending on summation
    order; rounding to 9 places first removes that noise, and the IEEE form
    rounds the half the same way in every engine.
    """
    return F.floor(F.round(c(x), 9) * 1000000 + 0.5) / 1000000


def md5_order(seed, *cols) -> Column:
    """Deterministic pseudo-random sort key: md5 of ``seed|c1|c2...``.

    The same string is produced by DuckDB's ``md5(concat_ws('|', ...))`` so
    every split and sample has an exact SQL oracle. Use integer/string keys.
    """
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c(x).cast("string") for x in cols]))


def md5_bucket(seed, n: int, *cols) -> Column:
    """Deterministic bucket 0..n-1 from the first 8 hex digits of md5."""
    h = F.conv(F.substring(md5_order(seed, *cols), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(n))


def safe_div(a, b, default=0.0) -> Column:
    a, b = c(a), c(b)
    return F.when(b == 0, F.lit(default)).otherwise(a / b)


def dot(a, b) -> Column:
    """Dot product of two equal-length numeric arrays."""
    return F.aggregate(F.zip_with(c(a), c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(c(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def scale_array(a, s) -> Column:
    return F.transform(c(a), lambda x: x.cast("double") * c(s))


def collapse_spaces(x) -> Column:
    return F.trim(F.regexp_replace(c(x), r"\s+", " "))


def word_tokens(x, min_len: int = 1) -> Column:
    """Lower-cased word tokens; ``min_len=2`` gives the vectoriser's default pattern."""
    pat = WORD + ("+" if min_len <= 1 else "{%d,}" % min_len)
    return F.regexp_extract_all(F.lower(c(x)), F.lit(pat), 0)


def simple_tokens(x) -> Column:
    """Tokeniser A: lower, space out ``? . ! ,``, collapse spaces, split on space.

    The empty string gives an empty array (not ``[""]``).
    """
    s = F.regexp_replace(F.lower(c(x)), r"([?.!,])", " $1 ")
    s = collapse_spaces(s)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " "))


def word_ngrams(tokens, n: int) -> Column:
    """Contiguous n-grams of a token array joined by a space."""
    t = c(tokens)
    return F.when(F.size(t) < n, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(t) - n + 1),
                    lambda i: F.array_join(F.slice(t, i, n), " ")))


def char_ngrams(text, n: int) -> Column:
    """Character n-grams of a string (across word borders)."""
    s = c(text)
    return F.when(F.length(s) < n, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(s) - n + 1),
                    lambda i: F.substring(s, i, n)))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer may copy a column's definition into an expression that uses it, lambdas included, where it would
    run again for every element; the variable of a lambda is not copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
