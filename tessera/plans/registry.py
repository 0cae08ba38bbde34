"""Registry of named queries: a Spark builder plus an independent SQL oracle.

A query callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the library's operators over the driver's tables. The oracle is a plain
SQL statement over the same tables (views named after the tables) stating the
same rule independently; ``None`` means rows-only checking (MLlib fits,
iterative algorithms).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
HEADLINE: list[str] = []


def tie_safe_round6(sql: str) -> str:
    """Rewrite every ``round(<expr>, 6)`` into ``floor(round(<expr>, 9) * 1000000 + 0.5) / 1000000``.

    Values compared across engines are rounded to 6 places; a mean of short
    decimals can sit exactly on a 7th-digit tie and land on either side of it
    depending on summation order. Rounding to 9 places first removes that
    noise, and the IEEE half-up step rounds identically everywhere. The Spark
    side applies the same form (``r6`` / ``round_doubles``).
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, last_comma = 0, j + 6, None
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                last_comma = k
            k += 1
        if last_comma is not None and sql[last_comma + 1:k].strip() == "6":
            inner = tie_safe_round6(sql[j + 6:last_comma])
            out.append(sql[i:j] + f"floor(round({inner}, 9) * 1000000 + 0.5) / 1000000")
        else:
            out.append(sql[i:j] + "round(" + tie_safe_round6(sql[j + 6:k]) + ")")
        i = k + 1


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = tie_safe_round6(sql.strip())
        if headline:
            HEADLINE.append(name)
        return fn
    return deco
