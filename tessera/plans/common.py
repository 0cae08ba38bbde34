"""Small helpers shared by the query plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places, tie-safely: the cross-engine comparison precision."""
    from tessera.functions.exprs import r6_robust
    return df.select(*[r6_robust(F.col(c)).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])
