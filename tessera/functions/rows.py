"""Helpers for attaching one-row aggregates (totals, edges) to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a single-row aggregate to every row of ``df``.

    ``one_row`` must be a global aggregate (exactly one row, so its size is
    bounded); it is broadcast and joined on a constant key.
    """
    return (df.withColumn("__one", F.lit(1))
              .join(F.broadcast(one_row.withColumn("__one", F.lit(1))), "__one")
              .drop("__one"))
