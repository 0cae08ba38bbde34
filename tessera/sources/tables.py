"""Loader for the Parquet tables the queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

#: Bytes of a Parquet file that are worth a task of their own.
SPREAD_BYTES = 128 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it.

    A file with one row group is one split whatever its size, so the narrow
    work before the first shuffle would run in a single task: a scan with
    fewer splits than SPREAD_BYTES pieces (and than the session's
    parallelism) is spread round-robin. Small tables stay in one piece, and
    large inputs have enough splits of their own.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    pieces = min(spark.sparkContext.defaultParallelism, -(-size // SPREAD_BYTES))
    if df.rdd.getNumPartitions() < pieces:
        df = df.repartition(pieces)
    return df


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]
