"""Running threshold-sweep state over a stream of scored rows.

Each arriving row only increments a (bucket, pos, neg) counter, where the
bucket is the largest grid threshold the score reaches; Spark keeps that
small state in its state store (checkpointed), and the full sweep (V04) is a
suffix sum over it, computed whenever it is read. No row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.rows import attach_row
from tessera.operators.evaluate import with_rates


def sweep_state_stream(scored: DataFrame, grid: list[int], label: str = "label", score: str = "score") -> DataFrame:
    """Streaming aggregate: (b, pos, neg) per threshold bucket (use outputMode 'complete' or 'update')."""
    ths = F.array(*[F.lit(x / 100.0) for x in sorted(grid)])
    b = F.size(F.filter(ths, lambda t: F.col(score) >= t))
    return (scored.select(b.alias("b"), F.col(label).cast("long").alias("y"))
                  .groupBy("b").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")))


def threshold_sweep_from_state(state: DataFrame, grid: list[int]) -> DataFrame:
    """V04 from the bucket state (a batch read of the sink), same columns as ``threshold_sweep``."""
    g = sorted(grid)
    gdf = state.sparkSession.createDataFrame([(i + 1, x) for i, x in enumerate(g)], "gi int, g int")
    cnt = (gdf.join(F.broadcast(state), F.col("b") >= F.col("gi"), "left")
              .groupBy("gi", "g").agg(F.coalesce(F.sum("pos"), F.lit(0)).cast("long").alias("tp"),
                                      F.coalesce(F.sum("neg"), F.lit(0)).cast("long").alias("fp")))
    tot = state.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    out = (attach_row(cnt, tot).withColumn("fn", (F.col("P") - F.col("tp")).cast("long"))
           .withColumn("tn", (F.col("N") - F.col("fp")).cast("long"))
           .withColumn("threshold", F.col("g") / 100.0).drop("P", "N", "gi"))
    return with_rates(out)
