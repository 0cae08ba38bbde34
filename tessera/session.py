"""Session construction and cluster-safe checkpointing."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session gets: AQE re-plans joins and coalesces partitions at
# run time, skew-join splitting handles hot keys that survive our own salting.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster, call with ``master=None`` so spark-submit decides; locally
    the tests pass ``local[*]`` and a small partition count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the executor, so give it the memory
        b = b.config("spark.driver.memory", (extra or {}).get("spark.driver.memory", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Outside local mode the setting is required. Only in local mode, where one
    process is driver and executor, do we make a folder under /tmp.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")  # one process: local and shared are the same
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, *by: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet into the shared checkpoint dir, and its path: a cut of the lineage that
    an iterative job can take back (``drop_stored``) once the next state is written. A reader that filters
    columns ``by`` opens the files of their values only. What was shuffled on the way is no longer needed: the
    driver's garbage collector is asked to let Spark delete it."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/state-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=list(by) or None)
    df.sparkSession._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete a table that ``store`` wrote, on whatever file system the checkpoint dir is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
