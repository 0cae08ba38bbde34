"""tessera: Spark-native operators for matching, recommendation and evaluation work.

Every public operator takes and returns Spark DataFrames and is built from
DataFrame / SQL built-ins, so Catalyst plans it and Tungsten runs it.
"""

from tessera.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
