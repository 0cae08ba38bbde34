import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import SF_ORACLE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from tessera.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return con
