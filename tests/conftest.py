import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripdemand.session import get_spark
    scratch = tempfile.mkdtemp(prefix="tripdemand-tests-")
    s = get_spark("local[*]", 8, app_name="tripdemand-tests",
                  extra_conf={"spark.local.dir": scratch})
    # tests own their checkpoint folder; a cluster would name a shared one
    s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return con
