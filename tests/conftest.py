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
    from ledgerline.session import build_session

    s = build_session("local[4]", app_name="ledgerline-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g",
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ledgerline-wh-")})
    # tests own their checkpoint dir (a cluster sets spark.checkpoint.dir)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from ledgerline.session import scratch_path

    return lambda name: scratch_path(spark, name)
