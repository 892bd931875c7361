import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cellhouse.session import build_session

    s = build_session("local[4]", app="cellhouse-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        # tests only: the cluster would name a shared folder
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cellhouse-test-"))
    yield s


@pytest.fixture()
def tmp_table(spark):
    from cellhouse import create_table, new_path

    def make(families=("family",), splits=("aaa", "bbb"), **kw):
        return create_table(spark, new_path(spark, "t"), list(families), list(splits), **kw)

    return make
