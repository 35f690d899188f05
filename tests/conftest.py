import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stratum.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratum-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    from stratum.session import scratch_dir
    return scratch_dir(spark, "test")


@pytest.fixture(scope="session")
def sf():
    return SF
