import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shelfcast.session import get_spark
    s = get_spark("shelfcast-tests", master="local[4]", shuffle_partitions=4,
                  extra_conf={"spark.driver.memory": "4g",
                              "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfcast-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shelfcast-test-")
