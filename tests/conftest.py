import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera import get_spark
    s = get_spark("local[4]", app="tessera-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="tessera-tests-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
