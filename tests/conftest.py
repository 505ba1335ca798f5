import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tallyspark.session import get_spark, shared_dir
    s = get_spark("local[4]", "tallyspark-tests", shuffle_partitions=8,
                  extra={"spark.driver.memory": "4g"})
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tallyspark-test-", dir="/tmp")
