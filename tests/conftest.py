import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tallyspark.session import checkpoint_dir, get_spark
    s = get_spark("local[*]", shuffle_partitions=8,
                  extra={"spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g",
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tally-wh-")})
    # tests have no cluster-provided folder: only here is a local one set
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="tally-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tally-test-")
