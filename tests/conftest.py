import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ratebridge.session import build_session

    warehouse = tempfile.mkdtemp(prefix="ratebridge-wh-")
    s = build_session(
        master="local[4]",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ratebridge-test-")
