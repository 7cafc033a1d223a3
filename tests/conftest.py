import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import build
    s = build(master="local[8]", app_name="tidepool-tests", shuffle_partitions=8,
              extra={"spark.driver.memory": "8g",
                     "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidepool-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="tidepool-test-")
