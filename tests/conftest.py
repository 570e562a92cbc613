from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martwright.session import build_session, checkpoint_dir

    warehouse = tempfile.mkdtemp(prefix="martwright-wh-")
    s = build_session("local[8]", app_name="martwright-tests", shuffle_partitions=8,
                      extra_conf={"spark.driver.memory": "4g",
                                  "spark.sql.warehouse.dir": warehouse})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="martwright-test-")
