import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    wh = tempfile.mkdtemp(prefix="strata-wh-")
    s = build_session("local[4]", 4, app_name="strata-tests",
                      extra={"spark.sql.warehouse.dir": wh, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="strata-test-")
