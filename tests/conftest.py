import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sifterra.session import build_session  # noqa: E402

SF = os.environ.get("SIFTERRA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    return SF
