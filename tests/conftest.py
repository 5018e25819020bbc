import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketloom.session import session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", 4, **{"spark.driver.memory": "4g", "spark.sql.autoBroadcastJoinThreshold": "1m"})
    s.sparkContext.setLogLevel("ERROR")
    return ship(s)


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
