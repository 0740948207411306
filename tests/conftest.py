import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", sys.path[0])


@pytest.fixture(scope="session")
def spark():
    from wardmill.session import build_session

    s = build_session(master="local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    yield s
    s.stop()
