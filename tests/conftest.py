import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rankflow.session import get_session

    s = get_session("local[4]", app="rankflow-tests", shuffle_partitions=4, extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()
