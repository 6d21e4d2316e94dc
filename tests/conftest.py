import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from noria.session import get_spark

    s = get_spark(4, 4, "tests", "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
