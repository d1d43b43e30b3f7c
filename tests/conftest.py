import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from courtline.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="courtline-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_area(spark):
    from courtline.session import scratch_path
    return scratch_path(spark, "tests", unique=True)
