import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillrank.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app_name="quillrank-tests")
    yield s
    s.stop()


@pytest.fixture()
def lines(spark):
    def make(values):
        return spark.createDataFrame([(v,) for v in values], "value string")
    return make
