import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lumenframe.session import local_session

    s = local_session(4, "tests", memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
