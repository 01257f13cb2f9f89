import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadsift.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, app="threadsift-tests")


@pytest.fixture
def column(spark):
    """Values of one string column run through a DataFrame transform, in order."""

    def run(values, transform, out, dtype="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
        return [r[out] for r in transform(df).orderBy("i").collect()]

    return run
