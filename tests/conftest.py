import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from assay.session import local_session

    s = local_session("4", shuffle_partitions=4, app="assay-tests")
    yield s


@pytest.fixture()
def frame(spark):
    """Build a small DataFrame from rows and a DDL schema."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make
