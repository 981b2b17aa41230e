import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def table(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture()
def rows():
    """Collected rows as sorted tuples of the given columns."""
    def get(df, *cols):
        return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=repr)
    return get
