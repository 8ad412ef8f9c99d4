import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quill.session import local_session
    s = local_session(cpus=4, shuffle_partitions=4, app="quill-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def ctx(spark):
    from quill.plans.context import Ctx
    return Ctx(spark, SF_SMALL)


def one(df):
    """Single value of a one-row, one-column DataFrame."""
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0][0]
