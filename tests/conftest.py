import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomline.session import local_session  # noqa: E402
from tests.oracle_check import force_split  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(params=["plain", "split"])
def grouping(request, spark):
    """Run a test with ordinary windows and joins, and with every group treated as hot."""
    if request.param == "split":
        force_split(spark)
    yield request.param
    force_split(spark, on=False)
