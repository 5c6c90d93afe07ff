"""Every query against its SQL twin on the smallest tables."""

import os

import pytest

from pagewright.plans.catalog import QUERIES
from tests.check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


def names():
    return sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", names())
def test_query(spark, con, name):
    import __spark_entry__ as entry

    got, want, _, _ = compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert got == want and got[1]
