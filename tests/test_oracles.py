"""Every registered query equals its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from siftlake.catalog import ORACLES, QUERIES
from tools.compare import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equal(spark, con, name):
    equal, _, message = compare(spark, con, FOLDER, name)
    assert equal, message


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "sales_date" and df.count() > 0
