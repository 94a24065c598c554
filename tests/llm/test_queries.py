"""Registered queries: SQL counterparts agree, and each N has one query."""

import os
import re

import pytest

import __spark_entry__ as entry
from siftlake.llm import queries
from tools.compare import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_equal(spark, name):
    equal, rows, message = compare(spark, connect(FOLDER), FOLDER, name)
    assert equal and rows, message
