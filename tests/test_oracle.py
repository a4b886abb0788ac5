"""Every named query that has SQL against DuckDB, at the smallest scale.

Queries without SQL (fitted models, a sketch) run in ``python -m checks.verify``.
"""

import os

import pytest

from checks import load
from checks.verify import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not there")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(load()[1]))
def test_query(spark, connection, name):
    verdict, rows = compare(spark, connection, SF_DIR, name)
    assert verdict == "ok" and rows >= 0
