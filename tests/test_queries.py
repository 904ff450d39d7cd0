"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, name):
    count, problem = difference(spark, FOLDER, contract.queries()[name], contract.oracle_sql().get(name))
    assert problem is None, problem
    assert count > 0


def test_oracles_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["key", "window_start", "total", "output_ts"]
