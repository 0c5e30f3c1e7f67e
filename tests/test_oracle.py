"""Every registered query equals its SQL counterpart on the small tables."""

import os

import pytest
from oracle_check import compare, connect

from __spark_entry__ import ORACLE, QUERIES, entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).columns == ["name", "schema_name", "description"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    verdict = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR)
    assert verdict in (None, "no rows to compare")
