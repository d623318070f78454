"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from rowloom.plans.queries import QUERIES
from tests.check_oracles import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(entry.oracle_sql()) - set(entry.TEXT_QUERIES)
    assert set(QUERIES) == set(entry.queries()) - set(entry.TEXT_QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sql, name):
    assert compare(entry.queries()[name](spark, SF_DIR), sql, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
