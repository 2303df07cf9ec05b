"""Every registered query with SQL, beside DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as spec
from tools.check import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_belongs_to_a_query():
    assert set(spec.oracle_sql()) <= set(spec.queries())


@pytest.mark.parametrize("name", sorted(spec.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name, spec.queries()[name], spec.oracle_sql()[name]) == ""
