"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert result["ok"], result["note"]
    if not ORACLES.get(name):
        assert result["rows"] > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
