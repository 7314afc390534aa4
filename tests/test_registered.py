"""Every registered query against its SQL, and the entry points."""

import os

import __spark_entry__ as entry
import pytest
from checks.compare import connect, difference
from checks.oracle import oracle_sql as own_oracle
from checks.queries import queries as own_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(own_queries()))
def test_query(spark, con, name):
    assert difference(spark, con, SF_DIR, name) is None


def test_every_own_query_has_sql():
    assert set(own_oracle()) == set(own_queries())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10
    assert sum(r.shipments for r in rows) == 5683
