"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from tests.compare import compare, connect

import __spark_entry__ as entry
from geoobs.plans import load

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# Queries of the optional subpackage have tests of their own in tests/llm.
@pytest.mark.parametrize("name", sorted(load().QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, name, SF)
    if problem == "no rows":  # the smallest sample is too thin for some filters
        problem = compare(spark, connect(LARGER), name, LARGER)
    assert problem is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
