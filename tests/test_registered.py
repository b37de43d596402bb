import pytest
from compare import compare, connect

import __spark_entry__ as entry
from reviewloom.checks import oracles
from reviewloom.checks.queries import REGISTERED as QUERIES

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"

ORACLES = oracles.build()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    problem = compare(spark, duck, name, QUERIES[name], ORACLES[name], FOLDER)
    if problem == "no rows":
        # too little data here; nothing on both sides shows nothing, so there must be rows in the larger tables
        problem = compare(spark, connect(LARGER), name, QUERIES[name], ORACLES[name], LARGER)
    assert problem == ""
