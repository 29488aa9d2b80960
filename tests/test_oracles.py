"""Every registered query against its oracle on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference
from tests.conftest import SMALL

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    if name in ORACLES:
        assert difference(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
