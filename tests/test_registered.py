"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as registered
import oracles
from tests.compare import connect, spark_rows, sql_rows
from tests.conftest import SMALL

QUERIES = registered.queries()
#: Queries of training data have tests of their own.
ORACLES = oracles.sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_queries_without_sql_are_those_of_training_data():
    rest = set(QUERIES) - set(ORACLES)
    assert set(ORACLES) <= set(QUERIES) and ORACLES.items() <= registered.oracle_sql().items()
    assert all(name == "pipeline" or name.startswith("op") for name in rest)


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, duck, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(duck, ORACLES[name])


def test_entry(spark):
    assert registered.entry(spark).count() > 0
