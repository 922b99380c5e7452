"""Every registered query beside its SQL on the smallest test tables."""

import pytest

from bindings import ORACLES, QUERIES
from tests.conftest import SMALL
from tests.oracle import connect, difference, spark_rows, sql_rows


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, database, name):
    assert difference(spark_rows(QUERIES[name](spark, SMALL)), sql_rows(database, ORACLES[name])) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
