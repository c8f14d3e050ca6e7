"""Every query of the catalog against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry_points
from tests.conftest import SF_DIR
from tests.oracle_check import connect, differences

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
