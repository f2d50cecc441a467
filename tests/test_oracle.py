"""Every named query against its SQL."""

import pytest

import __spark_entry__ as entry
from prefkit.catalog.oracle import oracle_sql
from prefkit.catalog.queries import CATALOG
from tests.oracle_check import connect, spark_rows, sql_rows

SQL = oracle_sql()


@pytest.fixture(scope="module")
def db(data):
    return connect(data)


def test_every_query_has_its_sql():
    assert set(CATALOG) == set(SQL)
    assert set(CATALOG) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_same_as_sql(spark, db, data, name):
    assert spark_rows(CATALOG[name](spark, data)) == sql_rows(db, SQL[name])


def test_entry(spark, data):
    assert [r.asDict() for r in entry.entry(spark).collect()][0]["total"] > 0
