"""Every registered query with SQL equals DuckDB on the smallest data set."""

import pytest
from compare import database, difference

import __spark_entry__ as entry

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def db(folder):
    return database(folder)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_equals_sql(spark, folder, db, name):
    assert difference(QUERIES[name](spark, folder), db, SQL[name]) is None


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["customer_id", "segment"]
    assert df.count() == 150
