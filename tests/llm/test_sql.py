"""Registered corpus queries equal their SQL."""

import pytest
from compare import database, difference

from offerloom.llm import oracles, queries

SQL, QUERIES = oracles.statements(), queries.registered()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), database(folder), SQL[name]) is None
