"""Every registered query with a SQL text gives the rows of that text."""

import pytest

from conftest import SF
from oracle import compare, connect
from wardenlake import catalog

ORACLE = catalog.oracle_sql()
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_text_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, con, name):
    assert compare(QUERIES[name](spark, SF).toArrow(), con, ORACLE[name]) is None
