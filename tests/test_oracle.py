"""Every market query against its SQL."""

import pytest

from compare import SF, connect
from compare import same as same_rows
from hammerline import queries as market

SQL = market.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("key", sorted(SQL))
def test_equals_sql(spark, con, key):
    same_rows(market.queries()[key](spark, SF), con, SQL[key])


def test_every_sql_has_a_query():
    assert set(SQL) <= set(market.queries())


@pytest.mark.parametrize("key", sorted(set(market.queries()) - set(SQL)))
def test_rows_only(spark, key):
    assert market.queries()[key](spark, SF).count() > 0
