"""Every registered query against its SQL on the given tables."""

import pytest

from stratum.registry import entry, oracle_sql, queries
from tests.compare import connect, differences
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, name):
    assert differences(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) == set(queries())


def test_revenue_mart_is_sorted(spark):
    rows = queries()["mart_revenue_by_segment"](spark, SF_DIR).collect()
    assert len(rows) > 100 and [(r.order_month, r.net_revenue) for r in rows] == sorted(
        ((r.order_month, r.net_revenue) for r in rows), reverse=True
    )


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
