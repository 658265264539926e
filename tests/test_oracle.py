"""Every registered query agrees with its DuckDB statement (sf0.001)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_compare import duck, duck_rows, rows_of

from conftest import SF_SMALL
from ledgerline.plans.catalog import QUERIES

KEYS = sorted(QUERIES)      # the optional subpackage has its own tests


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["order_id", "customer_id", "order_total_usd", "tax_amount_usd",
                          "net_revenue_usd", "created_at", "order_month"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    s_cols, s_rows = rows_of(queries()[key](spark, SF_SMALL))
    d_cols, d_rows = duck_rows(con, oracle_sql()[key])
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
