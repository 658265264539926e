"""Queries that SQL can state agree with their DuckDB statement."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_compare import duck, duck_rows, rows_of  # noqa: E402

from ledgerline.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    assert rows_of(QUERIES[key](spark, SF)) == duck_rows(duck(SF), ORACLE[key])
