"""Every registered query with an oracle agrees with DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

from hirescope import catalog
from hirescope.checks.compare import compare, duckdb_connection

FAST = [n for n in catalog.ORACLE]


@pytest.fixture(scope="module")
def con(base):
    return duckdb_connection(base)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, base, con, name):
    r = compare(spark, base, name, catalog.QUERIES[name], catalog.ORACLE[name], con)
    assert r["cols_match"], r
    assert r["match"], r


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(catalog.QUERIES) - set(catalog.ORACLE)
    assert rows_only <= {"salary_scores", "salary_cv", "salary_drivers", "salary_report",
                         "synth_postings"}, rows_only
