"""The driver contract of __spark_entry__.py."""

from __future__ import annotations

import re

import __spark_entry__ as E


def test_contract_shapes(spark):
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert all(callable(q) for q in qs.values())
    assert all(isinstance(s, str) and s.strip() for s in sql.values())
    for name in qs:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert re.match(r"op\d+_", name) is None or name in E._llm()[0]


def test_entry_works_without_the_training_data_part(monkeypatch):
    import sys

    full = set(E.queries())
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    bare = set(E.queries())
    assert bare and bare == {n for n in full if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert set(E.oracle_sql()) <= bare


def test_entry_runs_on_the_smallest_tables(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["city", "role_family", "n_postings", "n_german_required",
                          "n_english_ok", "n_unclear", "pct_german_required", "pct_english_ok"]
