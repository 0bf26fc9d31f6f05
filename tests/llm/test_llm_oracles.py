"""Queries with SQL against DuckDB, on the smallest tables and on a table of hard rows."""

from __future__ import annotations

import duckdb
import pytest

from hirescope.checks.compare import compare, duckdb_connection
from hirescope.llm import registry

HARD = [
    (1, "one two three four five six seven eight nine ten " * 3, "en", "b", 10),
    (1, "one two three four five six seven eight nine ten " * 3, "en", "b", 10),
    (2, "One two three four five six seven eight nine ten " * 3, None, None, None),
    (3, None, "en", "a", 0), (4, "", "de", "a", 0), (5, " \n\t ", "de", None, 3), (6, "solo", "en", "é", 4),
    (7, "a b c d", "en", "Z", 7), (8, "a  b\nc\td", "en", "z", 7), (9, "x\u00a0y z\u2003w é\U0001F642 #*$%", "fr", "z", 9),
    (10, "line one here\nline one here\nother\n\n\nother", "fr", "z", 9),
    (11, "word " * 4000, "fr", "z", 20000), (12, " ".join(f"w{i}" for i in range(3000)), "fr", "z", 9),
    (13, " ".join(f"w{i}" for i in range(3000)) + " w3000", "fr", "z", 9),
]
LABELS = [(1, 1, 0, "x"), (2, 0, 1, None), (2, 1, None, None), (3, None, 1, "y"), (8, 1, 1, "z"), (8, 1, 1, "z"),
          (99, 1, 1, "none"), (None, 1, 1, "no id")]
LONG = [(40, t, "user", f"turn {t % 7}") for t in range(150)] + [(41, t, "user", f"turn {t % 7}") for t in range(160)]
TURNS = LONG + [
    (20, 0, "user", "hello there"), (20, 1, "assistant", "hi  you"), (20, 2, "user", "more"), (20, 3, None, None),
    (21, 0, "user", "hello there"), (21, 1, "assistant", "hi  you"), (21, 2, "user", "else"), (21, 3, "user", "end"),
    (22, None, "user", "first"), (22, 5, "user", "tie"), (22, 5, "user", "a tie"), (22, 5, "assistant", "tie"), (22, 5, "user", "tie"),
    (23, 0, "", ""), (24, 0, "user", "one"), (25, 0, "user", "one"), (26, 0, "user", "one"), (27, 3, "user", "one"),
    (123, 0, "system", "no family"), (124, 0, "user", "only"), (125, 0, "user", "only"), (131, 0, "user", "only"),
    (-7, 0, "user", "below zero"), (-7, 1, "user", "x"), (0, 0, "user", "zero"), (None, 0, "user", "nobody's"), (None, 1, "a", "b")]
PAGES = [(1, "http://a.b/x", "<p>" + "é" * 600), (5, "http://a.b/x", "<p>" + "é" * 600),
         (5, "http://a.b/x", "<p>" + "é" * 600), (2, None, None), (3, "", "a\r\n\r\nWARC/1.1\r\n\r\nb"),
         (4, "https://B.c.d/Y?z#f", "x" * 999), (6, "https://B.c.d/Y?z#f", "x" * 999)]


@pytest.fixture(scope="module")
def hard(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("hard"))
    docs = spark.createDataFrame(HARD, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int, extra string").write.parquet(f"{d}/labels.parquet")
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    turns.selectExpr("*", "1 AS a", "'x' AS part", "2 AS pos", "3 AS n_convs").repartition(5).write.parquet(f"{d}/conversations.parquet")
    spark.createDataFrame(PAGES, "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    return d


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name, cols in (("documents", "doc_id long, text string, lang string, source string, n_chars long"),
                       ("pages", "page_id long, url string, html string"),
                       ("embeddings", "vec_id long, embedding array<float>, label int"),
                       ("labels", "doc_id long, quality int, toxic int"),
                       ("conversations", "conv_id long, turn long, role string, text string")):
        spark.createDataFrame([], cols).write.parquet(f"{d}/{name}.parquet")
    return d


@pytest.mark.parametrize("name", list(registry.ORACLE))
def test_matches_sql_on_the_smallest_tables(spark, base, name):
    r = compare(spark, base, name, registry.QUERIES[name], registry.ORACLE[name], duckdb_connection(base))
    assert r["cols_match"] and r["match"], r


@pytest.mark.parametrize("name", list(registry.ORACLE))
def test_matches_sql_on_hard_rows(spark, hard, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{hard}/{t}.parquet/*.parquet')")
    r = compare(spark, hard, name, registry.QUERIES[name], registry.ORACLE[name], con)
    assert r["cols_match"] and r["match"], r


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_an_empty_table_gives_an_empty_result(spark, empty, name):
    assert registry.QUERIES[name](spark, empty).collect() == []
