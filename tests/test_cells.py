"""Distinct counts and quantiles from stored cells and sketches."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hirescope import catalog
from hirescope.plans import cells as CE


@pytest.mark.parametrize("name", ["kpi_cells_filtered", "pay_sketch_ranges"])
def test_query_matches_oracle(spark, base, name):
    from hirescope.checks.compare import compare, duckdb_connection

    r = compare(spark, base, name, catalog.QUERIES[name], catalog.ORACLE[name], duckdb_connection(base))
    assert r["cols_match"] and r["match"] and r["spark_rows"], r


def _fact(spark, n=4000):
    rng = random.Random(1)
    rows = [(rng.choice(["A", "B", None]), rng.choice(["x", "y"]), rng.choice(["english_ok", "unclear"]),
             rng.choice([None] + [f"c{i}" for i in range(300)]), rng.random() < 0.3,
             None if rng.random() < 0.2 else float(rng.randint(20_000, 90_000)), dt.datetime(2024, rng.randint(1, 12), 3)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "city string, role_family string, language_gate string, company_name string, "
                                             "remote boolean, salary_min_annualized_eur double, posted_at timestamp_ntz")


def test_any_filter_counts_distinct_companies_without_the_fact(spark):
    rows, fct = _fact(spark)
    # many buckets: numbers far apart
    numbers = CE.company_numbers(fct).withColumn("company", F.col("company") * 1000)
    cells, bitmaps = CE.kpi_cells(fct), CE.company_bitmaps(fct, numbers)
    assert bitmaps.select("bucket").distinct().count() > 5
    for where, keep in ((F.col("city") == "A", lambda r: r[0] == "A"), (F.col("city").isin("A", "B") & (F.col("role_family") == "y"),
                        lambda r: r[0] in ("A", "B") and r[1] == "y"), (F.lit(True), lambda r: True),
                        ((F.col("language_gate") == "english_ok") & F.col("city").isNull(), lambda r: r[2] == "english_ok" and r[0] is None),
                        (F.col("city") == "nowhere", lambda r: False)):
        got = CE.kpi_filtered(cells, bitmaps, where).first()
        mine = [r for r in rows if keep(r)]
        assert (got.n_jobs, got.n_companies) == (len(mine), len({r[3] for r in mine} - {None}))
        pay = [r[5] for r in mine if r[5] is not None]
        assert got.avg_salary == (pytest.approx(sum(pay) / len(pay), abs=0.01) if pay else None)


def test_merged_sketches_stay_within_their_error(spark):
    rows, fct = _fact(spark, 6000)
    sketches = CE.pay_sketches(fct)
    for lo, hi in ((1, 12), (3, 5), (7, 7)):
        part = sketches.filter(F.month("month").between(lo, hi))
        got = CE.merged_quantiles(part, [F.lit("all").alias("g")], [0.1, 0.5, 0.9]).first()
        pay = sorted(r[5] for r in rows if r[5] is not None and lo <= r[6].month <= hi)
        assert got.n == len(pay)
        for p, q in zip((0.1, 0.5, 0.9), (got.q0, got.q1, got.q2), strict=True):
            rank = sum(v <= q for v in pay) / len(pay)
            assert abs(rank - p) <= CE.RANK_ERROR + 1 / len(pay)
