"""Plan-shape checks: enrichment stays in the JVM, filters reach the Parquet scan."""

from __future__ import annotations

from hirescope import catalog
from hirescope.plans import models as M
from hirescope.plans import salary as S


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrichment_has_no_python_udf(spark, base):
    plan = _plan(catalog.warehouse(spark, base).fact_plan())
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_training_filter_pushed_to_fact_scan(spark, base):
    fct = catalog.warehouse(spark, base).fact()
    plan = _plan(S.training_frame(fct))
    assert "PushedFilters: [IsNotNull(salary_min_annualized_eur)" in plan


def test_mart_reads_only_needed_columns(spark, base):
    plan = _plan(M.mart_language_gate(catalog.warehouse(spark, base).fact()))
    assert "ReadSchema: struct<city:string,language_gate:string,role_family:string>" in plan


def test_skill_explode_does_not_reinfer_filter(spark, base):
    plan = _plan(catalog.warehouse(spark, base).bridge())
    assert "size(" not in plan


def test_views_and_approx_distinct(spark, base):
    from hirescope.plans import reports as R

    w = catalog.warehouse(spark, base)
    w.register_views()
    n = spark.sql("SELECT COUNT(*) AS n FROM fct_jobs").first()["n"]
    assert n == w.fact().count()
    assert spark.sql("SELECT COUNT(*) FROM mart_werkstudent_pay").first()[0] > 0
    exact = R.kpi_overview(w.fact()).first()
    approx = R.kpi_overview(w.fact(), approx_distinct=True).first()
    assert abs(approx["n_companies"] - exact["n_companies"]) <= 0.05 * exact["n_companies"]
    plan = _plan(R.kpi_overview(w.fact(), approx_distinct=True))
    assert "approx_count_distinct" in plan or "HyperLogLogPlusPlus" in plan


def test_kpis_over_empty_filter_keep_sql_null_semantics(spark, base):
    from hirescope.plans import reports as R

    flt = R.PostingFilter(cities=["No Such City"])
    row = R.kpi_overview(catalog.warehouse(spark, base).fact(), flt).first()
    assert row["n_jobs"] == 0 and row["n_companies"] == 0
    assert row["n_remote"] is None and row["n_english"] is None and row["avg_salary"] is None


def test_language_gate_table_empty_selection_is_empty(spark, base):
    from hirescope.plans import reports as R

    mart = catalog.warehouse(spark, base).mart_language_gate()
    assert R.language_gate_table(mart, cities=[], roles=None).count() == 0
    assert R.language_gate_table(mart).count() == mart.count()


def test_hot_key_operators_combine_map_side(spark):
    """One slug holding a third of the rows is reduced before the shuffle."""
    from pyspark.sql import functions as F

    from hirescope.operators.dedup import batch_dedup, keep_last

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id").cast("string")))
        .alias("slug"), F.lit(None).cast("date").alias("snapshot_date"), F.col("id").alias("_pos"))
    for out in (batch_dedup(df, ["_pos"]), keep_last(df, ["slug"], ["_pos"])):
        plan = _plan(out)
        assert "partial_min_by" in plan or "partial_max_by" in plan, plan
        assert out.count() == 1 + 2 * n // 3
    first_hot = batch_dedup(df, ["_pos"]).filter(F.col("slug") == "hot").first()["_pos"]
    assert first_hot == 0


def test_marts_aggregate_partially(spark, base):
    w = catalog.warehouse(spark, base)
    for df in (w.mart_language_gate(), w.mart_skill_demand(), w.mart_pay_bands()):
        plan = _plan(df)
        assert "partial_" in plan


def test_bucketed_quantiles_equal_percentile_and_oracle(spark, base):
    from hirescope.checks.compare import compare

    w = catalog.warehouse(spark, base)
    exact = {tuple(r) for r in M.mart_pay_bands(w.fact(), method="percentile").collect()}
    bucketed = {tuple(r) for r in M.mart_pay_bands(w.fact(), method="bucketed").collect()}
    assert exact == bucketed
    narrow = {tuple(r) for r in M.mart_pay_bands(w.fact(), method="bucketed",
                                                 bucket_width=37.0).collect()}
    assert narrow == exact
    r = compare(spark, base, "mart_pay_bands_bucketed",
                lambda s, b: M.mart_pay_bands(catalog.warehouse(s, b).fact(), method="bucketed"),
                catalog.ORACLE["mart_pay_bands"])
    assert r["match"], r


def test_bucketed_quantiles_brute_force(spark):
    import random

    import numpy as np

    from hirescope.operators.quantiles import bucketed_quantiles

    rnd = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"g{i % 7}", float(rnd.choice([rnd.randint(1, 50),
                                                                    rnd.random() * 100])))
            for i in range(3000)] + [("single", 4.0), ("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["q0"], r["q1"], r["q2"])
           for r in bucketed_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], 7.5).collect()}
    for g in {g for g, _ in rows}:
        vals = np.array([v for k, v in rows if k == g and v is not None])
        want = np.quantile(vals, [0.1, 0.5, 0.9], method="linear")
        assert np.allclose(got[g], want, rtol=0, atol=1e-9), (g, got[g], want)
