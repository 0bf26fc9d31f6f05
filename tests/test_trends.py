"""Trend reports against brute force on small hand-made inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

import datetime as dt

from hirescope.plans import trends as TR


def test_snapshot_changes_brute_force(spark):
    d = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(5)]
    seen = {"a": [0, 1, 2], "b": [1, 3], "c": [4], "d": [0, 4]}
    rows = [(s, d[i]) for s, idx in seen.items() for i in idx]
    hist = spark.createDataFrame(rows, "slug string, snapshot_date date")
    got = {r["snapshot_date"]: (r["n_active"], r["n_new"], r["n_kept"], r["n_gone"])
           for r in TR.snapshot_changes(hist).collect()}
    want = {}
    for i, day in enumerate(d):
        active = {s for s, idx in seen.items() if i in idx}
        prev = {s for s, idx in seen.items() if i - 1 in idx}
        new = active - prev
        want[day] = (len(active), len(new), len(active) - len(new), len(prev - active))
    assert got == want


def test_skill_share_trend_reports_drop_to_zero(spark):
    rows = [("p1", dt.datetime(2024, 1, 5), ["Python"]), ("p2", dt.datetime(2024, 1, 9), []),
            ("p3", dt.datetime(2024, 2, 2), ["SQL"])]
    fct = spark.createDataFrame(rows, "slug string, posted_at timestamp_ntz, skills array<string>")
    got = {(r["skill_name"], r["month"].month): (r["share"], r["prev_share"], r["share_change"])
           for r in TR.skill_share_trend(fct).collect()}
    assert got[("Python", 1)] == (0.5, 0.0, 0.5)
    assert got[("Python", 2)] == (0.0, 0.5, -0.5)
    assert got[("SQL", 2)] == (1.0, 0.0, 1.0)
    assert ("SQL", 3) not in got  # months without postings are not reported


def test_spells_deal_rows_once_to_as_many_tasks_as_they_need(spark, monkeypatch):
    from hirescope.plans import spells as SP

    rows = spark.range(400).select(F.concat(F.lit("job-"), (F.col("id") % 40).cast("string")).alias("slug"),
                                   F.expr("date '2024-01-01' + int(id % 7) * 7").alias("snapshot_date"))
    want = sorted(SP.posting_spells(rows).collect())
    monkeypatch.setattr(SP, "TASK_ROWS", 10)
    spells = SP.posting_spells(rows)
    plan = spells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "40), REPARTITION_BY_NUM" in plan
    assert sorted(spells.collect()) == want
