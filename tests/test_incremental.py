"""Bucketed upsert, marts by deltas, spells, ranks, event-time windows."""

from __future__ import annotations

import datetime as dt
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from hirescope import catalog
from hirescope.operators import bucket_store as BS
from hirescope.operators.ranking import ranked
from hirescope.plans import incremental as INC
from hirescope.plans import models as M
from hirescope.plans import salary as S
from hirescope.plans import spells as SP
from hirescope.sources import postings_json as J
from hirescope.sources import testbed
from hirescope.streaming import windows as WIN

NEW = ["mart_language_gate_incremental", "mart_skill_demand_incremental", "mart_pay_bands_incremental", "upsert_bucketed",
       "posting_spells", "posting_survival", "repeated_folds", "weekly_windows", "boost_root_gains", "boost_checks"]


@pytest.mark.parametrize("name", NEW)
def test_query_matches_oracle(spark, base, name):
    from hirescope.checks.compare import compare, duckdb_connection

    r = compare(spark, base, name, catalog.QUERIES[name], catalog.ORACLE[name], duckdb_connection(base))
    assert r["cols_match"] and r["match"] and r["spark_rows"], r


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_an_upsert_rewrites_the_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    schema = "slug string, v string, ingested_at timestamp_ntz"
    BS.create(spark.createDataFrame([(f"s{i}", "old", t0) for i in range(200)], schema), path, "slug", 16)
    before = _files(path)
    batch = spark.createDataFrame([("s3", "one", t1, 1), ("s3", "two", t1, 2), ("s3", "two", t1, 2), ("new", "n", t1, 1)],
                                  schema + ", o int")
    touched = BS.upsert_bucketed(spark, path, batch, "slug", ["o"], 16, ("ingested_at",))
    after = _files(path)
    assert len(touched) <= 2
    kept = {f for f in before if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
    assert kept and all(after.get(f) == before[f] for f in kept)
    rows = {r.slug: (r.v, r.ingested_at) for r in BS.read(spark, path).collect()}
    assert len(rows) == 201 and rows["s3"] == ("two", t0) and rows["new"] == ("n", t1) and rows["s4"] == ("old", t0)
    assert BS.upsert_bucketed(spark, path, batch.limit(0), "slug", ["o"], 16) == []
    plan = BS.read(spark, path, touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan


def test_marts_by_deltas_equal_a_full_refresh_after_many_batches(spark, base, tmp_path):
    raw = testbed.postings(spark, base)
    fct = M.fact(M.staging(raw.limit(150))).cache()
    marts = INC.IncrementalMarts(spark, str(tmp_path / "m"), buckets=8)
    marts.load(fct)
    rng = random.Random(2)
    slugs = [r.slug for r in fct.select("slug").collect()]
    for i in range(3):
        some = rng.sample(slugs, 10 + 20 * i)
        batch = (fct.filter(F.col("slug").isin(some)).withColumn("city", F.lit(f"City {i}"))
                 .withColumn("seniority", F.lit(rng.choice(["junior", "mid"]))).withColumn("_at", F.lit(i)))
        if i == 1:  # rows of a slug that comes twice: the later one counts, once
            batch = batch.unionByName(batch.withColumn("city", F.lit("Later")).withColumn("_at", F.lit(9))).unionByName(batch)
        plan = marts.replaced_rows(batch)._jdf.queryExecution().executedPlan().toString()
        assert "description" not in plan.split("ReadSchema")[1].split("\n")[0]
        marts.apply(batch, ["_at"])
    now = marts.fact()
    assert now.count() == len(slugs)
    for got, want in ((marts.language_gate(), M.mart_language_gate(now)), (marts.pay_bands(), M.mart_pay_bands(now)),
                      (marts.skill_demand(), M.mart_skill_demand(now, M.dim_skills(spark)))):
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols
        assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_a_failed_batch_is_applied_again_without_counting_twice(spark, base, tmp_path, monkeypatch):
    fct = M.fact(M.staging(testbed.postings(spark, base).limit(60))).cache()
    marts = INC.IncrementalMarts(spark, str(tmp_path / "m"), buckets=4)
    marts.load(fct)
    batch = fct.limit(20).withColumn("city", F.lit("Moved")).withColumn("_at", F.lit(1)).cache()
    real = INC.B.upsert_bucketed

    def half(spark_, path, new, *rest):  # the fact is written, then the job dies
        real(spark_, path, new, *rest)
        raise RuntimeError("lost")

    monkeypatch.setattr(INC.B, "upsert_bucketed", half)
    with pytest.raises(RuntimeError):
        marts.apply(batch, ["_at"])
    monkeypatch.setattr(INC.B, "upsert_bucketed", real)
    again = INC.IncrementalMarts(spark, str(tmp_path / "m"), buckets=4, version=marts.version)
    again.apply(batch, ["_at"])
    want = M.mart_language_gate(again.fact())
    assert sorted(map(str, again.language_gate().select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_spells_against_a_plain_walk(spark):
    rng = random.Random(4)
    days = [dt.date(2024, 1, 1) + dt.timedelta(7 * i) for i in range(12)]
    seen = [(f"s{i}", d) for i in range(30) for d in days if rng.random() < 0.6] + [("every", d) for d in days]
    rows = seen + seen[:20] + [(None, days[0]), ("s1", None)]
    history = spark.createDataFrame(rows, "slug string, snapshot_date date").repartition(4)
    got = {(r.slug, r.spell): tuple(r)[2:] for r in SP.posting_spells(history).collect()}
    have, want = set(seen), {}
    for s in {s for s, _ in seen}:
        spell, last = 0, None
        for i, d in enumerate(days):
            if (s, d) in have and (i == 0 or (s, days[i - 1]) not in have):
                j = i
                while j + 1 < len(days) and (s, days[j + 1]) in have:
                    j += 1
                spell += 1
                want[s, spell] = (d, days[j], days[j + 1] if j + 1 < len(days) else None, j - i + 1, j + 1 == len(days),
                                  None if last is None else i - last - 1)
                last = j
    assert got == want
    curve = sorted(SP.posting_survival(SP.posting_spells(history), "1").collect(), key=lambda r: r.length)
    alive = 1.0
    for r in curve:
        at_risk = [w for w in want.values() if w[3] >= r.length]
        ended = sum(w[3] == r.length and not w[4] for w in at_risk)
        assert (r.n_at_risk, r.n_ended) == (len(at_risk), ended)
        alive *= 1 - ended / len(at_risk)
        assert r.survival == pytest.approx(alive, abs=1e-6)
    empty = SP.posting_spells(history.limit(0))
    assert empty.count() == 0 and SP.posting_survival(empty).count() == 0


def test_ranks_and_equal_folds(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(2).alias("g"),
                                  F.xxhash64("id").alias("h"))
    got = ranked(df, [F.col("h").asc()], ["g"]).collect()
    for g in (1, 2, None):
        place = sorted((r._rank, r.h) for r in got if r.g == g)
        assert [p for p, _ in place] == list(range(len(place)))
        assert [h for _, h in place] == sorted(h for _, h in place)
    folds = S.repeated_folds(spark.range(103).select(F.concat(F.lit("s"), "id").alias("slug"))).collect()
    for rep in range(5):
        sizes = [sum(r.repeat == rep and r.fold == f for r in folds) for f in range(5)]
        assert sum(sizes) == 103 and max(sizes) - min(sizes) <= 1
    assert len({tuple(sorted(r.slug for r in folds if (r.repeat, r.fold) == (rep, 0))) for rep in range(5)}) == 5


def _page(spark, path, rows, name):
    out = spark.createDataFrame(rows, "slug string, created_at string, k long").withColumn(
        "snapshot_date", F.lit("2024-03-04").cast("date"))
    J.write_pages(out, str(path / name), files=1)
    src = path / "src"
    src.mkdir(exist_ok=True)
    for i, f in enumerate(sorted((path / name).glob("part-*"))):
        shutil.copy(f, src / f"part-{name}-{i}.txt")


def test_late_rows_and_restarts_lose_nothing(spark, tmp_path):
    root, src = str(tmp_path / "root"), tmp_path / "src"
    _page(spark, tmp_path, [("a", "2024-03-05T00:00:00", 1), ("b", "2024-03-06T10:00:00", 2), ("b", "2024-05-06T10:00:00", 3),
                            ("x", "never", 4)], "p1")
    WIN.run(spark, str(src), root)
    _page(spark, tmp_path, [("c", "2024-06-05T00:00:00", 1)], "p2")
    WIN.run(spark, str(src), root)  # the mark moves to June
    _page(spark, tmp_path, [("d", "2024-03-07T00:00:00", 1), ("a", "2024-06-07T00:00:00", 2), ("e", "2024-06-03T00:00:00", 3)], "p3")
    WIN.run(spark, str(src), root)  # d is late, a was seen, e is in an open week
    WIN.run(spark, str(src), root)  # nothing new
    got = {r.week.date(): (r.n_postings, r.n_late) for r in WIN.weekly_windows(spark, root).collect()}
    assert got == {dt.date(2024, 3, 4): (3, 1), dt.date(2024, 6, 3): (2, 0)}
    plan = WIN.window_counts(spark, root)._jdf.queryExecution().toString()
    assert "EventTimeWatermark" in plan


def test_a_large_bucket_is_several_files(spark, tmp_path, monkeypatch):
    """No task takes a whole bucket that grows with the table."""
    monkeypatch.setattr(BS, "FILE_ROWS", 100)
    rows = spark.range(4_000).select(F.concat(F.lit("job-"), F.col("id").cast("string")).alias("slug"), F.lit(0).alias("v"))
    path = str(tmp_path / "t")
    # partitions are not joined here, as they are not where they are large
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        BS.create(rows, path, "slug", 4)
        batch = str(tmp_path / "b")
        rows.filter("slug like '%7'").withColumn("v", F.lit(1)).write.parquet(batch)
        BS.upsert_bucketed(spark, path, spark.read.parquet(batch), "slug", ["v"], 4, unique=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = BS.read(spark, path)
    files = got.select(BS.BUCKET, F.input_file_name().alias("f")).distinct().groupBy(BS.BUCKET).agg(F.count("f").alias("n")).collect()
    assert len(files) == 4 and all(r.n > 1 for r in files), files
    assert got.count() == 4_000 and got.agg(F.sum("v")).first()[0] == 400
    assert got.filter(F.col("v") != F.col("slug").endswith("7").cast("int")).count() == 0


def test_a_batch_is_stored_before_its_winners_are_picked(spark, tmp_path, monkeypatch):
    """The rows handed in (enriched, not stored) are computed once: the passes over keys read a table."""
    raw = testbed.postings(spark, "/root/testdata/sf0.001").limit(60).cache()
    fct = M.fact(M.staging(raw))
    marts = INC.IncrementalMarts(spark, str(tmp_path / "m"), buckets=4)
    marts.load(fct)
    seen = []
    picked = INC.winners
    monkeypatch.setattr(INC, "winners", lambda df, *a, **k: (seen.append(df.inputFiles()), picked(df, *a, **k))[1])
    marts.apply(fct.limit(20).withColumn("_at", F.lit(0)), ["_at"])
    assert seen and all("/incoming/" in f for f in seen[0])
    assert marts.fact().count() == 60
