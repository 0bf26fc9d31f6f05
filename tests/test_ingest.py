"""Ingest semantics: JSON pages, normalisation, dedup, upsert, streaming."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from hirescope.operators.dedup import batch_dedup, keep_first, keep_last
from hirescope.operators.upsert import upsert
from hirescope.plans import ingest as I
from hirescope.plans import models as M
from hirescope.sources import postings_json as J
from hirescope.sources import synth
from hirescope.streaming import ingest as STR


def _write(path, page, pretty=True):
    path.write_text(json.dumps(page, indent=2 if pretty else None, ensure_ascii=False))


def test_normalize_created_at_and_truthiness(spark, tmp_path):
    page = {"snapshot_date": "2024-03-04", "data": [
        {"slug": "a", "created_at": 1700000000, "remote": True, "tags": ["x", "y"], "extra": 1},
        {"slug": "b", "created_at": "1700000000", "remote": "false"},
        {"slug": "c", "created_at": 1700000000.25, "remote": 0},
        {"slug": "d", "created_at": 0, "title": None},
        {"slug": "e", "created_at": "", "remote": []},
        {"slug": "f"},
        {"slug": "g", "created_at": 1e20},
    ]}
    _write(tmp_path / "p1.json", page)
    rows = {r["slug"]: r for r in I.read_batch(spark, str(tmp_path)).collect()}
    assert rows["a"]["created_at"] == "2023-11-14T22:13:20+00:00"
    assert rows["b"]["created_at"] == "1700000000"  # a quoted number stays text
    assert rows["c"]["created_at"] == "2023-11-14T22:13:20.250000+00:00"
    assert rows["d"]["created_at"] == "1970-01-01T00:00:00+00:00"  # 0 is a number, not falsy
    assert rows["e"]["created_at"] is None and rows["f"]["created_at"] is None
    assert rows["g"]["created_at"] is None  # out of range: NULL, not a failed job
    assert [rows[s]["remote"] for s in "abcdef"] == [True, True, False, False, False, False]
    assert rows["a"]["tags"] == ["x", "y"] and rows["f"]["tags"] == []
    assert rows["d"]["title"] == "" and rows["f"]["description"] == ""
    assert rows["a"]["snapshot_date"] == dt.date(2024, 3, 4)
    assert '"extra":1' in rows["a"]["raw_payload"]


def test_missing_snapshot_date_is_today(spark, tmp_path):
    _write(tmp_path / "p.json", {"data": [{"slug": "a"}]})
    r = I.read_batch(spark, str(tmp_path)).first()
    assert r["snapshot_date"] == spark.sql("select current_date()").first()[0]


def test_batch_dedup_keeps_first_and_drops_empty(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), "first", 0), ("a", dt.date(2024, 1, 1), "second", 1),
         ("a", dt.date(2024, 1, 8), "other week", 2), ("", dt.date(2024, 1, 1), "blank", 3)],
        "slug string, snapshot_date date, title string, _pos int")
    out = sorted((r["snapshot_date"], r["title"]) for r in batch_dedup(df, ["_pos"]).collect())
    assert out == [(dt.date(2024, 1, 1), "first"), (dt.date(2024, 1, 8), "other week")]


def test_upsert_last_write_wins_first_ingested_at_kept(spark):
    schema = "slug string, title string, ingested_at timestamp_ntz, _b int, _p int"
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    target = spark.createDataFrame([("a", "old", t0), ("b", "keep", t0)],
                                   "slug string, title string, ingested_at timestamp_ntz")
    batch = spark.createDataFrame([("a", "new1", t1, 2, 0), ("a", "new2", t1, 2, 1),
                                   ("c", "fresh", t1, 2, 2)], schema)
    out = {r["slug"]: (r["title"], r["ingested_at"])
           for r in upsert(target, batch, "slug", ["_b", "_p"]).collect()}
    assert out == {"a": ("new2", t0), "b": ("keep", t0), "c": ("fresh", t1)}


TIED = [("a", "x", 1, 5), ("a", "x", 1, 5), ("a", "y", 1, 5), ("b", "old", 1, 4), ("b", "new", 2, 3), ("b", "new", 2, 3),
        ("c", None, None, None), ("c", None, None, None), (None, "n", 1, 1), (None, "n", 1, 1)]


def test_rows_that_tie_leave_one_row_per_key(spark):
    df = spark.createDataFrame(TIED * 40, "k string, v string, o int, p int").repartition(7)
    for pick, b in ((keep_first, "old"), (keep_last, "new")):
        got = sorted(map(tuple, pick(df, ["k"], ["o", "p"]).collect()), key=str)
        assert [r[0] for r in got] == sorted(["a", "b", "c", None], key=lambda k: str((k,)))
        assert {r[0]: r[1] for r in got}["b"] == b
        again = sorted(map(tuple, pick(df.repartition(3), ["k"], ["o", "p"]).collect()), key=str)
        assert got == again  # the same one of tied rows wins however they are dealt
    target = spark.createDataFrame([("a", "was", dt.datetime(2024, 1, 1))], "k string, v string, ingested_at timestamp_ntz")
    batch = df.withColumn("ingested_at", F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")).filter("k is not null")
    got = [(r.k, r.v, r.ingested_at.month) for r in upsert(target, batch, "k", ["o", "p"]).collect()]
    assert sorted(k for k, _, _ in got) == ["a", "b", "c"] and ("b", "new", 2) in got
    assert [m for k, _, m in got if k == "a"] == [1]


def test_load_files_offline_path_end_to_end(spark, tmp_path):
    """Synthetic pages -> load -> warehouse: every model exists and is populated."""
    ids = spark.range(300).withColumnRenamed("id", "k")
    posts = synth.synth_postings(ids, "k", as_of=F.lit(dt.datetime(2024, 5, 1)).cast("timestamp_ntz"))
    J.write_pages(posts.withColumn("k", F.regexp_extract("url", r"(\d+)$", 1).cast("long")),
                  str(tmp_path / "pages"))
    raw = I.load_files(I.empty_raw(spark), spark, str(tmp_path / "pages"), multi_line=False)
    assert raw.count() == 300
    w = M.Warehouse(spark, raw)
    tables = {"enriched": w.enriched(), "dim": w.dim_skills(), "bridge": w.bridge(),
              "fct": w.fact(), "gate": w.mart_language_gate(), "skills": w.mart_skill_demand(),
              "pay": w.mart_pay_bands()}
    assert all(t.count() > 0 for t in tables.values())
    assert w.fact().filter(F.col("language_gate") != "unclear").count() > 0


def test_streams_do_not_depend_on_micro_batches(spark, tmp_path):
    """Late, numeric and repeated rows: one file per batch gives what one batch gives."""
    (tmp_path / "src").mkdir()
    t = 1_700_000_000
    pages = [[("a", "first", "2024-01-01T10:00:00+00:00"), ("b", "b", t)], [("a", "second", "2024-01-01T10:00:00+00:00")],
             [("late", "l", "2019-06-03T10:00:00+00:00"), ("", "blank", t)], [("b", "again", t), ("c", "c", "2024-01-02T00:00:00Z")]]
    for i, rows in enumerate(pages):
        _write(tmp_path / "src" / f"p{i}.json", {"snapshot_date": "2024-03-01", "data": [
            {"slug": s, "title": x, "created_at": c} for s, x, c in rows]}, pretty=False)
    (tmp_path / "src" / "notes.txt").write_text("not a page")
    got = []
    for n in (None, 1):
        log, ck = str(tmp_path / f"log{n}"), str(tmp_path / f"ck{n}")
        STR.start_ingest(spark, str(tmp_path / "src"), log, ck, max_files=n).awaitTermination()
        got.append(({r["week"]: r["n_postings"] for r in STR.weekly_counts(spark, log).collect()},
                    {r["slug"]: r["title"] for r in STR.current_table(spark, log).collect()}))
    assert spark.read.parquet(log).select("epoch").distinct().count() > 1
    assert got[0] == got[1]
    assert got[0][1] == {"a": "first", "b": "b", "late": "l", "c": "c"}
    assert got[0][0] == {dt.datetime(2024, 1, 1): 2, dt.datetime(2023, 11, 13): 1, dt.datetime(2019, 6, 3): 1}


def test_a_lost_checkpoint_does_not_overwrite_the_log(spark, tmp_path):
    import pytest

    (tmp_path / "src").mkdir()
    for i in range(3):
        _write(tmp_path / "src" / f"p{i}.json", {"data": [{"slug": f"s{i}"}]}, pretty=False)
    args = (spark, str(tmp_path / "src"), str(tmp_path / "log"))
    STR.start_ingest(*args, str(tmp_path / "ck"), max_files=1).awaitTermination()
    with pytest.raises(Exception, match="holds epoch"):
        STR.start_ingest(*args, str(tmp_path / "other"), max_files=1).awaitTermination()
    assert STR.current_table(spark, args[2]).count() == 3


def test_bad_pages_fail(spark, tmp_path):
    import pytest

    for i, bad in enumerate(['{"snapshot_date": "2024-01-01", "data": [{"slug": "a"}, {"slug": "b"', '{"snapshot_date": "not-a-date", "data": [{"slug": "a"}]}']):
        d = tmp_path / str(i)
        d.mkdir()
        (d / "p.json").write_text(bad)
        for multi in (True, False):
            with pytest.raises(Exception):
                I.read_batch(spark, str(d), multi).collect()


def test_falsy_values_are_empty_texts(spark, tmp_path):
    _write(tmp_path / "p.json", {"data": [{"slug": "a", "title": 0, "company_name": False, "location": [], "url": 7}]})
    r = I.read_batch(spark, str(tmp_path)).first()
    assert (r["title"], r["company_name"], r["location"], r["url"]) == ("", "", "", "7")


def test_the_fact_is_written_once_per_warehouse(spark, monkeypatch):
    from hirescope import catalog

    writes = []
    real = M.write_table
    monkeypatch.setattr(M, "write_table", lambda df, path, *a: (writes.append(path), real(df, path, *a)))
    w = M.Warehouse(spark, catalog.testbed.postings(spark, "/root/testdata/sf0.001").limit(50))
    w.register_views()
    assert len(writes) == 1
    assert M.Warehouse(spark, w.raw, ("x", "remote", ())).key is None


def test_streaming_ingest_replays_are_idempotent(spark, tmp_path):
    src, log, ck = (str(tmp_path / n) for n in ("src", "log", "ck"))
    (tmp_path / "src").mkdir()
    _write(tmp_path / "src" / "a.json", {"snapshot_date": "2024-01-01", "data": [
        {"slug": "x", "title": "one"}, {"slug": "x", "title": "dup"}, {"slug": "y", "title": "y"}]})
    STR.start_ingest(spark, src, log, ck, multi_line=True).awaitTermination()
    STR.start_ingest(spark, src, log, ck, multi_line=True).awaitTermination()  # nothing new
    _write(tmp_path / "src" / "b.json", {"snapshot_date": "2024-01-08", "data": [
        {"slug": "x", "title": "two"}]})
    STR.start_ingest(spark, src, log, ck, multi_line=True).awaitTermination()
    got = {r["slug"]: r["title"] for r in STR.current_table(spark, log).collect()}
    assert got == {"x": "two", "y": "y"}


def test_run_all_writes_every_model(spark, tmp_path):
    """The pipeline check: all 8 tables exist, bridge non-empty, some gate decided."""
    from hirescope import catalog

    raw = catalog.testbed.postings(spark, "/root/testdata/sf0.001")
    paths = M.run_all(spark, raw, str(tmp_path / "wh"))
    assert set(paths) == set(M.MODEL_TABLES)
    counts = {t: spark.read.parquet(p).count() for t, p in paths.items()}
    assert counts["raw_jobs"] == raw.count() == counts["fct_jobs"] == counts["enriched_jobs"]
    assert counts["bridge_job_skill"] > 0 and counts["dim_skills"] == 45
    fct = spark.read.parquet(paths["fct_jobs"])
    assert fct.filter(F.col("language_gate") != "unclear").count() > 0


def test_run_all_refuses_empty_input(spark, tmp_path):
    import pytest

    with pytest.raises(ValueError):
        M.run_all(spark, I.empty_raw(spark).drop("raw_payload", "ingested_at"), str(tmp_path / "wh"))


def test_load_sample_counts_rows_and_needs_files(spark, tmp_path):
    import pytest

    _write(tmp_path / "a.json", {"snapshot_date": "2024-01-01", "data": [
        {"slug": "x", "title": "one"}, {"slug": "x", "title": "two"}, {"slug": "", "title": "e"}]})
    table, n = I.load_sample(spark, str(tmp_path))
    assert n == 3  # duplicates and the empty slug are read (no dedup offline)
    assert {r["slug"]: r["title"] for r in table.collect()} == {"x": "two", "": "e"}
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception):
        I.load_sample(spark, str(tmp_path / "empty"))


def test_page_order_survives_file_splits(spark, tmp_path):
    """A large JSON-lines file read as many splits keeps its page order."""
    lines = [json.dumps({"snapshot_date": "2024-01-01",
                         "data": [{"slug": "dup", "title": f"p{i:04d}", "description": "x" * 200}]})
             for i in range(400)]
    (tmp_path / "big.json").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = I.read_batch(spark, str(tmp_path), multi_line=False)
        assert rows.rdd.getNumPartitions() > 5
        first = batch_dedup(rows, J.ORDER_COLUMNS).first()
        table, n = I.load_sample(spark, str(tmp_path), multi_line=False)
        last = table.first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert first["title"] == "p0000" and n == 400 and last["title"] == "p0399"


def test_streaming_log_compaction(spark, tmp_path):
    src, log, ck, snaps = (str(tmp_path / n) for n in ("src", "log", "ck", "snaps"))
    (tmp_path / "src").mkdir()
    _write(tmp_path / "src" / "a.json", {"snapshot_date": "2024-01-01", "data": [
        {"slug": "x", "title": "one"}, {"slug": "y", "title": "y"}]}, pretty=False)
    STR.start_ingest(spark, src, log, ck).awaitTermination()
    snap, upto = STR.compact(spark, log, snaps)
    _write(tmp_path / "src" / "b.json", {"snapshot_date": "2024-01-08", "data": [
        {"slug": "x", "title": "two"}, {"slug": "z", "title": "z"}]}, pretty=False)
    STR.start_ingest(spark, src, log, ck).awaitTermination()
    full = {r["slug"]: (r["title"], r["ingested_at"]) for r in STR.current_table(spark, log).collect()}
    fast = {r["slug"]: (r["title"], r["ingested_at"])
            for r in STR.current_table(spark, log, snap, upto).collect()}
    assert fast == full and {k: v[0] for k, v in full.items()} == {"x": "two", "y": "y", "z": "z"}


def test_written_pages_get_files_of_bounded_size_in_page_order(spark, tmp_path, monkeypatch):
    posts = spark.range(1_000).select(
        F.col("id").alias("k"), F.to_date(F.lit("2024-01-01")).alias("snapshot_date"),
        F.concat(F.lit("job-"), "id").alias("slug"), F.lit("t").alias("title"), F.lit(None).cast("string").alias("created_at"))
    monkeypatch.setattr(J, "FILE_ROWS", 200)
    src = str(tmp_path / "src")
    assert J.write_pages(posts, src, page_size=10, files=2, compression="gzip") == 5
    back = J.read_pages(spark, src, multi_line=False)
    per = {r["_file"]: r["count"] for r in back.groupBy("_file").count().collect()}
    assert len(per) == 5 and sum(per.values()) == 1_000 and all(f.endswith(".gz") for f in per)
    slugs = [r[0] for r in back.orderBy(*J.ORDER_COLUMNS).select(J._field(F.col("v"), "slug", "string")).collect()]
    assert slugs == [f"job-{i}" for i in range(1_000)]


def test_the_log_takes_rows_without_a_shuffle_and_the_current_table_joins_asked_columns_only(spark, tmp_path):
    posts = spark.range(50).select(
        F.col("id").alias("k"), F.to_date(F.lit("2024-01-01")).alias("snapshot_date"),
        F.concat(F.lit("job-"), F.col("id") % 10).alias("slug"), F.concat(F.lit("t"), "id").alias("title"),
        F.lit("x").alias("description"), F.lit(None).cast("string").alias("created_at"))
    src, log, ck = (str(tmp_path / n) for n in ("src", "log", "ck"))
    J.write_pages(posts, src, page_size=10, files=2)
    STR.start_ingest(spark, src, log, ck, max_files=1).awaitTermination()
    now = STR.current_table(spark, log)
    assert {r["slug"]: r["title"] for r in now.collect()} == {f"job-{i}": f"t{i}" for i in range(10)}
    plan = now.select("slug", "title")._jdf.queryExecution().executedPlan().toString()
    assert "description" not in plan and "raw_payload" not in plan


def test_winners_are_filtered_by_number_without_moving_the_rows(spark, tmp_path, monkeypatch):
    """Rows picked by their numbers equal those joined on key and order; the wide rows are not shuffled."""
    from hirescope.operators import dedup as DD

    path = str(tmp_path / "batch")
    rows = spark.range(0, 70_000, 1, 3).select((F.col("id") % 20_011).cast("string").alias("slug"), F.col("id").alias("_pos"),
                                               F.concat(F.lit("text "), F.col("id").cast("string")).alias("title"))
    DD.with_row(DD.with_hash(rows)).write.parquet(path)
    batch = spark.read.parquet(path)
    won = DD.winners(batch, ["slug"], ["_pos", DD.ROW], last=True)
    got = DD.rows_of(batch, won, ["slug"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan[plan.index("BroadcastExchange"):].count("Exchange hashpartitioning")
    by_key = DD.rows_of(batch.drop(DD.ROW), DD.winners(batch, ["slug"], ["_pos"], last=True), ["slug"])
    assert got.columns == by_key.columns == ["slug", "_pos", "title"]
    want = sorted(by_key.collect())
    assert len(want) == 20_011 and sorted(got.collect()) == want
    monkeypatch.setattr(DD, "BITS", 10)  # a larger table takes the join
    assert sorted(DD.rows_of(batch, won, ["slug"]).collect()) == want


def test_weekly_counts_take_the_first_row_by_run_and_page_order_without_sorting_rows(spark, tmp_path):
    """Files in several splits and micro-batches, a second run with earlier names: as a plain loop over the pages counts."""
    import random

    rnd, seen = random.Random(5), {}
    days = [None, "not a date", *[f"2024-0{m}-{d:02d}T10:00:00+00:00" for m in (1, 2, 3) for d in (1, 9, 17, 25)]]
    src, log, ck = (str(tmp_path / n) for n in ("src", "log", "ck"))
    (tmp_path / "src").mkdir()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        for names in (["m0.json", "m1.json", "m2.json"], ["a0.json", "z0.json"]):
            for name in names:
                lines = []
                for _ in range(40):
                    page = [(f"s{rnd.randrange(60)}", rnd.choice(days)) for _ in range(rnd.randrange(9))]
                    date = f"2024-01-0{rnd.randrange(1, 5)}"
                    for slug, at in page:
                        seen.setdefault((slug, date), at)
                    lines.append(json.dumps({"snapshot_date": date, "data": [{"slug": s, "created_at": at} for s, at in page]}))
                (tmp_path / "src" / name).write_text("\n".join(lines) + "\n")
            STR.start_ingest(spark, src, log, ck, max_files=2).awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    splits = spark.read.parquet(log).select("_run", "_file", "_block", "epoch").distinct()
    assert splits.count() > 10 and splits.select("_run").distinct().count() == 2
    want = {}
    for at in seen.values():
        if at and at[:2] == "20":
            day = dt.datetime.fromisoformat(at[:10])
            monday = day - dt.timedelta(days=day.weekday())
            want[monday] = want.get(monday, 0) + 1
    got = STR.weekly_counts(spark, log)
    assert {r["week"]: r["n_postings"] for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "min_by(struct" not in plan


def test_postings_made_from_dealt_keys_are_written_as_before_and_no_text_is_shuffled(spark, tmp_path, base):
    from hirescope import catalog
    from hirescope.sources import testbed

    made = {}
    k = F.col("k")
    keys, files = J.deal_pages(testbed.keys(spark, base), files=4)
    raw = testbed.from_keys(keys, "k", "page_no")
    J.write_dealt(raw, str(tmp_path / "dealt"), numeric_created=catalog._mixed_created(k), compression="gzip")
    whole = testbed.postings(spark, base).withColumn("k", F.substring("slug", 5, 30).cast("long"))
    assert files == J.write_pages(whole, str(tmp_path / "whole"), numeric_created=catalog._mixed_created(k), files=4, compression="gzip")
    for name in ("dealt", "whole"):
        pages = J.read_pages(spark, str(tmp_path / name), multi_line=False)
        assert pages.select("_file").distinct().count() == files
        made[name] = [(r.snapshot_date, r.j) for r in pages.orderBy(*J.ORDER_COLUMNS).select("snapshot_date", F.to_json("v").alias("j")).collect()]
    assert made["dealt"] == made["whole"] and len(made["whole"]) == raw.count() > 0
    plan = raw.groupBy("snapshot_date", "page_no").agg(F.collect_list("description"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" in plan and plan.count("Exchange") == plan.count("BroadcastExchange") + 1
    below = plan[plan.index("Exchange rangepartitioning"):]
    assert "element_at" in plan and "element_at" not in below  # the texts are made after the shuffle


def test_a_text_is_told_by_one_look_at_its_kind(spark):
    rows = [('{"title": "a", "url": "", "slug": 5}',), ('{"title": 0, "url": 1.5, "slug": true}',),
            ('{"title": false, "url": [], "slug": {"a": 1}}',), ('{"title": null, "url": [1]}',)]
    v = F.parse_json("j")
    df = spark.createDataFrame(rows, "j string").select(
        *[J._text(v, f).alias(f) for f in ("title", "url", "slug")],
        *[F.when(J._truthy(v, f), F.coalesce(J._field(v, f, "string"), F.lit(""))).otherwise(F.lit("")).alias(f"{f}_whole")
          for f in ("title", "url", "slug")])
    got = df.collect()
    assert [tuple(r[:3]) for r in got] == [tuple(r[3:]) for r in got]
    assert [r.title for r in got] == ["a", "", "", ""] and got[0].slug == "5" and got[3].slug == ""
