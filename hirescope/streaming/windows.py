"""Weekly counts with event time, a watermark and state (X4), no late row lost.

Two streams run one after the other over the same folder tree:

1. ``ingest``: JSON pages -> the first row per (slug, snapshot date) in page order
   (A3: inside a micro-batch by the order columns; a pair that an earlier epoch has
   seen is left out, which is what a state of seen pairs would do, kept as a table
   so that its size is no matter of memory: the scan is held to the batch's range of
   snapshot dates, by which its files are sorted). Every epoch stores the largest posting time seen so far. A row whose
   week closed more than ``delay`` before that mark is late and goes to a side
   table; the others are on time.
2. ``count``: a streaming aggregation over the rows on time, ``withWatermark`` and a
   7-day window from Monday in the state store, in update mode. The watermark lets
   the state of closed weeks go. It never passes the mark by which a row was judged
   on time - one micro-batch takes all finished epochs, and its watermark comes
   from earlier ones - so the aggregation drops nothing; :func:`run` checks that.

The result is the latest count of every week plus its late rows. All sinks are
keyed by epoch or batch, so a micro-batch that is replayed overwrites itself.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions import text as X
from hirescope.operators.dedup import batch_dedup
from hirescope.session import scratch_path
from hirescope.sources import postings_json as J
from hirescope.streaming.ingest import page_stream, rows_of_pages

DELAY_DAYS = 14


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # nothing written yet
        return None


def _ingest(spark: SparkSession, source_dir: str, root: str, delay_days: int, max_files: int | None, multi_line: bool):
    def write_batch(pages: DataFrame, epoch: int) -> None:
        s = pages.sparkSession
        # what the counts need of a row, before any row is dealt out
        narrow = J.normalize(rows_of_pages(pages)).select(
            *J.ORDER_COLUMNS, "slug", "snapshot_date", X.posted_at(F.col("created_at")).cast("timestamp").alias("posted_at"))
        parsed = scratch_path(s, "window-pages")
        narrow.write.parquet(parsed)
        rows = batch_dedup(s.read.parquet(parsed), J.ORDER_COLUMNS).select("slug", "snapshot_date", "posted_at")
        staged = scratch_path(s, "window-rows")
        rows.write.parquet(staged)
        rows = s.read.parquet(staged)
        seen = _read(s, f"{root}/seen")
        if seen is not None:
            # the pairs of earlier epochs in this batch's range of snapshot dates
            span = rows.agg(F.min("snapshot_date").alias("lo"), F.max("snapshot_date").alias("hi")).first()
            known = seen.filter((F.col("epoch") < epoch) & F.col("snapshot_date").between(span.lo, span.hi)).select(
                "slug", "snapshot_date")
            rows = rows.join(known, ["slug", "snapshot_date"], "left_anti")
            kept = scratch_path(s, "window-new")
            rows.write.parquet(kept)
            rows = s.read.parquet(kept)
        marks = _read(s, f"{root}/marks")
        before = None if marks is None else marks.filter(F.col("epoch") < epoch).agg(F.max("upto")).first()[0]
        timed = rows.filter("posted_at is not null")
        closes = X.week_start(F.col("posted_at").cast("timestamp_ntz")) + F.expr("interval 7 days")
        mark = F.lit(before).cast("timestamp").cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(delay_days))
        late = F.coalesce(closes <= mark, F.lit(False))
        out = [("late", timed.filter(late).select("slug", "snapshot_date", "posted_at")),
               ("on_time", timed.filter(~late).select("posted_at")),
               ("marks", rows.agg(F.greatest(F.max("posted_at"), F.lit(before).cast("timestamp")).alias("upto"))),
               ("seen", rows.select("slug", "snapshot_date").sortWithinPartitions("snapshot_date"))]
        for name, df in out:
            df.write.mode("overwrite").parquet(f"{root}/{name}/epoch={epoch}")

    return (page_stream(spark, source_dir, max_files, multi_line).writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", f"{root}/ck-ingest").trigger(availableNow=True).start())


def window_counts(spark: SparkSession, root: str, delay_days: int = DELAY_DAYS) -> DataFrame:
    """The streaming aggregation: rows on time by Monday week, under the watermark."""
    return (spark.readStream.schema("posted_at timestamp, epoch long").parquet(f"{root}/on_time")
            .withWatermark("posted_at", f"{delay_days} days")
            .groupBy(F.window("posted_at", "7 days", "7 days", "4 days").alias("w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("week"), "n"))


def _count(spark: SparkSession, root: str, delay_days: int):
    def write_batch(counts: DataFrame, batch: int) -> None:
        counts.write.mode("overwrite").parquet(f"{root}/windows/batch={batch}")

    return (window_counts(spark, root, delay_days).writeStream.outputMode("update").foreachBatch(write_batch)
            .option("checkpointLocation", f"{root}/ck-count").trigger(availableNow=True).start())


def run(spark: SparkSession, source_dir: str, root: str, delay_days: int = DELAY_DAYS, max_files: int | None = None,
        multi_line: bool = False) -> None:
    """Take in all pages that have come since the last run (or since a failure), then count them."""
    root = root.rstrip("/")
    _ingest(spark, source_dir, root, delay_days, max_files, multi_line).awaitTermination()
    rows = _read(spark, f"{root}/on_time")
    if rows is None:
        return
    _count(spark, root, delay_days).awaitTermination()
    counted = _latest(spark, root).agg(F.sum("n")).first()[0] or 0
    if counted != (held := rows.count()):
        raise RuntimeError(f"{held} rows on time, {counted} counted: the watermark dropped some")


def _latest(spark: SparkSession, root: str) -> DataFrame:
    got = _read(spark, f"{root}/windows")
    if got is None:
        return spark.createDataFrame([], "week timestamp_ntz, n long")
    return got.groupBy("week").agg(F.max_by("n", "batch").alias("n"))


def weekly_windows(spark: SparkSession, root: str) -> DataFrame:
    """(week, n_postings, n_late): the state's latest counts and the late rows' weeks."""
    root = root.rstrip("/")
    counts = _latest(spark, root).select("week", "n", F.lit(0).cast("long").alias("late"))
    late = _read(spark, f"{root}/late")
    if late is not None:
        counts = counts.unionByName(late.select(
            X.week_start(F.col("posted_at").cast("timestamp_ntz")).alias("week"),
            F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("late")))
    return counts.groupBy("week").agg(F.sum("n").alias("n_postings"), F.sum("late").alias("n_late"))
