"""Trend reports the job-market docs describe.

X1 compares each month's skill share with the previous calendar month by
emitting every (skill, month) share twice, once as "current" and once shifted
a month ahead as "previous", and summing per (skill, month): one aggregation,
no window and no join of months with skills, and a skill that drops to zero
still shows its loss.

X3 keeps the (slug, snapshot) history and marks, per slug, where a run of
consecutive snapshots starts (appearance) and ends (disappearance). The
per-slug window holds at most one row per snapshot of that slug.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirescope.plans import models as M


def skill_share_trend(fct: DataFrame) -> DataFrame:
    """Per skill and month, share of postings mentioning it and change vs last month."""
    dated = fct.filter(F.col("posted_at").isNotNull()).withColumn(
        "month", F.date_trunc("month", "posted_at").cast("timestamp_ntz"))
    totals = dated.groupBy("month").agg(F.count(F.lit(1)).alias("n_month"))
    mentions = (dated.select("month", M.explode_skills().alias("skill_name"))
                .filter(F.col("skill_name").isNotNull())
                .groupBy("skill_name", "month").agg(F.count(F.lit(1)).alias("n_postings")))
    # one row per calendar month with data: bounded by the time span, broadcast
    shares = mentions.join(F.broadcast(totals), "month").withColumn(
        "share", F.col("n_postings") / F.col("n_month"))
    # each share row is emitted twice in one pass: as "current" for its month
    # and as "previous" for the next month
    twice = F.explode(F.array(
        F.struct(F.col("month").alias("month"), F.col("n_postings").alias("n_postings"),
                 F.col("share").alias("share"), F.lit(0.0).alias("prev_share")),
        F.struct(F.add_months(F.col("month"), 1).cast("timestamp_ntz").alias("month"),
                 F.lit(0).cast("long").alias("n_postings"), F.lit(0.0).alias("share"),
                 F.col("share").alias("prev_share"))))
    both = (shares.select("skill_name", twice.alias("e")).select("skill_name", "e.*")
            .groupBy("skill_name", "month")
            .agg(F.sum("n_postings").alias("n_postings"), F.sum("share").alias("share"),
                 F.sum("prev_share").alias("prev_share")))
    both = both.join(F.broadcast(totals.select("month")), "month", "left_semi")
    return both.select("skill_name", "month", "n_postings",
                       F.round("share", 4).alias("share"),
                       F.round("prev_share", 4).alias("prev_share"),
                       F.round(F.col("share") - F.col("prev_share"), 4).alias("share_change"))


def skill_movers(trend: DataFrame, k: int = 5) -> DataFrame:
    """X1 report: per month the ``k`` largest share gains and losses (ties by name).

    The window per month holds one row per skill (<= 45 taxonomy skills).
    """
    by_month = Window.partitionBy("month")
    up = by_month.orderBy(F.col("share_change").desc(), "skill_name")
    down = by_month.orderBy(F.col("share_change").asc(), "skill_name")
    ranked = (trend.withColumn("gain_rank", F.row_number().over(up))
                   .withColumn("loss_rank", F.row_number().over(down)))
    return (ranked.filter((F.col("gain_rank") <= k) | (F.col("loss_rank") <= k))
                  .select("month", "skill_name", "share", "prev_share", "share_change",
                          "gain_rank", "loss_rank"))


def snapshot_changes(history: DataFrame) -> DataFrame:
    """Per snapshot, postings active, new (not in the previous snapshot), kept,
    and gone (in the previous snapshot, not in this one).

    ``history`` has one row per observation ``(slug, snapshot_date)``.
    """
    # the snapshot dates, listed once (one row per snapshot, bounded by the calendar; a pass
    # that reads the date column only) and used for numbering, the last index and the result
    dates = sorted(r[0] for r in history.select("snapshot_date").distinct().collect() if r[0] is not None)
    last_idx = len(dates)
    snaps = history.sparkSession.createDataFrame(
        [(d, i) for i, d in enumerate(dates, 1)], "snapshot_date date, idx int")
    obs = history.select("slug", "snapshot_date").distinct()
    o = obs.join(F.broadcast(snaps), "snapshot_date")
    w = Window.partitionBy("slug").orderBy("idx")
    o = o.withColumn("prev_idx", F.lag("idx").over(w)).withColumn("next_idx", F.lead("idx").over(w))
    is_new = F.col("prev_idx").isNull() | (F.col("prev_idx") < F.col("idx") - 1)
    ends = (F.col("next_idx").isNull() | (F.col("next_idx") > F.col("idx") + 1)) & (
        F.col("idx") < last_idx)
    # one pass: each observation counts where it is, and (if its run ends there)
    # as "gone" at the next snapshot; the index past the last snapshot is dropped
    # by the join with the snapshot table below
    two = F.explode(F.array(
        F.struct(F.col("idx").alias("idx"), F.lit(1).alias("n_active"),
                 is_new.cast("int").alias("n_new"), F.lit(0).alias("n_gone")),
        F.struct((F.col("idx") + 1).alias("idx"), F.lit(0).alias("n_active"), F.lit(0).alias("n_new"),
                 ends.cast("int").alias("n_gone"))))
    per = (o.select(two.alias("e")).select("e.*").groupBy("idx")
           .agg(F.sum("n_active").cast("long").alias("n_active"),
                F.sum("n_new").cast("long").alias("n_new"),
                F.sum("n_gone").cast("long").alias("n_gone")))
    return (per.join(F.broadcast(snaps), "idx")
            .select("snapshot_date", "n_active", "n_new",
                    (F.col("n_active") - F.col("n_new")).alias("n_kept"), "n_gone"))


def observations_from_lines(lines: DataFrame) -> DataFrame:
    """Posting observations from order lines: posting ``job-<order>`` seen in the
    weekly snapshot (Monday) of each of its lines' ship dates."""
    return lines.select(
        F.concat(F.lit("job-"), F.col("l_orderkey").cast("string")).alias("slug"),
        F.to_date(F.date_trunc("week", "l_shipdate")).alias("snapshot_date"))
