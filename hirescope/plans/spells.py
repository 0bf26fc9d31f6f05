"""Posting spells (X3): when a posting appeared, when it was gone, how long it lived.

A spell is a run of consecutive snapshots that hold a posting (gaps and islands
over the snapshot index). A posting that comes back starts a new spell. The
window per posting holds one row per snapshot of it, so a hot slug is bounded by
the number of snapshots. Lifetimes of spells that the last snapshot still holds
are censored: the product-limit curve counts them at risk up to that point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirescope.operators.partitioning import cpu_partitions, parts_for

#: observations that one task sorts
TASK_ROWS = 500_000


def snapshot_index(history: DataFrame) -> DataFrame:
    """(snapshot_date, idx, next_date): the snapshots in order, one row each (bounded by the calendar)."""
    dates = sorted(r[0] for r in history.select("snapshot_date").distinct().collect() if r[0] is not None)
    after = [*dates[1:], None]
    return history.sparkSession.createDataFrame(
        [(d, i, n) for i, (d, n) in enumerate(zip(dates, after), 1)],
        "snapshot_date date, idx int, next_date date")


def posting_spells(history: DataFrame) -> DataFrame:
    """One row per spell of ``history`` (slug, snapshot_date).

    ``appeared``: its first snapshot; ``last_seen``: its last; ``gone_at``: the
    first snapshot without it (null while open); ``gap``: snapshots missed since the
    spell before (null for the first). Rows without a slug or date are in no spell,
    repeated rows count once.
    """
    index = F.broadcast(snapshot_index(history))
    # dealt once by posting, to as many tasks as the rows need: the passes below stay where the rows lie
    parts = parts_for(history.count(), TASK_ROWS, cpu_partitions(history.sparkSession))
    seen = (history.select("slug", "snapshot_date").filter("slug is not null").repartition(parts, "slug").distinct()
            .join(index, "snapshot_date"))
    by = Window.partitionBy("slug").orderBy("idx")
    runs = seen.withColumn("run", F.col("idx") - F.row_number().over(by))
    spells = runs.groupBy("slug", "run").agg(
        F.min("snapshot_date").alias("appeared"), F.max("snapshot_date").alias("last_seen"),
        F.count(F.lit(1)).alias("n_snapshots"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"),
        F.max_by("next_date", "idx").alias("gone_at"))
    nth = Window.partitionBy("slug").orderBy("run")
    return spells.select(
        "slug", F.row_number().over(nth).alias("spell"), "appeared", "last_seen", "gone_at", "n_snapshots",
        F.col("gone_at").isNull().alias("is_open"),
        (F.col("first_idx") - F.lag("last_idx").over(nth) - 1).alias("gap"))


def posting_survival(spells: DataFrame, cohort: str = "year(appeared)") -> DataFrame:
    """Product-limit curve of spell lengths, in snapshots, per cohort.

    Per length with an end or a censoring: spells at risk (as long or longer), ended,
    censored, the share that outlives it, and its standard error (Greenwood).
    The windows run over one row per cohort and length (at most one per snapshot).
    """
    lengths = (spells.groupBy(F.expr(cohort).alias("cohort"), F.col("n_snapshots").alias("length"))
               .agg(F.sum(F.when(F.col("is_open"), 0).otherwise(1)).alias("n_ended"),
                    F.sum(F.when(F.col("is_open"), 1).otherwise(0)).alias("n_censored")))
    longer = Window.partitionBy("cohort").orderBy(F.desc("length"))
    upto = Window.partitionBy("cohort").orderBy("length")
    at_risk = lengths.withColumn("n_at_risk", F.sum(F.col("n_ended") + F.col("n_censored")).over(longer))
    n, d = F.col("n_at_risk").cast("double"), F.col("n_ended").cast("double")
    # all at risk ended: the curve is 0 from here on (and its logarithm has no value)
    last = F.max(F.when(d == n, 1).otherwise(0)).over(upto)
    log = F.sum(F.when(d < n, F.log((n - d) / n))).over(upto)
    spread = F.sum(F.when(d < n, d / (n * (n - d)))).over(upto)
    curve = F.when(last == 1, F.lit(0.0)).otherwise(F.exp(log))
    return at_risk.select(
        "cohort", "length", "n_at_risk", "n_ended", "n_censored", F.round(curve, 6).alias("survival"),
        F.round(F.when(last == 1, F.lit(0.0)).otherwise(curve * F.sqrt(spread)), 6).alias("std_error"))
