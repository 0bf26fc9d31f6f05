"""Global ranks without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirescope.session import scratch_path


def ranked(df: DataFrame, order: list[Column], within: list[str] | None = None) -> DataFrame:
    """``df`` plus ``_rank``: its place (from 0) by ``order`` in its ``within`` group, or among all rows.

    Rows are dealt by ranges of (within, order) and stored with their range's
    number; each range is ranked by itself and shifted by the rows of its group in
    the ranges before, of which there are at most as many totals as ranges. A group of
    any size is thus spread over many tasks. Rows that tie share a range, so their
    places are any of the tie's. ``df`` should be narrow: it is written once.
    """
    keys = within or []
    spark = df.sparkSession
    path = scratch_path(spark, "ranked")
    (df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *order)
     .withColumn("_range", F.spark_partition_id()).write.parquet(path))
    dealt = spark.read.parquet(path)
    local = dealt.withColumn("_at", F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order)) - 1)
    totals = dealt.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_k__range"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    cond = F.col("_range") == F.col("_k__range")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return local.join(shifts, cond).withColumn("_rank", F.col("_at") + F.col("_before")).select(*df.columns, "_rank")
