"""Partitioning for CPU-bound stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def cpu_partitions(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """Partitions of at most about ``per_part`` rows.

    Spark joins small shuffle partitions by their compressed bytes, of which narrow rows have few:
    a task then sorts a share of the table that grows with it. An explicit number is kept as it is.
    """
    return max(least, -(-rows // per_part))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-distribute the rows of ``df`` on ``key``; an explicit choice of the caller.

    Regex enrichment is CPU-bound while its input is small in bytes, so byte
    based splitting (one task per Parquet row group) can leave most cores idle.
    All columns of ``df`` are shuffled, texts included: use it for an input of few
    row groups, not for a large table, whose splits keep the cores busy. ``key``
    should be unique-ish (an id), so a hot value cannot pile up in one partition.
    """
    return df.repartition(cpu_partitions(df.sparkSession), key)
