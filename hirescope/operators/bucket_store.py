"""A table kept in hash buckets of its key, of which an upsert rewrites the touched ones only (A4, A5).

The bucket is the partition directory ``_bucket``, so a read for some keys prunes
to their buckets and an overwrite (dynamic partitions) leaves all other files as
they are. The new content of the touched buckets is stored first and then
moved over the old, so nothing is overwritten while it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.operators.partitioning import parts_for
from hirescope.operators.upsert import upsert
from hirescope.session import scratch_path

BUCKET = "_bucket"
#: rows of a bucket's file; a larger bucket is written by several tasks
FILE_ROWS = 500_000


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _write(df: DataFrame, path: str, key: str, buckets: int) -> None:
    # a bucket is as many files as its rows need, each of one task; other bits of the hash than the bucket's
    parts = parts_for(df.count(), FILE_ROWS * buckets)
    part = F.pmod(F.shiftright(F.xxhash64(key), 32), F.lit(parts))
    (df.repartition(BUCKET, part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(path))


def create(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A new bucketed table (``df`` has one row per key)."""
    _write(with_bucket(df, key, buckets), path, key, buckets)


def read(spark: SparkSession, path: str, touched: list[int] | None = None) -> DataFrame:
    """The table, or its ``touched`` buckets only (pruned at the scan)."""
    df = spark.read.parquet(path)
    return df if touched is None else df.filter(F.col(BUCKET).isin(touched))


def touched_buckets(batch: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets of the batch's keys (at most ``buckets`` numbers)."""
    return sorted(r[0] for r in with_bucket(batch, key, buckets).select(BUCKET).distinct().collect())


def upsert_bucketed(spark: SparkSession, path: str, batch: DataFrame, key: str, order: list[str], buckets: int,
                    keep_first: tuple[str, ...] = (), unique: bool = False) -> list[int]:
    """Last write wins (:func:`hirescope.operators.upsert.upsert`) on the touched buckets; returns these.

    ``unique``: the batch is a stored table of one row per key.
    """
    touched = touched_buckets(batch, key, buckets)
    if not touched:
        return []
    old = read(spark, path, touched).drop(BUCKET)
    staged = scratch_path(spark, "touched-buckets")
    with_bucket(upsert(old, batch, key, order, keep_first, unique=unique), key, buckets).write.parquet(staged)
    _write(spark.read.parquet(staged), path, key, buckets)
    return touched
