"""Ingest path: pages -> normalised rows -> batch dedup -> upsert (A1-A5).

``load_files`` follows the offline loader (every row of every file upserted
in load order, no dedup); ``ingest_batch`` follows the API loader (drop empty
slugs, first row per (slug, snapshot_date), then upsert). Both produce a new
version of the raw table; ``write_version`` stores it as Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.operators.dedup import ROW, winners, with_row
from hirescope.operators.upsert import upsert
from hirescope.session import scratch_path
from hirescope.sources import postings_json as J

RAW_SCHEMA = ("slug string, title string, company_name string, location string, "
              "remote boolean, url string, tags array<string>, job_types array<string>, "
              "description string, created_at string, snapshot_date date, "
              "raw_payload string, ingested_at timestamp_ntz")


def empty_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_SCHEMA)


def read_batch(spark: SparkSession, path: str, multi_line: bool = True,
               ingested_at: Column | None = None) -> DataFrame:
    """A1 + A2: normalised rows of every page under ``path`` with order columns."""
    return J.normalize(J.read_pages(spark, path, multi_line), ingested_at)


def staged(batch: DataFrame) -> DataFrame:
    """The batch as a stored table: pages are parsed once, and the passes that
    pick winners read the key and order columns only."""
    path = scratch_path(batch.sparkSession, "ingest-batch")
    batch.write.option("compression", "zstd").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def load_files(target: DataFrame, spark: SparkSession, path: str, multi_line: bool = True,
               ingested_at: Column | None = None) -> DataFrame:
    """Offline load: all rows, later rows replace earlier ones with the same slug."""
    batch = staged(read_batch(spark, path, multi_line, ingested_at))
    return upsert(target, batch, "slug", J.ORDER_COLUMNS)


def load_sample(spark: SparkSession, path: str, target: DataFrame | None = None,
                multi_line: bool = True) -> tuple[DataFrame, int]:
    """A1 as a job: (new raw table, number of posting rows read, duplicates included).

    No dedup and no empty-slug filter, as the offline loader; a directory
    without page files is an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", J.PAGE_FILES).load(path)
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no page files in {path}")
    batch = staged(read_batch(spark, path, multi_line))
    n = batch.count()
    return upsert(target if target is not None else empty_raw(spark), batch, "slug",
                  J.ORDER_COLUMNS), n


def ingest_batch(target: DataFrame, spark: SparkSession, path: str, multi_line: bool = True,
                 ingested_at: Column | None = None) -> DataFrame:
    """API-style ingest: A3 dedup of the batch, then A4 upsert into ``target``.

    The first row per (slug, snapshot_date), then the last of those per slug, are
    picked on narrow rows; the whole rows are then filtered by their numbers.
    """
    batch = staged(read_batch(spark, path, multi_line, ingested_at).filter(F.col("slug") != "").transform(with_row))
    firsts = winners(batch, ["slug", "snapshot_date"], [*J.ORDER_COLUMNS, ROW])
    won = winners(firsts, ["slug"], [*J.ORDER_COLUMNS, ROW], last=True)
    return upsert(target, batch, "slug", J.ORDER_COLUMNS, won=won)


def write_version(df: DataFrame, path: str) -> None:
    """A5: a new full version of the raw table (never overwrites the one being read)."""
    df.write.mode("errorifexists").parquet(path)
