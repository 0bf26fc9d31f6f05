"""Column-pruned reads of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(base: str, name: str) -> str:
    base = base.rstrip("/")
    return f"{base}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan of one table; when ``cols`` are given only they are read."""
    df = spark.read.parquet(table_path(base, name))
    return df.select(*cols) if cols else df
