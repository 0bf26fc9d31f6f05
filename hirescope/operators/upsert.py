"""Upsert on a key: last write wins, some columns keep their first value (A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.operators.dedup import rows_of, winners, with_hash
from hirescope.session import scratch_path


def upsert(target: DataFrame, batch: DataFrame, key: str, order: list[str],
           keep_first: tuple[str, ...] = ("ingested_at",), won: DataFrame | None = None,
           unique: bool = False) -> DataFrame:
    """``INSERT OR REPLACE`` semantics as a new version of ``target``.

    * within the batch the last row per key (by ``order``) wins;
    * a key already in ``target`` is replaced by the batch row, except the
      ``keep_first`` columns, which keep the target's value;
    * target rows whose key is not in the batch pass through untouched.

    Rows that tie in key and order leave one row. ``won`` are the winning (key,
    order, hash) rows of the batch where the caller has picked them already (from
    a batch that carries the hash column or row numbers). An empty target has no first values to look up.
    ``unique``: the batch is a stored table of one row per key, used as it is. The target is never aggregated: it is anti-joined with
    the batch's keys.
    The deduplicated batch is written once as a table, so that its key column can
    be read alone and its size is known; whether it is broadcast is Spark's
    choice by its own threshold. The result has the target's columns; ``order``
    columns are dropped.
    """
    cols = target.columns
    spark = target.sparkSession
    if unique:
        latest = batch.select(*cols)
    else:
        path = scratch_path(spark, "upsert-batch")
        if won is None:
            batch = with_hash(batch)
            won = winners(batch, [key], order, last=True)
        rows_of(batch, won, [key]).select(*cols).write.option("compression", "zstd").parquet(path)
        latest = spark.read.schema(target.schema).parquet(path)
    if target.isEmpty():
        return latest
    keys = latest.select(key)
    untouched = target.join(keys, key, "left_anti")
    if not keep_first:
        return untouched.unionByName(latest)
    firsts = target.select(key, *[F.col(c).alias(f"_first_{c}") for c in keep_first]).join(keys, key, "left_semi")
    replaced = latest.join(firsts, key, "left")
    replaced = replaced.select(*[
        F.coalesce(F.col(f"_first_{c}"), F.col(c)).alias(c) if c in keep_first else F.col(c)
        for c in cols])
    return untouched.unionByName(replaced)
