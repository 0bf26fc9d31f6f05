"""Top-k and bounded-broadcast helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, by: list[Column], tie_break: list[str]) -> DataFrame:
    """``ORDER BY by..., tie_break ASC LIMIT k``.

    Planned as ``TakeOrderedAndProject``: every partition keeps its own k best
    rows and only those reach the final merge, so the cost is one pass with no
    full sort or shuffle of the input. The ascending key tie-break makes the
    kept set deterministic when scores tie.
    """
    return df.orderBy(*by, *[F.col(c).asc_nulls_last() for c in tie_break]).limit(k)


def semi_join_small(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """``df LEFT SEMI JOIN keys`` with ``keys`` broadcast.

    Only for key sets whose size is bounded by construction (a top-k result or a
    fixed dimension); the caller guarantees the bound.
    """
    return df.join(F.broadcast(keys), on, "left_semi")
