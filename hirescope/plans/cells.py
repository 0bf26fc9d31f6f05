"""Headline numbers under any filter from additive cells (E3, C5, G1), and pay quantiles from stored sketches.

A cell is a (city, role family, language gate). Counts and sums add up over cells;
distinct companies do not, so a cell also holds them as bitmaps: companies are
numbered once (by parallel ranks over the distinct names), and a cell has one
bitmap of 32,768 bits per bucket of numbers that it meets. The or of bitmaps over
any selection of cells counts its distinct companies exactly, without the fact.

Pay sketches are KLL sketches per (month, city), of ``SKETCH_K`` entries a level; they
merge over any range of months and any cities. A quantile read from a merged
sketch has a rank within ``RANK_ERROR`` of the one asked for (99 % of the time, by
the sketch's analysis; all values are kept, and the answer is exact, up to about
``SKETCH_K`` values).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirescope.operators.ranking import ranked

CELL = ["city", "role_family", "language_gate"]
SKETCH_K = 800
RANK_ERROR = 0.01
PAY = "salary_min_annualized_eur"


def company_numbers(fct: DataFrame) -> DataFrame:
    """(company_name, company): the distinct names, numbered from 0."""
    names = fct.select("company_name").filter("company_name is not null").distinct()
    return ranked(names, [F.col("company_name").asc()]).withColumnRenamed("_rank", "company")


def kpi_cells(fct: DataFrame) -> DataFrame:
    """The additive part: one row per cell."""
    s = F.col(PAY)
    return fct.groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("n_jobs"), F.count(F.when(F.col("remote"), 1)).alias("n_remote"),
        F.count(s).alias("n_salary"), F.sum(s).alias("salary"))


def company_bitmaps(fct: DataFrame, numbers: DataFrame) -> DataFrame:
    """(cell, bucket, companies): bitmaps of the companies of every cell."""
    pairs = fct.select(*CELL, "company_name").distinct().join(numbers, "company_name")
    # bitmap positions count from 1
    at = F.col("company") + 1
    return (pairs.groupBy(*CELL, F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("companies")))


def _all_or_each(df: DataFrame) -> DataFrame:
    """Every row once per subset of the cell columns, the others null, with the subset's name."""
    sets = []
    for m in range(1 << len(CELL)):
        kept = [c for i, c in enumerate(CELL) if m >> i & 1]
        sets.append(F.struct(F.lit("+".join(kept) or "all").alias("by"), *[
            (F.col(c) if c in kept else F.lit(None).cast("string")).alias(c) for c in CELL]))
    rest = [c for c in df.columns if c not in CELL]
    return df.select(*rest, F.explode(F.array(*sets)).alias("g")).select("g.*", *rest)


def kpi_by_every_filter(cells: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """G1 for every choice of one city or all, one role family or all, one gate or all."""
    keys = ["by", *CELL]
    sums = _all_or_each(cells).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n_jobs", "n_remote", "n_salary", "salary")])
    each = _all_or_each(bitmaps).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("companies").alias("companies"))
    companies = each.groupBy(*keys).agg(F.sum(F.bitmap_count("companies")).alias("n_companies"))
    s, c = sums.alias("s"), companies.alias("c")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}"))
    return s.join(c, same, "left").select(
        *[F.col(f"s.{k}").alias(k) for k in keys], "n_jobs", F.coalesce("n_companies", F.lit(0).cast("long")).alias("n_companies"),
        "n_remote", F.round(F.col("salary") / F.nullif(F.col("n_salary"), F.lit(0)), 2).alias("avg_salary"))


def kpi_filtered(cells: DataFrame, bitmaps: DataFrame, where: Column) -> DataFrame:
    """G1 under any filter over the cell columns: one row."""
    n = (bitmaps.filter(where).groupBy("bucket").agg(F.bitmap_or_agg("companies").alias("companies"))
         .agg(F.coalesce(F.sum(F.bitmap_count("companies")), F.lit(0).cast("long")).alias("n_companies")))
    s = cells.filter(where).agg(
        F.coalesce(F.sum("n_jobs"), F.lit(0).cast("long")).alias("n_jobs"), F.sum("n_remote").alias("n_remote"),
        F.round(F.sum("salary") / F.nullif(F.sum("n_salary"), F.lit(0)), 2).alias("avg_salary"))
    # two rows of one row each
    return s.withColumn("_k", F.lit(1)).join(n.withColumn("_k", F.lit(1)), "_k").drop("_k")


def pay_sketches(fct: DataFrame) -> DataFrame:
    """(month, city, n, sketch): one KLL sketch of the annual pay per month and city."""
    return (fct.filter(F.col(PAY).isNotNull() & F.col("posted_at").isNotNull())
            .groupBy(F.date_trunc("month", "posted_at").cast("date").alias("month"), "city")
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(PAY, F.lit(SKETCH_K)).alias("sketch")))


def merged_quantiles(sketches: DataFrame, by: list[Column], probs: list[float]) -> DataFrame:
    """Quantiles of the sketches merged by ``by``: one column ``q<i>`` per probability."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select("*", *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(f"q{i}")
                                for i, p in enumerate(probs)]).drop("sketch")


def rank_checks(fct: DataFrame, quantiles: DataFrame, by: list[Column], names: list[str], probs: list[float]) -> DataFrame:
    """Per group: its rows, and whether every quantile's true rank lies within the stated error."""
    values = fct.filter(F.col(PAY).isNotNull() & F.col("posted_at").isNotNull()).select(*by, F.col(PAY).alias("v"))
    v = F.col("v")
    below = values.join(quantiles, names).groupBy(*names).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(v < F.col(f"q{i}"), 1)).alias(f"lo{i}") for i in range(len(probs))],
        *[F.count(F.when(v <= F.col(f"q{i}"), 1)).alias(f"hi{i}") for i in range(len(probs))])
    n, ok = F.col("n_rows"), F.lit(True)
    for i, p in enumerate(probs):
        # a repeated value covers a span of ranks; one row more or less for the definition of a quantile
        ok = ok & (F.col(f"lo{i}") <= (p + RANK_ERROR) * n + 1) & (F.col(f"hi{i}") >= (p - RANK_ERROR) * n - 1)
    return below.select(*names, "n_rows", ok.alias("within_error"))
