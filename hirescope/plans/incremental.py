"""Marts kept up to date by signed deltas (F6, F7, F8 after A4).

The fact is a bucketed table; every mart is backed by an additive count table.
A batch of new fact rows takes its old versions (the touched buckets' rows with
the batch's keys, nothing else of the fact is read) out of the counts and puts the
new ones in: one signed aggregation per mart, added to the stored counts. Pay
bands keep counts per (city, role family, pay value), from which exact quantiles
are read. The result equals a full refresh.

A batch has a version. Its rows (each enriched once), its deduplicated rows and the old rows it replaces are
stored first, count tables are written per version, and the fact's buckets
last, so a batch that failed is applied again from the same rows: nothing is
counted twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions import taxonomy as T
from hirescope.functions import text as X
from hirescope.operators import bucket_store as B
from hirescope.operators.dedup import HASH, ROW, rows_of, winners, with_hash, with_row
from hirescope.operators.quantiles import bucketed_quantiles
from hirescope.plans import models as M

SIGN = "_sign"
PAY = "salary_min_annualized_eur"
GATE_KEYS, DEMAND_KEYS, PAY_KEYS = ["city", "role_family"], ["skill_name", "city", "role_family", "week"], [
    "city", "role_family", PAY]


def _gates(*gates: str) -> list:
    return [F.sum(F.when(F.col("language_gate") == g, F.col(SIGN)).otherwise(0)).alias(f"n_{g}") for g in gates]


def gate_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GATE_KEYS).agg(F.sum(SIGN).alias("n"), *_gates("german_required", "english_ok", "unclear"))


def demand_counts(rows: DataFrame) -> DataFrame:
    week = X.week_start(F.col("posted_at")).alias("week")
    return (rows.select("city", "role_family", "language_gate", SIGN, week, M.explode_skills().alias("skill_name"))
            .filter(F.col("skill_name").isNotNull())
            .groupBy(*DEMAND_KEYS).agg(F.sum(SIGN).alias("n"), *_gates("german_required", "english_ok")))


def pay_counts(rows: DataFrame) -> DataFrame:
    return (rows.filter(F.col("seniority").isin(T.PAY_SENIORITIES)).groupBy(*PAY_KEYS)
            .agg(F.sum(SIGN).alias("n")))


TABLES = {"gate": (gate_counts, GATE_KEYS), "demand": (demand_counts, DEMAND_KEYS), "pay": (pay_counts, PAY_KEYS)}
#: the fact's columns that the marts count
COUNTED = ["slug", "city", "role_family", "language_gate", "posted_at", "seniority", PAY, "skills"]


def added(counts: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Stored counts plus a signed delta; cells without a row go."""
    sums = [F.sum(c).alias(c) for c in counts.columns if c not in keys]
    return counts.unionByName(delta).groupBy(*keys).agg(*sums).filter("n <> 0")


class IncrementalMarts:
    """The bucketed fact and the count tables under ``root``, as of ``version``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, version: int = 0):
        self.spark, self.root, self.buckets, self.version = spark, root.rstrip("/"), buckets, version

    def _path(self, table: str, version: int | None = None) -> str:
        return f"{self.root}/{table}" + ("" if version is None else f"/v={version}")

    def load(self, fct: DataFrame) -> None:
        """Version 0: the fact (one row per slug) and its counts."""
        B.create(fct, self._path("fact"), "slug", self.buckets)
        rows = B.read(self.spark, self._path("fact")).withColumn(SIGN, F.lit(1).cast("long"))
        for name, (count, _) in TABLES.items():
            count(rows).write.mode("overwrite").parquet(self._path(name, 0))

    def _stored(self, df: DataFrame, path: str) -> DataFrame:
        """The table at ``path``, written unless an earlier attempt has finished it."""
        try:
            return self.spark.read.parquet(path)
        except AnalysisException:
            df.write.mode("overwrite").parquet(path)
            return self.spark.read.parquet(path)

    def replaced_rows(self, batch: DataFrame) -> DataFrame:
        """The fact rows that ``batch`` (one row per slug) replaces: of its keys' buckets only."""
        touched = B.touched_buckets(batch, "slug", self.buckets)
        return B.read(self.spark, self._path("fact"), touched).select(*COUNTED).join(
            batch.select("slug"), "slug", "left_semi")

    def apply(self, batch: DataFrame, order: list[str]) -> list[int]:
        """The next version: ``batch`` (fact rows and order columns) upserted; returns the touched buckets."""
        v = self.version + 1
        columns = B.read(self.spark, self._path("fact")).drop(B.BUCKET).columns
        come = self._stored(with_row(with_hash(batch)), self._path("incoming", v))
        won = winners(come, ["slug"], [*order, HASH, ROW], last=True)
        new = self._stored(rows_of(come, won, ["slug"]).select(*columns), self._path("batch", v))
        old = self._stored(self.replaced_rows(new), self._path("replaced", v))
        signed = (new.select(*COUNTED).withColumn(SIGN, F.lit(1).cast("long"))
                  .unionByName(old.withColumn(SIGN, F.lit(-1).cast("long"))))
        for name, (count, keys) in TABLES.items():
            stored = self.spark.read.parquet(self._path(name, self.version))
            added(stored, count(signed), keys).write.mode("overwrite").parquet(self._path(name, v))
        # no column keeps its first value; the batch is stored, one row per slug
        touched = B.upsert_bucketed(self.spark, self._path("fact"), new, "slug", ["snapshot_date"], self.buckets, (), True)
        self.version = v
        return touched

    def _counts(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name, self.version))

    def fact(self) -> DataFrame:
        return B.read(self.spark, self._path("fact")).drop(B.BUCKET)

    def language_gate(self) -> DataFrame:
        """F6 from the counts."""
        c = self._counts("gate").withColumnRenamed("n", "n_postings").filter(
            F.col("n_postings") >= T.MIN_POSTINGS_LANGUAGE_GATE)
        return (c.withColumn("pct_german_required", X.pct(F.col("n_german_required"), F.col("n_postings")))
                .withColumn("pct_english_ok", X.pct(F.col("n_english_ok"), F.col("n_postings"))))

    def skill_demand(self) -> DataFrame:
        """F7 from the counts."""
        d = F.broadcast(M.dim_skills(self.spark).select("skill_name", F.col("category").alias("skill_category")))
        c = self._counts("demand").withColumnRenamed("n", "n_postings").join(d, "skill_name", "left")
        return c.withColumn("pct_german_required", X.pct(F.col("n_german_required"), F.col("n_postings")))

    def pay_bands(self, width: float = 1000.0) -> DataFrame:
        """F8 from the counts per pay value."""
        c, pay, n = self._counts("pay"), F.col(PAY), F.col("n")
        known = F.when(pay.isNotNull(), n).otherwise(0)
        agg = (c.groupBy(*GATE_KEYS).agg(F.sum(n).alias("n_postings"), F.sum(known).alias("n_with_salary"),
                                        F.sum(pay * n).alias("total"))
               .filter(F.col("n_postings") >= T.MIN_POSTINGS_PAY))
        q = bucketed_quantiles(c, GATE_KEYS, PAY, [0.25, 0.5, 0.75], width, weight="n")
        return agg.join(q, GATE_KEYS, "left").select(
            *GATE_KEYS, "n_postings", "n_with_salary",
            F.round(F.col("total") / F.nullif(F.col("n_with_salary"), F.lit(0)), 0).alias("avg_min_eur"),
            *[F.round(F.col(f"q{i}"), 0).alias(c) for i, c in enumerate(("p25_min_eur", "median_min_eur", "p75_min_eur"))])
