"""The warehouse models: enrichment, dimension, bridge, staging, fact, marts.

Model order is plain function composition (F9): ``raw -> staging -> fact ->
marts``. Enrichment is a projection of the raw rows, so staging computes it in
the same scan; :func:`staging_from` keeps the table-in/table-out form (raw
LEFT JOIN enriched on slug) for when both tables already exist.

Scale notes
* ``staging``/``fact`` are narrow (no shuffle); the ~70 regex evaluations per
  posting run once per row in codegen'd projections. Persist the fact
  (``write_table``) when several marts are built from it, so the regexes do
  not run once per mart.
* Each mart is one hash aggregation with map-side partial aggregation, so a
  hot (city, role) group collapses to one row per map task before the
  shuffle; hot keys cannot overload a reducer.
* ``mart_skill_demand`` explodes the fact's skill array instead of joining the
  bridge (fact and bridge share the slug, and the bridge *is* the explode),
  which removes the fact/bridge shuffle join. The dimension is the fixed
  45-row taxonomy, so broadcasting it is size-bounded by construction.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions import taxonomy as T
from hirescope.functions import text as X
from hirescope.operators.quantiles import bucketed_quantiles
from hirescope.session import scratch_path, session_id

ENRICHED_COLUMNS = ["slug", "city", "seniority", "language_gate", "salary_min_eur",
                    "salary_max_eur", "salary_period", "skills_json"]

FACT_COLUMNS = ["slug", "title", "company_name", "city", "remote", "url", "posted_at",
                "snapshot_date", "seniority", "language_gate", "salary_min_eur",
                "salary_max_eur", "salary_period", "salary_min_annualized_eur",
                "role_family", "description", "skills_json"]


def _enrich(raw: DataFrame) -> DataFrame:
    """raw + city, seniority, language_gate, salary_*, skills, skills_json."""
    df = X.with_texts_rules(raw).select("*", X.city(F.col("location"), F.col("remote")).alias("city"))
    return df.withColumn("skills_json", X.skills_json(F.col("skills")))


def enrich(raw: DataFrame) -> DataFrame:
    """F1 ``enriched_jobs``: one row per raw row; empty in gives empty out."""
    return _enrich(raw).select(*ENRICHED_COLUMNS, "skills")


def dim_skills(spark: SparkSession) -> DataFrame:
    """F2 / B2: the fixed skill dimension (45 rows)."""
    rows = [(name, cat) for name, cat, _ in T.SKILLS]
    return spark.createDataFrame(rows, "skill_name string, category string")


def explode_skills(skills_col: str = "skills"):
    """``explode`` written as ``explode_outer`` + NULL filter (same rows).

    A plain ``explode`` makes the optimizer infer ``size(skills) > 0`` and push
    it down to the scan, which re-evaluates all 45 skill regexes there.
    """
    return F.explode_outer(skills_col)


def dim_with_usage(dim: DataFrame, bridge_df: DataFrame) -> DataFrame:
    """The skill dimension (every row) with the number of postings per skill (0 if none)."""
    counts = bridge_df.groupBy("skill_name").agg(F.count(F.lit(1)).alias("n_postings"))
    # both sides have at most one row per taxonomy skill (45): a small join
    return (dim.join(F.broadcast(counts), "skill_name", "left")
               .select("skill_name", "category",
                       F.coalesce("n_postings", F.lit(0).cast("long")).alias("n_postings")))


def bridge(enriched_or_fact: DataFrame) -> DataFrame:
    """F3 ``bridge_job_skill``: one row per (slug, skill)."""
    return (enriched_or_fact.select("slug", explode_skills().alias("skill_name"))
            .filter(F.col("skill_name").isNotNull()))


def _stg_select(df: DataFrame) -> DataFrame:
    return df.select(
        "slug", "title", "company_name", F.col("location").alias("raw_location"), "city",
        "remote", "url", X.posted_at(F.col("created_at")).alias("posted_at"),
        "snapshot_date", "tags", "job_types", "description", "seniority", "language_gate",
        "salary_min_eur", "salary_max_eur", "salary_period", "skills_json", "skills")


def staging(raw: DataFrame) -> DataFrame:
    """F4 ``stg_jobs`` computed in one pass over raw (enrichment inline)."""
    return _stg_select(_enrich(raw))


def staging_from(raw: DataFrame, enriched: DataFrame) -> DataFrame:
    """F4 in table form: raw LEFT JOIN enriched USING (slug)."""
    return _stg_select(raw.join(enriched, "slug", "left"))


def fact(stg: DataFrame) -> DataFrame:
    """F5 ``fct_jobs`` (keeps the ``skills`` array for explode-based marts)."""
    return stg.select(
        "slug", "title", "company_name", "city", "remote", "url", "posted_at",
        "snapshot_date", "seniority", "language_gate", "salary_min_eur", "salary_max_eur",
        "salary_period",
        X.annualized(F.col("salary_min_eur"), F.col("salary_period"))
        .alias("salary_min_annualized_eur"),
        X.role_family(F.col("title")).alias("role_family"),
        "description", "skills_json", "skills")


def _count_if(cond) -> F.Column:
    # SUM(CASE ..) semantics: NULL over no rows (count_if would give 0)
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def mart_language_gate(fct: DataFrame) -> DataFrame:
    """German/English share by city x role family, >= 3 postings."""
    g = F.col("language_gate")
    agg = fct.groupBy("city", "role_family").agg(
        F.count(F.lit(1)).alias("n_postings"),
        _count_if(g == "german_required").alias("n_german_required"),
        _count_if(g == "english_ok").alias("n_english_ok"),
        _count_if(g == "unclear").alias("n_unclear"),
    )
    return (agg.filter(F.col("n_postings") >= T.MIN_POSTINGS_LANGUAGE_GATE)
               .withColumn("pct_german_required",
                           X.pct(F.col("n_german_required"), F.col("n_postings")))
               .withColumn("pct_english_ok", X.pct(F.col("n_english_ok"), F.col("n_postings"))))


def skill_mentions(fct: DataFrame) -> DataFrame:
    """D2 without a shuffle: the fact's skill array exploded (== fact JOIN bridge)."""
    return (fct.select("slug", "city", "role_family", "language_gate", "posted_at",
                       explode_skills().alias("skill_name"))
            .filter(F.col("skill_name").isNotNull()))


def mart_skill_demand(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """counts per skill x city x role family x week, with category and German %."""
    g = F.col("language_gate")
    counts = (skill_mentions(fct)
              .withColumn("week", X.week_start(F.col("posted_at")))
              .groupBy("skill_name", "city", "role_family", "week")
              .agg(F.count(F.lit(1)).alias("n_postings"),
                   _count_if(g == "german_required").alias("n_german_required"),
                   _count_if(g == "english_ok").alias("n_english_ok")))
    d = F.broadcast(dim.select("skill_name", F.col("category").alias("skill_category")))
    return (counts.join(d, "skill_name", "left")
                  .withColumn("pct_german_required",
                              X.pct(F.col("n_german_required"), F.col("n_postings"))))


def mart_pay_bands(fct: DataFrame, approx: bool = False, method: str | None = None,
                   bucket_width: float = 1000.0) -> DataFrame:
    """F8: pay bands for werkstudent/intern/junior by city x role, >= 2 postings.

    ``method``:
    * ``"bucketed"`` (default): exact, without ever holding a group's values in
      one task (``operators.quantiles.bucketed_quantiles``).
    * ``"percentile"``: exact, same numbers, one pass (partial + final aggregation);
      the final merge for a group holds that group's distinct pay values.
    * ``"approx"`` (or ``approx=True``): ``percentile_approx``, fixed-size sketch.
    """
    method = method or ("approx" if approx else "bucketed")
    s = F.col("salary_min_annualized_eur")
    probs = [0.25, 0.5, 0.75]
    rows = fct.filter(F.col("seniority").isin(T.PAY_SENIORITIES))
    base = [F.count(F.lit(1)).alias("n_postings"), F.count(s).alias("n_with_salary"),
            F.round(F.avg(s), 0).alias("avg_min_eur")]
    names = ["p25_min_eur", "median_min_eur", "p75_min_eur"]
    if method == "bucketed":
        agg = rows.groupBy("city", "role_family").agg(*base).filter(
            F.col("n_postings") >= T.MIN_POSTINGS_PAY)
        q = bucketed_quantiles(rows, ["city", "role_family"], "salary_min_annualized_eur",
                               probs, bucket_width)
        # both sides hold one row per (city, role) group
        out = agg.join(q, ["city", "role_family"], "left")
        return out.select("city", "role_family", "n_postings", "n_with_salary", "avg_min_eur",
                          *[F.round(F.col(f"q{i}"), 0).alias(n) for i, n in enumerate(names)])
    qs = F.array(*[F.lit(p) for p in probs])
    q = F.percentile_approx(s, qs, 10000) if method == "approx" else F.percentile(s, qs)
    agg = rows.groupBy("city", "role_family").agg(*base, q.alias("_q"))
    return (agg.filter(F.col("n_postings") >= T.MIN_POSTINGS_PAY)
               .select("city", "role_family", "n_postings", "n_with_salary", "avg_min_eur",
                       *[F.round(F.col("_q")[i].cast("double"), 0).alias(n)
                         for i, n in enumerate(names)]))


_STORED_FACTS: dict[tuple, str] = {}


def _source_signature(base: str) -> tuple:
    """Paths, sizes and modification times (ns) of the local source files (empty if remote)."""
    local = base[len("file:"):] if base.startswith("file:") else base
    if not os.path.isdir(local):
        return ()
    sig = []
    for root, _, files in os.walk(local):
        for f in sorted(files):
            st = os.stat(os.path.join(root, f))
            sig.append((os.path.join(root, f), st.st_size, st.st_mtime_ns))
    return tuple(sorted(sig))


class Warehouse:
    """All models of one run (F9), built from a raw postings frame.

    The fact is a *table*: built once (enrichment runs once per posting), written
    as Parquet under the shared checkpoint folder and read back by every mart,
    report and the salary model. Reading it back also cuts the lineage, so the
    marts' filters and column selections reach the Parquet scan (PushedFilters,
    ReadSchema) instead of being pushed through the regex projections.
    ``key`` identifies the inputs; the stored fact is reused for the same key
    within a session.
    """

    def __init__(self, spark: SparkSession, raw: DataFrame, key: tuple | None = None):
        self.spark = spark
        self.raw = raw
        # inputs that cannot be told apart (remote storage) are not shared between instances
        self.key = key if key is None or key[-1] else None
        self._fact_path: str | None = None

    def enriched(self) -> DataFrame:
        return enrich(self.raw)

    def dim_skills(self) -> DataFrame:
        return dim_skills(self.spark)

    def bridge(self) -> DataFrame:
        return bridge(self.fact())

    def staging(self) -> DataFrame:
        return staging(self.raw)

    def fact_plan(self) -> DataFrame:
        return fact(staging(self.raw))

    def fact(self) -> DataFrame:
        key = None if self.key is None else (session_id(self.spark),) + self.key
        path = self._fact_path or (_STORED_FACTS.get(key) if key else None)
        if path is None:
            path = scratch_path(self.spark, "fct_jobs")
            write_table(self.fact_plan(), path)
            if key:
                _STORED_FACTS[key] = path
        self._fact_path = path
        return self.spark.read.parquet(path)

    def mart_language_gate(self) -> DataFrame:
        return mart_language_gate(self.fact())

    def register_views(self) -> None:
        """The models as temporary views, for ``spark.sql`` users."""
        views = {"raw_jobs": self.raw, "enriched_jobs": self.enriched(),
                 "dim_skills": self.dim_skills(), "stg_jobs": self.staging(),
                 "fct_jobs": self.fact(), "bridge_job_skill": self.bridge(),
                 "mart_language_gate": self.mart_language_gate(),
                 "mart_skill_demand": self.mart_skill_demand(),
                 "mart_werkstudent_pay": self.mart_pay_bands()}
        for name, df in views.items():
            df.createOrReplaceTempView(name)

    def mart_skill_demand(self) -> DataFrame:
        return mart_skill_demand(self.fact(), self.dim_skills())

    def mart_pay_bands(self) -> DataFrame:
        return mart_pay_bands(self.fact())


MODEL_TABLES = ["raw_jobs", "enriched_jobs", "dim_skills", "bridge_job_skill", "fct_jobs",
                "mart_skill_demand", "mart_werkstudent_pay", "mart_language_gate"]


def require_rows(df: DataFrame, what: str) -> None:
    """Stop early with a clear message when an input table is empty."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty: nothing to build")


def run_all(spark: SparkSession, raw: DataFrame, out_dir: str) -> dict[str, str]:
    """build every model in dependency order and write each as Parquet (A5).

    The raw table is written first; enrichment, fact and marts are then built
    from the written copy, so the regex work runs once and every later model
    reads files. Returns table name -> path.
    """
    out = out_dir.rstrip("/")
    paths = {t: f"{out}/{t}" for t in MODEL_TABLES}
    write_table(raw, paths["raw_jobs"])
    stored_raw = spark.read.parquet(paths["raw_jobs"])
    require_rows(stored_raw, "raw_jobs")
    write_table(fact(staging(stored_raw)), paths["fct_jobs"])
    fct = spark.read.parquet(paths["fct_jobs"])
    write_table(fct.select(*ENRICHED_COLUMNS), paths["enriched_jobs"])
    dim = dim_skills(spark)
    write_table(dim, paths["dim_skills"])
    write_table(bridge(fct), paths["bridge_job_skill"])
    write_table(mart_skill_demand(fct, spark.read.parquet(paths["dim_skills"])),
                paths["mart_skill_demand"])
    write_table(mart_pay_bands(fct), paths["mart_werkstudent_pay"])
    write_table(mart_language_gate(fct), paths["mart_language_gate"])
    return paths


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A5 sink: full-refresh overwrite as Parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
