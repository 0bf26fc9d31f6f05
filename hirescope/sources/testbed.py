"""Job postings derived from the warehouse tables.

The driver's tables carry no posting text, so postings are derived from
``orders ⋈ customer ⋈ nation``: one posting per order, every text field picked
from template lists by arithmetic on the order key (``k``) or customer key
(``c``). The same template lists render to Spark Columns (for the jobs) and to
DuckDB SQL (for the oracle), so both engines see byte-identical postings and
the row count grows with ``orders``.

The templates deliberately hit every enrichment rule, including its traps:
order-sensitive role families, near-miss seniority words, the German
``Voraussetzung`` phrase that can never match, first-match-only salary
parsing, the 3-digit cut of an unseparated upper bound, hourly "per head",
substring city aliases (``Hessen`` -> Essen) and letter-run title case.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.operators.partitioning import spread
from hirescope.sources.tables import read_table

# Integer expressions over k (order key) usable verbatim in Spark SQL and DuckDB.
VARS: dict[str, str] = {
    "a": "(30 + k % 41)",
    "b": "(35 + k % 41 + k % 23)",
    "r": "(12 + k % 19)",
    "x": "(200 + k % 100)",
}

TITLES = [
    "Werkstudent Data Analyst (m/w/d)",
    "Senior Data Scientist",
    "Junior Data Engineer",
    "Machine Learning Engineer - Working Student",
    "Analytics Engineer",
    "Business Intelligence Developer",
    "BI Analyst Intern",
    "Software Engineer, Data Platform",
    "AI Engineer (LLM)",
    "Backend Developer",
    "Praktikum Data Science",
    "Mid-Level Frontend Engineer",
    "Team Lead GenAI",
    "Werkstudenten-Koordination Marketing",
]

# {n} is the customer's nation name
LOCATIONS = [
    "Berlin, Germany",
    "München",
    "Muenchen, DE",
    "Köln",
    "Hamburg",
    "",
    ", Germany",
    "baden-baden, DE",
    "Hessen",
    "Frankfurt am Main",
    "Düsseldorf",
    "Oslo, Norway",
    "  leipzig \t",
    "Mannheim/Berlin",
    "NÜRNBERG",
    "{n}, EU",
    "st. ingbert-west, Saarland",
]

INTROS = [
    "Join our team.",
    "Wir suchen Verstärkung.",
    "",
]

SKILL_SENTENCES_A = [
    "We use Python and SQL heavily.",
    "Experience with R, pandas and NumPy is a plus.",
    "Our stack: Java, Scala, Spark and Kafka.",
    "Strong JS skills required; TypeScript and React.js are used daily.",
    "You know Golang or Rust; C++ is nice to have.",
    "We build pipelines with dbt, Airflow and Snowflake on BigQuery.",
    "Databricks, Redshift and PostgreSQL power our platform.",
    "Models in PyTorch, TensorFlow, scikit-learn and XGBoost.",
    "We ship LLMs with RAG, LangChain and Hugging Face; MLOps matters.",
    "Dashboards in Tableau, Power BI, Looker, Metabase and Excel.",
    "Cloud: AWS, GCP, Azure, Docker, Kubernetes and Terraform.",
]

SKILL_SENTENCES_B = [
    "Our web apps use FastAPI, Django and Next.js.",
    "JavaScript experience is required.",
    "Know java script and type script.",
    "We run everything on k8s with Amazon Web Services.",
    "Knowledge of large language models and retrieval-augmented generation.",
    "Python. Python. Python.",
    "Tools für alle: sklearn, pyspark, big query.",
    "Apache Spark and go lang on Google Cloud.",
    "We like Postgres, nextjs, fast api and PowerBI.",
    "",
    "Java developers with TS knowledge.",
    "Tensor Flow, XG Boost, huggingface and LLM work.",
    "Small team, language: R/Python.",
]

LANGUAGE_PHRASES = [
    "Sehr gute Deutschkenntnisse erforderlich.",
    "Our working language is English.",
    "Fluent German is a must.",
    "This is an English-speaking team, fluent German is a plus.",
    "",
    "Verhandlungssicheres Deutsch in Wort und Schrift.",
    "Deutschkenntnisse Voraussetzung.",
    "No German required, English is sufficient.",
    "Deutsch auf C1-Niveau.",
]

SENIORITY_PHRASES = [
    "You will lead a small team.",
    "Great for an entry-level candidate.",
    "Work on internal tools.",
    "2 to 3 years of experience required.",
    "",
    "Paid internship possible.",
]

SALARY_PHRASES = [
    "Gehalt: €{a}.000–{b}.000 pro Jahr",
    "Salary: {a}k - {b}k EUR per year",
    "€{a},000 - €{b},000 per year",
    "Vergütung: €{r}/Stunde",
    "€{r} per hour",
    "{r} EUR pro Stunde",
    "{a}000-{b}000 EUR",
    "Stundenlohn {r},50 € pro Std.",
    "Budget {a},5k-{b}k EUR",
    "Budget 2024-2025, €{a}.000-{b}.000",
    "Bonus: 5 per head",
    "€{a}k to €{b}k annually",
    "Vergütung {a}.000 bis {b}.000 EUR",
    "€{x} per hour",
    "Salary: 1.234.567 - 2.000.000",
    "",
    "{a}.5k - {b}k",
]

# (template list, key expression used for the pick)
PICKS = {
    "title": (TITLES, "k"),
    "location": (LOCATIONS, "c"),
    "intro": (INTROS, "k"),
    "skills_a": (SKILL_SENTENCES_A, "k"),
    "skills_b": (SKILL_SENTENCES_B, "k"),
    "language": (LANGUAGE_PHRASES, "k"),
    "seniority": (SENIORITY_PHRASES, "k"),
    "salary": (SALARY_PHRASES, "k"),
}
DESCRIPTION_PARTS = ["intro", "skills_a", "skills_b", "language", "seniority", "salary"]

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def _pieces(template: str) -> list[tuple[str, str]]:
    """Split a template into ("lit", text) / ("var", name) pieces."""
    out, pos = [], 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            out.append(("lit", template[pos:m.start()]))
        out.append(("var", m.group(1)))
        pos = m.end()
    if pos < len(template):
        out.append(("lit", template[pos:]))
    return out


# -- Spark ------------------------------------------------------------------

_ARG_ORDER = ["a", "b", "r", "x", "n"]


def _format_of(template: str) -> str:
    """Template -> java format string with positional arguments (``{a}`` -> ``%1$s``)."""
    out = []
    for kind, val in _pieces(template):
        out.append(val.replace("%", "%%") if kind == "lit" else f"%{_ARG_ORDER.index(val) + 1}$s")
    return "".join(out)


def _spark_pick(options: list[str], key: str) -> Column:
    """``options[key % len]`` as a lookup in a literal array (compact code even
    when the optimizer copies the expression into a pushed-down filter)."""
    idx = (F.col(key) % F.lit(len(options)) + F.lit(1)).cast("int")
    if not any(kind == "var" for t in options for kind, _ in _pieces(t)):
        return F.element_at(F.array(*[F.lit(t) for t in options]), idx)
    fmt = F.element_at(F.array(*[F.lit(_format_of(t)) for t in options]), idx)
    args = [F.expr(VARS[v]).cast("string") if v != "n" else F.col("n_name") for v in _ARG_ORDER]
    return F.call_function("format_string", fmt, *args)


def keys(spark: SparkSession, base: str) -> DataFrame:
    """The narrow columns of orders, customer and nation from which postings are made, one row each."""
    o = read_table(spark, base, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, base, "customer", "c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, base, "nation", "n_nationkey", "n_name")
    # nation is a fixed 25-row dimension: broadcasting it is size-bounded.
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
             .select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"),
                     "o_orderdate", "c_name", "n_name"))


def postings(spark: SparkSession, base: str) -> DataFrame:
    """Raw postings (the ``raw_jobs`` shape) derived from orders, customer, nation."""
    # Enrichment costs ~70 regex searches per posting, CPU-bound while the keys are a few
    # bytes: the narrow key columns are dealt over the cores before any text exists.
    return from_keys(spread(keys(spark, base), "k"))


def from_keys(j: DataFrame, *kept: str) -> DataFrame:
    """The postings of the rows of :func:`keys`, made where they lie, and the ``kept`` columns of ``j``."""
    picks = {name: _spark_pick(opts, key) for name, (opts, key) in PICKS.items()}
    description = F.concat_ws(" ", *[F.nullif(picks[p], F.lit("")) for p in DESCRIPTION_PARTS])
    ts = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("k") % 24).cast("int"))
    created = (F.when(F.col("k") % 50 == 0, F.lit("not a date"))
               .when(F.col("k") % 50 == 25, F.lit(None).cast("string"))
               .otherwise(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))))
    return j.select(
        F.concat(F.lit("job-"), F.col("k").cast("string")).alias("slug"),
        picks["title"].alias("title"),
        F.col("c_name").alias("company_name"),
        picks["location"].alias("location"),
        (F.col("k") % 20 < 7).alias("remote"),
        F.concat(F.lit("https://jobs.example/"), F.col("k").cast("string")).alias("url"),
        F.array(F.lit("data"), F.lower(F.col("n_name"))).alias("tags"),
        F.when(F.col("k") % 3 == 0, F.array(F.lit("werkstudent")))
        .otherwise(F.array(F.lit("full-time"))).alias("job_types"),
        description.alias("description"),
        created.alias("created_at"),
        F.date_add(F.to_date("o_orderdate"), ((F.col("k") % 4) * 7).cast("int")).alias("snapshot_date"),
        *kept,
    )


# -- DuckDB -----------------------------------------------------------------

def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_template(template: str) -> str:
    parts = []
    for kind, val in _pieces(template):
        if kind == "lit":
            parts.append(_sql_lit(val))
        elif val == "n":
            parts.append("n_name")
        else:
            parts.append(f"CAST({VARS[val]} AS VARCHAR)")
    return " || ".join(parts) if parts else "''"


def _sql_pick(options: list[str], key: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {_sql_template(t)}" for i, t in enumerate(options))
    return f"(CASE {key} % {len(options)} {whens} END)"


def postings_sql() -> str:
    """DuckDB SELECT producing the same rows as :func:`postings`."""
    picks = {name: _sql_pick(opts, key) for name, (opts, key) in PICKS.items()}
    desc = "concat_ws(' ', " + ", ".join(f"NULLIF({picks[p]}, '')" for p in DESCRIPTION_PARTS) + ")"
    ts = "(o_orderdate + to_hours(CAST(k % 24 AS INTEGER)))"
    created = (f"(CASE WHEN k % 50 = 0 THEN 'not a date' WHEN k % 50 = 25 THEN NULL "
               f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '+00:00' END)")
    return f"""
SELECT
  'job-' || CAST(k AS VARCHAR) AS slug,
  {picks['title']} AS title,
  c_name AS company_name,
  {picks['location']} AS location,
  (k % 20 < 7) AS remote,
  'https://jobs.example/' || CAST(k AS VARCHAR) AS url,
  ['data', lower(n_name)] AS tags,
  CASE WHEN k % 3 = 0 THEN ['werkstudent'] ELSE ['full-time'] END AS job_types,
  {desc} AS description,
  {created} AS created_at,
  CAST(o_orderdate AS DATE) + CAST((k % 4) * 7 AS INTEGER) AS snapshot_date
FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate FROM orders) o
JOIN customer cu ON cu.c_custkey = o.c
JOIN nation na ON na.n_nationkey = cu.c_nationkey
"""
