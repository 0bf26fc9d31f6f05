"""Synthetic job postings (A9) with the sample generator's distributions.

Every random draw is a pure function of ``(id, seed, salt)`` through
``xxhash64``, so generation is a projection over an id column: it runs on any
number of partitions and a lost task recomputes exactly the same rows. Same
distributions as the sample generator, not the same draws.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (the sample generator's word lists and probabilities)
# ---------------------------------------------------------------------------
CITIES = [
    ("Berlin", "Berlin, Germany"),
    ("Munich", "Munich, Germany"),
    ("Hamburg", "Hamburg, Germany"),
    ("Frankfurt", "Frankfurt, Germany"),
    ("Cologne", "Cologne, Germany"),
    ("Leipzig", "Leipzig, Germany"),
    ("Stuttgart", "Stuttgart, Germany"),
    ("Dresden", "Dresden, Germany"),
]
ROLE_TEMPLATES = [
    ("Werkstudent Data Analytics (m/w/d)", "Analytics", ["Python", "SQL", "Excel", "Tableau"]),
    ("Werkstudent:in Data Science", "DS/ML", ["Python", "SQL", "Pandas", "scikit-learn"]),
    ("Working Student - Machine Learning", "DS/ML", ["Python", "PyTorch", "MLOps"]),
    ("Data Analyst (Werkstudent)", "Analytics", ["SQL", "Power BI", "Excel"]),
    ("Junior Data Engineer", "Data Eng", ["Python", "SQL", "Airflow", "Snowflake"]),
    ("Werkstudent Business Intelligence", "Analytics", ["SQL", "Looker", "dbt"]),
    ("AI Engineering Intern", "AI", ["Python", "LLM", "RAG", "LangChain"]),
    ("Data Scientist (m/w/d) - Werkstudent", "DS/ML", ["Python", "XGBoost", "SQL"]),
    ("Software Engineering Intern - Data Platform", "Software Eng", ["Python", "Kafka", "Docker"]),
    ("Werkstudent GenAI / LLM Engineering", "AI", ["Python", "LLM", "HuggingFace", "PyTorch"]),
    ("Analytics Engineer (Junior)", "Data Eng", ["dbt", "SQL", "BigQuery"]),
    ("Werkstudent BI & Reporting", "Analytics", ["SQL", "Power BI", "Excel"]),
]
COMPANIES = [
    "Zalando", "Delivery Hero", "N26", "Trade Republic", "Personio", "Celonis",
    "Wayfair", "HelloFresh", "SAP", "Siemens Healthineers", "Mercedes-Benz Tech",
    "Allianz", "Otto Group", "About You", "Flink", "GetYourGuide", "IONOS",
    "1&1", "T-Systems", "Deutsche Bahn Digital", "Bosch", "Continental",
]
GERMAN_PHRASES = [
    "Sehr gute Deutschkenntnisse erforderlich (mind. C1).",
    "Verhandlungssicheres Deutsch in Wort und Schrift.",
    "Fließende Deutschkenntnisse zwingend notwendig.",
    "Deutsch auf Muttersprachenniveau.",
]
ENGLISH_PHRASES = [
    "Our working language is English — no German required.",
    "This is an English-speaking role.",
    "English is sufficient; German is a nice-to-have.",
]
SALARY_TEMPLATES_ANNUAL = [
    "Gehalt: €{lo}.000–{hi}.000 pro Jahr",
    "Salary range: €{lo},000 - €{hi},000 per year",
    "Wir bieten {lo}k–{hi}k EUR p.a.",
]
SALARY_TEMPLATES_HOURLY = [
    "Vergütung: €{rate}/Stunde",
    "€{rate} per hour",
    "{rate} EUR pro Stunde",
]
RESPONSIBILITIES = ("You'll work on production data pipelines, dashboards for stakeholders, "
                    "and experiments that shape product decisions. ")
P_REMOTE = 0.35
P_WERKSTUDENT_PREFIX = 0.2
P_LANGUAGE = [("german_required", 0.35), ("english_ok", 0.4), ("unclear", 0.25)]
P_SALARY = 0.30
P_HOURLY_FOR_STUDENTS = 0.6
HOURLY_RANGE = (15, 28)
ANNUAL_LOW_RANGE = (35, 70)
ANNUAL_SPREAD_RANGE = (10, 30)
MAX_AGE_DAYS = 40
# ---------------------------------------------------------------------------
# END FIXED VALUES
# ---------------------------------------------------------------------------


class _Draws:
    def __init__(self, ids: Column, seed: int):
        self.ids, self.seed = ids, seed

    def uniform(self, salt: str) -> Column:
        h = F.xxhash64(self.ids, F.lit(self.seed), F.lit(salt))
        return F.pmod(h, F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))

    def integer(self, salt: str, lo: int, hi: int) -> Column:
        """Uniform integer in [lo, hi]."""
        return (F.lit(lo) + F.floor(self.uniform(salt) * F.lit(hi - lo + 1))).cast("int")


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + F.lit(1))


def _fmt(templates: list[str], idx: Column, **args: Column) -> Column:
    names = list(args)
    fmts = [t.replace("%", "%%").format(**{n: f"%{i + 1}$s" for i, n in enumerate(names)})
            for t in templates]
    return F.call_function("format_string", _pick(fmts, idx),
                           *[args[n].cast("string") for n in names])


def synth_postings(ids: DataFrame, id_col: str = "id", as_of: Column | None = None,
                   seed: int = 42) -> DataFrame:
    """One posting per id, in the raw-table shape (``created_at`` as ISO text)."""
    d = _Draws(F.col(id_col), seed)
    now = as_of if as_of is not None else F.current_timestamp().cast("timestamp_ntz")
    city_i = d.integer("city", 0, len(CITIES) - 1)
    tmpl_i = d.integer("template", 0, len(ROLE_TEMPLATES) - 1)
    base_title = _pick([t for t, _, _ in ROLE_TEMPLATES], tmpl_i)
    role = _pick([r for _, r, _ in ROLE_TEMPLATES], tmpl_i)
    stack = _pick([", ".join(s) for _, _, s in ROLE_TEMPLATES], tmpl_i)
    city = _pick([c for c, _ in CITIES], city_i)
    title = (F.when(~base_title.contains("Werkstudent")
                    & (d.uniform("prefix") < P_WERKSTUDENT_PREFIX),
                    F.concat(F.lit("Werkstudent "), base_title)).otherwise(base_title))
    senior = (F.when(title.contains("Werkstudent"), F.lit("werkstudent"))
              .when(title.contains("Intern"), F.lit("intern"))
              .when(title.contains("Junior"), F.lit("junior")).otherwise(F.lit("unknown")))
    u_lang = d.uniform("lang")
    lang_line = (F.when(u_lang < P_LANGUAGE[0][1],
                        _pick(GERMAN_PHRASES, d.integer("de", 0, len(GERMAN_PHRASES) - 1)))
                 .when(u_lang < P_LANGUAGE[0][1] + P_LANGUAGE[1][1],
                       _pick(ENGLISH_PHRASES, d.integer("en", 0, len(ENGLISH_PHRASES) - 1)))
                 .otherwise(F.lit("")))
    lo = d.integer("lo", *ANNUAL_LOW_RANGE)
    hi = lo + d.integer("spread", *ANNUAL_SPREAD_RANGE)
    rate = d.integer("rate", *HOURLY_RANGE)
    hourly = senior.isin("werkstudent", "intern") & (d.uniform("hourly") < P_HOURLY_FOR_STUDENTS)
    sal_line = (F.when(d.uniform("salary") >= P_SALARY, F.lit(""))
                .when(hourly, _fmt(SALARY_TEMPLATES_HOURLY,
                                   d.integer("ht", 0, len(SALARY_TEMPLATES_HOURLY) - 1), rate=rate))
                .otherwise(_fmt(SALARY_TEMPLATES_ANNUAL,
                                d.integer("at", 0, len(SALARY_TEMPLATES_ANNUAL) - 1), lo=lo, hi=hi)))
    intro = F.concat(F.lit("Join our "), role, F.lit(" team in "), city, F.lit(". "))
    parts = [intro, F.lit(RESPONSIBILITIES), F.concat(F.lit("Our stack includes "), stack, F.lit(".")),
             lang_line, sal_line]
    description = F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts])
    company = _pick(COMPANIES, d.integer("company", 0, len(COMPANIES) - 1))
    slug = F.concat_ws("-", F.regexp_replace(F.lower(company), " ", "-"),
                       F.substring(F.regexp_replace(F.lower(title), " ", "-"), 1, 40),
                       F.col(id_col).cast("string"))
    posted = now - F.make_dt_interval(days=d.integer("age", 0, MAX_AGE_DAYS))
    job_types = (F.when(senior == "werkstudent", F.array(F.lit("werkstudent")))
                 .when(senior == "intern", F.array(F.lit("intern")))
                 .otherwise(F.array(F.lit("full-time"))))
    return ids.select(
        slug.alias("slug"), title.alias("title"), company.alias("company_name"),
        _pick([loc for _, loc in CITIES], city_i).alias("location"),
        (d.uniform("remote") < P_REMOTE).alias("remote"),
        F.concat(F.lit("https://postings.example/"), F.col(id_col).cast("string")).alias("url"),
        F.array(F.lower(role), F.lower(city)).alias("tags"),
        job_types.alias("job_types"),
        description.alias("description"),
        F.concat(F.date_format(posted, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("created_at"),
        F.to_date(now).alias("snapshot_date"),
    )
