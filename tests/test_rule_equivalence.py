"""Optimised rule forms equal their plain forms on generated texts."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from hirescope.functions import taxonomy as T
from hirescope.functions import text as X

WORDS = ["python", "PYTHON", "PyThOn", "java", "JavaScript", "java script", "js", "Next.js",
         "next js", "nextjs", "React.js", "ts", "TypeScript", "type script", "golang", "go lang",
         "c++", "C++", "R", "r,", "für ", "R/", "sql", "PostgreSQL", "postgres", "k8s", "K8S",
         "kubernetes", "\u212a8s", "ſql", "SPAR\u212a", "İnternship", "Kafka", "Kafka", "AİRFLOW", "aırflow", "big query",
         "BigQuery", "scikit-learn", "sklearn", "xg boost", "LLMs", "large language model",
         "RAG", "retrieval-augmented", "hugging face", "power bi", "PowerBI", "aws",
         "amazon web services", "gcp", "google cloud", "fast api", "FastAPI", "apache spark",
         "pyspark", "spark", "dbt", "mlops", "excel", "excellent", "tableau", "€45.000–55.000",
         "45k - 60k EUR", "€18/Stunde", "25 eur pro Std.", "5 per head", "2024-2025", "45,5k-50k",
         "1.234.567 - 2.000.000", "€60,000 - €80,000", "30 to 40", "12,50 € per hour"]
SEPS = [" ", ", ", ". ", "\n", "-", "/", " ", "", "(", ")"]

def _texts(words, n, seed, max_parts=12):
    """n texts, each a seeded random sequence of rule words and separators."""
    rnd = random.Random(seed)
    return ["".join(rnd.choice(words) + rnd.choice(SEPS) for _ in range(rnd.randint(0, max_parts)))
            for _ in range(n)]


def test_gated_skills_equal_plain_skills(spark):
    batch = _texts(WORDS, 600, 1)
    df = spark.createDataFrame([(t,) for t in batch] + [(None,), ("",)], "t string")
    out = X.with_skills(df, "t").select(X.skills(F.col("t")).alias("plain"), "skills").collect()
    bad = [(batch[i] if i < len(batch) else None, r["plain"], r["skills"])
           for i, r in enumerate(out) if r["plain"] != r["skills"]]
    assert not bad, bad[:5]


def test_every_word_and_literal_is_lowercase_ascii():
    assert set(X.SKILL_WORDS) == set(T.SKILL_PATTERNS)
    for name in T.SKILL_PATTERNS:
        for k in (X.SKILL_WORDS[name] or []) + X.SKILL_LITERALS.get(name, []):
            assert k == k.lower() and k.isascii()
    assert all(re.fullmatch(r"\w+", k) for k in X._DICTIONARY)


#: what each skill's patterns match, every branch and option once
MATCHES = {
    "Python": ["python"], "R": ["R ", "r,", "R.", "r/", "R"], "SQL": ["sql"], "Java": ["java"],
    "JavaScript": ["javascript", "java script", "java\u2003script", "js"],
    "TypeScript": ["typescript", "type\tscript", "ts"], "Scala": ["scala"],
    "Go": ["golang", "go  lang"], "C++": ["c++", "c++x"], "Rust": ["rust"], "Pandas": ["pandas"],
    "NumPy": ["numpy"], "Spark": ["spark", "pyspark", "apache spark"], "dbt": ["dbt"],
    "Airflow": ["airflow"], "Snowflake": ["snowflake"], "BigQuery": ["bigquery", "big query"],
    "Databricks": ["databricks"], "Kafka": ["kafka"], "Redshift": ["redshift"],
    "Postgres": ["postgres", "postgresql"], "PyTorch": ["pytorch"],
    "TensorFlow": ["tensorflow", "tensor flow"],
    "scikit-learn": ["scikit-learn", "scikit learn", "sklearn"], "XGBoost": ["xgboost", "xg boost"],
    "LLM": ["llm", "llms", "large language model", "large language models"],
    "RAG": ["rag", "retrieval-augmented", "xretrieval augmentedx"], "LangChain": ["langchain"],
    "HuggingFace": ["huggingface", "hugging face"], "MLOps": ["mlops"], "Tableau": ["tableau"],
    "Power BI": ["powerbi", "power bi"], "Looker": ["looker"], "Metabase": ["metabase"],
    "Excel": ["excel"], "AWS": ["aws", "amazon web services"], "GCP": ["gcp", "google cloud"],
    "Azure": ["azure"], "Docker": ["docker"], "Kubernetes": ["kubernetes", "k8s"],
    "Terraform": ["terraform"], "React": ["react", "react.js"], "FastAPI": ["fastapi", "fast api"],
    "Django": ["django"], "Next.js": ["nextjs", "next.js"],
}


def test_words_miss_no_branch_of_any_pattern(spark):
    """Each branch alone, in three spellings, between every kind of neighbour."""
    assert set(MATCHES) == set(T.SKILL_PATTERNS)
    around = ["", " ", "-", "_", "\u00e9", "\u0307", "\u24d0", "\u2122", "\u00ad", "\u200d", "\u203f", "\ua7cb", "\ua7dc", "5", "+", "\U0001f600"]
    odd = str.maketrans({"i": "\u0130", "k": "\u212a", "s": "\u017f"})
    rows = [(name, before + spelt + after, before in ("", " ", "-") and after in ("", " ", "-"))
            for name, texts in MATCHES.items() for m in texts
            for spelt in (m, m.upper(), m.translate(odd)) for before in around for after in around]
    df = spark.createDataFrame(rows, "name string, t string, plain boolean").repartition(8)
    out = X.with_skills(df, "t").withColumn("want", X.skills(F.col("t")))
    assert not out.filter(~F.col("skills").eqNullSafe(F.col("want"))).select("t", "skills", "want").take(5)
    # the list above is no idle one: every branch does match (R wants nothing but its own ends)
    assert not out.filter("plain AND name NOT IN ('R') AND NOT array_contains(want, name)").select("name", "t").take(5)


def test_folding_makes_no_character_a_word_character(spark):
    """What cutting words relies on, for every code point."""
    cps = spark.range(1, 0x110000).filter("id < 55296 OR id > 57343")
    # behind an x: the decoder eats a byte order mark at the start
    c = F.substring(F.decode(F.unhex(F.concat(F.lit("00000078"), F.lpad(F.hex("id"), 8, "0"))), "utf-32"), 2, 1)
    d = cps.select("id", c.alias("c")).select("id", "c", X.fold(F.col("c")).alias("f"))
    assert d.filter(~F.col("c").rlike(r"(?U)^\w$") & F.col("f").rlike(r"\w")).count() == 0
    gone = [r.id for r in d.filter("length(f) = 0").collect()]
    assert gone == [0x307] and d.filter("id = 775").filter(F.col("c").rlike(r"(?U)^\w$")).count() == 1


def test_single_scan_salary_equals_group_rescans(spark):
    batch = _texts(WORDS, 600, 2)
    df = spark.createDataFrame([(t,) for t in batch], "t string")
    annual = "(?iU)" + T.SALARY_ANNUAL_RANGE
    t = F.coalesce(F.col("t"), F.lit(""))
    direct = [F.regexp_extract(t, annual, i).alias(f"d{i}") for i in (1, 2, 3, 4)]
    staged = df.select("*", *direct, *X.salary_extracts(F.col("t")))
    staged = staged.select("*", *X.salary_groups())
    rows = staged.collect()
    for r in rows:
        assert [r[f"d{i}"] for i in (1, 2, 3, 4)] == [r[f"_sal_a{i}"] for i in (1, 2, 3, 4)], r["t"]


GATE_WORDS = WORDS + ["English-speaking", "english only", "working language is English",
                      "no German needed", "English is sufficient", "fluent German",
                      "Deutsch auf C1", "Deutschkenntnisse erforderlich", "sehr gute deutschkenntnisse",
                      "verhandlungssicheres deutsch", "fließende deutsch", "german is a must",
                      "Werkstudent", "working student", "Internship", "intern", "internal",
                      "Praktikant", "praktikum", "Junior", "entry-level", "Einsteiger", "senior",
                      "Lead", "staff", "principal", "mid-level", "MID LEVEL", "Werkstudentin"]
def test_gated_gate_and_seniority_equal_plain(spark):
    batch = list(zip(_texts(GATE_WORDS, 800, 3, 4), _texts(GATE_WORDS, 800, 4, 10)))
    df = spark.createDataFrame(batch, "title string, t string")
    out = df.select(
        X.language_gate(F.col("t")).alias("g1"), X.language_gate(F.col("t"), gated=False).alias("g0"),
        X.seniority(F.col("title"), F.col("t")).alias("s1"),
        X.seniority(F.col("title"), F.col("t"), gated=False).alias("s0")).collect()
    bad = [(batch[i], r) for i, r in enumerate(out) if r["g1"] != r["g0"] or r["s1"] != r["s0"]]
    assert not bad, bad[:3]
    assert {r["g0"] for r in out} == {"english_ok", "german_required", "unclear"}
    assert len({r["s0"] for r in out}) == 6


def test_skills_take_one_scan(spark):
    """One regex pass finds all skills; no skill has a pass of its own."""
    df = X.with_skills(spark.createDataFrame([("We use Python, R and java script.",)], "t string"), "t")
    assert df.first()["skills"] == ["JavaScript", "Python", "R"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 1 and "RLIKE" not in plan


def test_marks_equal_patterns_next_to_every_character(spark):
    """Lowercasing makes no character a letter or a word character that the regexes do not take it for."""
    cps = spark.range(1, 0x110000).filter("id < 55296 OR id > 57343")
    c = F.substring(F.decode(F.unhex(F.concat(F.lit("00000078"), F.lpad(F.hex("id"), 8, "0"))), "utf-32"), 2, 1)
    t = F.concat(F.lit("a sql"), "c", F.lit("java"), "c", F.lit("r"), "c", F.lit("go"), "c", F.lit("lang big"), "c", F.lit("query "), "c", F.lit("k8s"))
    d = X.with_skills(cps.select("id", c.alias("c")).select("id", t.alias("t")).repartition(8, "id"), "t")
    names = ["SQL", "Java", "R", "Go", "BigQuery", "Kubernetes"]
    off = F.lit(False)
    for n in names:
        off = off | (F.array_contains("skills", n) != F.col("t").rlike("(?iU)" + X._alt(T.SKILL_PATTERNS[n])))
    # counted, not filtered: a filter would be pushed below the scan, with a copy of it per skill
    assert d.agg(F.min(F.when(off, F.col("id")))).first()[0] is None


def test_staged_salary_equals_plain_patterns(spark):
    """The fields from the text after its first digit, without what may stand before a number, and of the whole patterns."""
    batch = _texts(WORDS + ["\u0661\u0662k - 60k", "EUR 7", "\u20ac", "eur", "\n", "9 pro h", "12 /\u017ftd", "1.5k bi\u017f 20.000"], 1500, 5)
    df = spark.createDataFrame([(t,) for t in batch] + [(None,), ("",)], "t string")
    t = F.coalesce(F.col("t"), F.lit(""))
    annual = "(?iU)" + T.SALARY_ANNUAL_RANGE
    plain = df.select("*", F.regexp_extract(t, "(?iU)" + T.SALARY_HOURLY, 1).alias("_sal_h"),
                      *[F.regexp_extract(t, annual, i).alias(f"_sal_a{i}") for i in (1, 2, 3, 4)])
    plain = plain.select("*", *X.salary_numbers()).select("t", *[c.alias(f"want_{i}") for i, c in enumerate(X.salary_fields())])
    both = X.with_salary(plain, "t").collect()
    bad = [r for r in both if tuple(r[1:4]) != (r["salary_min_eur"], r["salary_max_eur"], r["salary_period"])]
    assert not bad, bad[:3]
    assert {r["salary_period"] for r in both} == {None, "hour", "year"}


def test_rules_look_at_a_letter_before_any_boundary(spark):
    import pytest

    for patterns in (T.ENGLISH_FRIENDLY_PATTERNS, T.GERMAN_REQUIRED_PATTERNS, *T.SENIORITY_PATTERNS.values()):
        regex = X._by_letter(patterns)
        assert regex.startswith("(?=[") and all(p.removeprefix(r"\b")[0] in regex[:regex.index("]")] for p in patterns)
        plan = spark.range(1).select(X.seniority(F.lit("a"), F.col("id").cast("string")),
                                     X.language_gate(F.col("id").cast("string")))._jdf.queryExecution().logical().toString()
        assert regex in plan
    for bad in ([r"\d+ years"], ["lead|staff"], ["Lead"]):
        with pytest.raises(ValueError):
            X._by_letter(bad)


def test_first_letter_forms_equal_plain_forms_beside_every_kind_of_neighbour(spark):
    found = ["english speaking", "english only", "working language is english", "no german needed", "muttersprachlicher deutsch",
             "deutsch auf c1", "verhandlungssicher deutsch", "native-level german", "fluent german", "business fluent german",
             "german is a must", "deutschkenntnisse zwingend", "sehr gute deutschkenntnisse", "werk student", "working student",
             "intern", "internship", "praktikum", "prakti kant", "junior", "einsteiger", "entry level", "senior", "lead", "staff",
             "principal", "mid-level"]
    sides = ["", " ", "-", "\n", "x", "_", "9", "ß", "é", "̇", "‍", " ", "ſ", "ı", "中"]
    texts = [a + w + b for w in found for a in sides for b in sides]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t, none = F.col("t"), F.lit("")
    bad = df.filter((X.language_gate(t) != X.language_gate(t, gated=False))
                    | (X.seniority(none, t) != X.seniority(none, t, gated=False))
                    | (X.seniority(t, none) != X.seniority(t, none, gated=False)))
    assert bad.count() == 0 and df.filter(X.seniority(none, t) != "unknown").count() > 100
