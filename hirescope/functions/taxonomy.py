"""Rule tables used by the text-enrichment columns.

Everything between the FIXED VALUES markers must stay equal to the rules the
posting pipeline is specified with: skill names, categories and patterns,
language-gate phrases, seniority patterns, salary number grammar, city
aliases, role-family title fragments and the model constants. They are data,
kept in their natural order, because order matters for several rules (first
city alias wins, English phrases are checked before German ones, seniority
levels have a priority).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the specified rules exactly; do not reorder)
# ---------------------------------------------------------------------------

# skill name, category, patterns (searched case-insensitively in the raw text)
SKILLS: list[tuple[str, str, list[str]]] = [
    # languages
    ("Python", "language", [r"\bpython\b"]),
    ("R", "language", [r"(?<![A-Za-z])R(?:\s|,|\.|/|$)"]),
    ("SQL", "language", [r"\bSQL\b"]),
    ("Java", "language", [r"\bjava\b(?!\s*script)"]),
    ("JavaScript", "language", [r"\bjava\s*script\b", r"\bjs\b"]),
    ("TypeScript", "language", [r"\btype\s*script\b", r"\bts\b"]),
    ("Scala", "language", [r"\bscala\b"]),
    ("Go", "language", [r"\bgolang\b", r"\bgo\s+lang\b"]),
    ("C++", "language", [r"\bc\+\+"]),
    ("Rust", "language", [r"\brust\b"]),
    # data
    ("Pandas", "data", [r"\bpandas\b"]),
    ("NumPy", "data", [r"\bnumpy\b"]),
    ("Spark", "data", [r"\b(pyspark|apache\s+spark|\bspark)\b"]),
    ("dbt", "data", [r"\bdbt\b"]),
    ("Airflow", "data", [r"\bairflow\b"]),
    ("Snowflake", "data", [r"\bsnowflake\b"]),
    ("BigQuery", "data", [r"\bbig\s*query\b"]),
    ("Databricks", "data", [r"\bdatabricks\b"]),
    ("Kafka", "data", [r"\bkafka\b"]),
    ("Redshift", "data", [r"\bredshift\b"]),
    ("Postgres", "data", [r"\bpostgres(ql)?\b"]),
    # ml / ai
    ("PyTorch", "ml", [r"\bpytorch\b"]),
    ("TensorFlow", "ml", [r"\btensor\s*flow\b"]),
    ("scikit-learn", "ml", [r"\bscikit[- ]learn\b", r"\bsklearn\b"]),
    ("XGBoost", "ml", [r"\bxg\s*boost\b"]),
    ("LLM", "ml", [r"\bLLM(s)?\b", r"\blarge language model"]),
    ("RAG", "ml", [r"\bRAG\b", r"retrieval[- ]augmented"]),
    ("LangChain", "ml", [r"\blangchain\b"]),
    ("HuggingFace", "ml", [r"\bhugging\s*face\b"]),
    ("MLOps", "ml", [r"\bmlops\b"]),
    # bi / analytics
    ("Tableau", "bi", [r"\btableau\b"]),
    ("Power BI", "bi", [r"\bpower\s*bi\b"]),
    ("Looker", "bi", [r"\blooker\b"]),
    ("Metabase", "bi", [r"\bmetabase\b"]),
    ("Excel", "bi", [r"\bexcel\b"]),
    # cloud / infra
    ("AWS", "cloud", [r"\bAWS\b", r"\bamazon web services\b"]),
    ("GCP", "cloud", [r"\bGCP\b", r"\bgoogle cloud\b"]),
    ("Azure", "cloud", [r"\bazure\b"]),
    ("Docker", "cloud", [r"\bdocker\b"]),
    ("Kubernetes", "cloud", [r"\bkubernetes\b", r"\bk8s\b"]),
    ("Terraform", "cloud", [r"\bterraform\b"]),
    # web
    ("React", "web", [r"\breact(?:\.js)?\b"]),
    ("FastAPI", "web", [r"\bfast\s*api\b"]),
    ("Django", "web", [r"\bdjango\b"]),
    ("Next.js", "web", [r"\bnext\.?js\b"]),
]

# language gate: searched in the lowercased text, English phrases first
GERMAN_REQUIRED_PATTERNS: list[str] = [
    r"\bmuttersprachlich(e[rns]?)?\s+deutsch",
    r"deutsch\s*(auf|in|:)?\s*(mutter|c[12]|b[12]|native)",
    r"verhandlungssicher(e|es)?\s+deutsch",
    r"fließend(e[rns]?)?\s+deutsch",
    r"deutsch(kenntnisse|sprachig)\s+(erforderlich|zwingend|notwendig|Voraussetzung)",
    r"sehr\s+gute\s+deutschkenntnisse",
    r"native[- ]level\s+german",
    r"fluent\s+german",
    r"business[- ]fluent\s+german",
    r"german\s+(is\s+)?(a\s+)?(must|required|mandatory)",
]
ENGLISH_FRIENDLY_PATTERNS: list[str] = [
    r"english[- ]speaking",
    r"english\s+only",
    r"working\s+language\s+is\s+english",
    r"no\s+german\s+(required|needed)",
    r"english\s+is\s+sufficient",
]
LANGUAGE_GATES: list[str] = ["english_ok", "german_required", "unclear"]

# seniority: searched in lowercased "title\ndescription"
SENIORITY_PATTERNS: dict[str, list[str]] = {
    "werkstudent": [r"\bwerk\s*student(in)?\b", r"\bworking\s+student\b"],
    "intern": [r"\bintern(ship)?\b", r"\bpraktikum\b", r"\bprakti\s*kant"],
    "junior": [r"\bjunior\b", r"\beinsteiger\b", r"\bentry[- ]level\b"],
    "senior": [r"\bsenior\b", r"\blead\b", r"\bstaff\b", r"\bprincipal\b"],
    "mid": [r"\bmid[- ]level\b"],
}
SENIORITY_PRIORITY: list[str] = ["werkstudent", "intern", "senior", "junior", "mid"]
SENIORITY_UNKNOWN = "unknown"

# salary grammar (case-insensitive); hourly is tried before the annual range
SALARY_NUMBER = r"(\d{1,3}(?:[.,]\d{3})*(?:[.,]\d+)?|\d+)"
SALARY_CURRENCY = r"(?:€|EUR|eur)"
SALARY_ANNUAL_RANGE = (
    SALARY_CURRENCY + r"?\s*" + SALARY_NUMBER + r"(k)?\s*(?:-|–|to|bis)\s*"
    + SALARY_CURRENCY + r"?\s*" + SALARY_NUMBER + r"(k)?\s*" + SALARY_CURRENCY + r"?"
)
SALARY_HOURLY = (
    SALARY_CURRENCY + r"?\s*" + SALARY_NUMBER + r"\s*" + SALARY_CURRENCY
    + r"?\s*(?:/|pro|per)\s*(?:h(?:our)?|Stunde|Std)\.?"
)
HOURLY_MIN, HOURLY_MAX = 5.0, 150.0
ANNUAL_MIN, ANNUAL_MAX = 10_000.0, 500_000.0

# city aliases, first contained alias (in this order) wins
CITY_ALIASES: list[tuple[str, str]] = [
    ("berlin", "Berlin"), ("munich", "Munich"), ("münchen", "Munich"),
    ("muenchen", "Munich"), ("hamburg", "Hamburg"), ("cologne", "Cologne"),
    ("köln", "Cologne"), ("koeln", "Cologne"), ("frankfurt", "Frankfurt"),
    ("stuttgart", "Stuttgart"), ("leipzig", "Leipzig"), ("dresden", "Dresden"),
    ("düsseldorf", "Düsseldorf"), ("duesseldorf", "Düsseldorf"),
    ("hannover", "Hannover"), ("nuremberg", "Nuremberg"), ("nürnberg", "Nuremberg"),
    ("bremen", "Bremen"), ("essen", "Essen"), ("dortmund", "Dortmund"),
    ("karlsruhe", "Karlsruhe"), ("mannheim", "Mannheim"),
]
CITY_REMOTE, CITY_UNKNOWN = "Remote", "Unknown"

# role family: first group with a fragment contained in the lowercased title
ROLE_FAMILY_RULES: list[tuple[str, list[str]]] = [
    ("DS/ML", ["data scien", "machine learn", "ml engineer"]),
    ("Analytics", ["data analyst", "analytics", "bi "]),
    ("Data Eng", ["data engineer", "data platform"]),
    ("AI", ["ai ", "llm", "genai"]),
    ("Software Eng", ["backend", "frontend", "fullstack", "software"]),
]
ROLE_FAMILY_OTHER = "Other"
ROLE_FAMILIES: list[str] = [r for r, _ in ROLE_FAMILY_RULES] + [ROLE_FAMILY_OTHER]

# annualisation of hourly pay: hours per week x weeks per year
HOURS_PER_WEEK, WEEKS_PER_YEAR = 20, 52

# pay-band seniorities and HAVING floors of the marts and reports
PAY_SENIORITIES: list[str] = ["werkstudent", "intern", "junior"]
MIN_POSTINGS_LANGUAGE_GATE = 3
MIN_POSTINGS_PAY = 2
MIN_TOTAL_GATED_SKILL = 5

# report sizes
TOP_CITIES_REPORT = 15
TOP_SKILLS_REPORT = 25
TOP_GATED_SKILLS = 20
HEATMAP_TOP_SKILLS = 15
HEATMAP_TOP_CITIES = 10

# salary model
TOP_N_CITIES = 12
MIN_TRAINING_ROWS = 30
MIN_SKILL_FREQ = 8
TOP_K_SKILLS = 20
MIN_GROUPS_FOR_GROUP_KFOLD = 3
MIN_ROWS_PER_FEATURE = 5
TRAIN_SALARY_MIN, TRAIN_SALARY_MAX = 10_000, 250_000
N_FOLDS, N_REPEATS, CV_SEED = 5, 5, 42
TOP_DRIVERS = 25
GBT_TREES, GBT_DEPTH, GBT_LEARNING_RATE = 150, 3, 0.05
GBT_MIN_CHILD, GBT_SUBSAMPLE, GBT_COLSAMPLE, GBT_SEED = 5, 0.8, 0.8, 42

# ---------------------------------------------------------------------------
# END FIXED VALUES
# ---------------------------------------------------------------------------

SKILL_NAMES_SORTED: list[str] = sorted(name for name, _, _ in SKILLS)
SKILL_CATEGORY: dict[str, str] = {name: cat for name, cat, _ in SKILLS}
SKILL_PATTERNS: dict[str, list[str]] = {name: pats for name, _, pats in SKILLS}
