"""Text-enrichment rules as Spark Column expressions.

Every rule is built from JVM-side SQL functions only (``rlike``,
``regexp_extract``, ``instr``, ``when`` ...), so enrichment stays inside
whole-stage codegen and runs wherever the table's partitions live. No Python
UDF is involved. Most rules are Column -> Column functions; ``with_skills`` and
``with_salary`` take a DataFrame because they stage intermediate columns (a
case-folded text, the regex matches) in their own projections so that an
expensive expression is computed once per row rather than once per use.

Regex dialect notes: Java's ``\\b``, ``\\s`` and case folding are ASCII-only
unless ``(?U)`` is given; the rules are specified with Unicode semantics, so
every pattern is compiled with ``(?U)`` (plus ``(?i)`` where the rule is
case-insensitive).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirescope.functions import taxonomy as T


def _alt(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def _by_letter(patterns: list[str]) -> str:
    """:func:`_alt` of patterns that begin with a lower-case ASCII letter, which is looked at first.

    Elsewhere a scan then fails at once, before any boundary is looked for. To be searched in
    lowercased text without regard to which pattern is found.
    """
    words = [p.removeprefix(r"\b") for p in patterns]
    if not all("a" <= w[0] <= "z" and "|" not in _outside_groups(w) for w in words):
        raise ValueError(f"not all begin with a letter: {patterns}")
    letters = "".join(sorted({w[0] for w in words}))
    bound = all(p.startswith(r"\b") for p in patterns)
    return f"(?=[{letters}])" + (rf"\b(?:{_alt(words)})" if bound else f"(?:{_alt(patterns)})")


def _outside_groups(pattern: str) -> str:
    depth, out = 0, ""
    for c in pattern:
        depth += (c == "(") - (c == ")")
        out += c if depth == 0 else ""
    return out


def _nz(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# -- B1 skills -------------------------------------------------------------

def skills(text: Column) -> Column:
    """Sorted, de-duplicated array of skill names found in ``text``.

    One ``rlike`` per skill (its patterns joined into one alternation); the
    candidate array is laid out in sorted name order, so dropping the misses
    leaves the result sorted without a per-row sort. NULL or empty text gives
    an empty array.
    """
    t = _nz(text)
    hits = [
        F.when(t.rlike("(?iU)" + _alt(T.SKILL_PATTERNS[name])), F.lit(name))
        for name in T.SKILL_NAMES_SORTED
    ]
    return F.array_compact(F.array(*hits))


# The skills' patterns cut in two, (what is found, what must follow it), behind a word boundary: a
# skill matches if one of its texts is found. No two skills share one, and none starts
# within what another takes, so that one scan finds them all. What follows is only looked
# at: ``next`` of ``next.js`` leaves ``js`` to be found too.
SKILL_MARKS: dict[str, list[tuple[str, str]]] = {
    "Python": [("python", r"\b")], "SQL": [("sql", r"\b")], "Java": [("java", r"\b(?!\s*script)")],
    "JavaScript": [("jav", r"a\s*script\b"), ("js", r"\b")],
    "TypeScript": [("type", r"\s*script\b"), ("ts", r"\b")],
    "Scala": [("scala", r"\b")], "Go": [("golang", r"\b"), ("go", r"\s+lang\b")], "C++": [("c", r"\+\+")],
    "Rust": [("rust", r"\b")], "Pandas": [("pandas", r"\b")], "NumPy": [("numpy", r"\b")],
    "Spark": [("spark", r"\b"), ("pyspark", r"\b")], "dbt": [("dbt", r"\b")],
    "Airflow": [("airflow", r"\b")], "Snowflake": [("snowflake", r"\b")],
    "BigQuery": [("big", r"\s*query\b")], "Databricks": [("databricks", r"\b")],
    "Kafka": [("kafka", r"\b")], "Redshift": [("redshift", r"\b")],
    "Postgres": [("postgres", r"(?:ql)?\b")], "PyTorch": [("pytorch", r"\b")],
    "TensorFlow": [("tensor", r"\s*flow\b")],
    "scikit-learn": [("scikit", r"[- ]learn\b"), ("sklearn", r"\b")], "XGBoost": [("xg", r"\s*boost\b")],
    "LLM": [("llm", r"s?\b"), ("large", r" language model")], "RAG": [("rag", r"\b")],
    "LangChain": [("langchain", r"\b")], "HuggingFace": [("hugging", r"\s*face\b")],
    "MLOps": [("mlops", r"\b")], "Tableau": [("tableau", r"\b")], "Power BI": [("power", r"\s*bi\b")],
    "Looker": [("looker", r"\b")], "Metabase": [("metabase", r"\b")], "Excel": [("excel", r"\b")],
    "AWS": [("aws", r"\b"), ("amazon", r" web services\b")], "GCP": [("gcp", r"\b"), ("google", r" cloud\b")],
    "Azure": [("azure", r"\b")], "Docker": [("docker", r"\b")],
    "Kubernetes": [("kubernetes", r"\b"), ("k8s", r"\b")], "Terraform": [("terraform", r"\b")],
    "React": [("react", r"\b")], "FastAPI": [("fast", r"\s*api\b")], "Django": [("django", r"\b")],
    "Next.js": [("next", r"\.?js\b")],
}
# patterns without a boundary before them: a lone R (its letter first, the cheaper test) and a part of a word
SKILL_INSIDE: dict[str, list[tuple[str, str]]] = {
    "R": [("r", r"(?<![A-Za-z]r)(?=\s|,|\.|/|$)")], "RAG": [("re", "(?=trieval[- ]augmented)")]}
# every skill's texts; of those with a part above the boundary is not the rule
SKILL_LITERALS: dict[str, list[str]] = {name: [text for text, _ in found] for name, found in SKILL_INSIDE.items()}
SKILL_WORDS: dict[str, list[str] | None] = {
    name: [text for text, _ in SKILL_MARKS[name]] if name in SKILL_MARKS else None for name in T.SKILL_PATTERNS}
_DICTIONARY = sorted({w for words in SKILL_WORDS.values() for w in words or []})


def _by_first_letter(marks: dict[str, list[str]]) -> str:
    """An alternation that halves the first letters until three are left."""
    letters = sorted(marks)
    if len(letters) <= 3:
        return "|".join(f"{c}(?:{'|'.join(marks[c])})" for c in letters)
    halves = letters[:len(letters) // 2], letters[len(letters) // 2:]
    return "|".join(f"(?=[{''.join(h)}])(?:{_by_first_letter({c: marks[c] for c in h})})" for h in halves)


def _skill_scan() -> str:
    marks: dict[str, list[str]] = {}
    for found in SKILL_MARKS.values():
        for text, then in found:
            marks.setdefault(text[0], []).append(f"{text[1:]}(?={then})")
    inside = "|".join(text + then for found in SKILL_INSIDE.values() for text, then in found)
    return rf"(?iU)\b(?:{_by_first_letter(marks)})|{inside}"


def fold(text: Column) -> Column:
    """Case-folded text: what a scan without regard to case found, in lower-case ASCII.

    Java's Unicode case-insensitive matching equates a text character t with a
    lowercase ASCII letter c when ``toLowerCase(toUpperCase(t)) == c``: besides
    A-Z/a-z that holds for four characters, dotless ``ı`` (i), long ``ſ`` (s),
    ``İ`` (i) and the Kelvin sign (k). ``lower`` already maps the Kelvin sign
    and turns ``İ`` into ``i`` plus a combining dot; ``translate`` maps ``ı`` and
    ``ſ`` and deletes the combining dot. (``lower(upper(x))`` would not do: the
    optimizer simplifies it to ``lower(x)``.) ``translate`` looks every character
    up, so it runs only on texts that hold one of the three.
    """
    low = F.lower(_nz(text))
    return (F.when(_any_literal(low, ["\u0131", "\u017f", "\u0307"]),
                   F.translate(low, "\u0131\u017f\u0307", "is")).otherwise(low))


def _any_word(words: Column, wanted: list[str]) -> Column:
    return functools.reduce(Column.__or__, [F.array_contains(words, w) for w in wanted])


def with_skills(df, text_col: str = "description", out: str = "skills"):
    """``df`` plus the B1 skill array, found by one scan of the text.

    Equal to ``skills(col(text_col))``: the scan's parts are the skills' patterns, read by the
    same engine with the same flags; what it finds is folded and looked up per skill.
    """
    found = F.regexp_extract_all(_nz(F.col(text_col)), F.lit(_skill_scan()), F.lit(0))
    df = df.select("*", F.array_join(found, " ").alias("_skill_found"))
    df = df.select("*", F.split(fold(F.col("_skill_found")), " ").alias("_skill_words"))
    hits = [F.when(_any_word(F.col("_skill_words"), (SKILL_WORDS[name] or []) + SKILL_LITERALS.get(name, [])), F.lit(name))
            for name in T.SKILL_NAMES_SORTED]
    df = df.select("*", F.concat_ws("\x1f", *hits).alias("_skill_hits"))  # no skill name holds the separator
    joined = F.col("_skill_hits")
    found = F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, "\x1f"))
    return df.select("*", found.alias(out)).drop("_skill_found", "_skill_words", "_skill_hits")


def skills_json(skills_arr: Column) -> Column:
    """JSON text of a skill array in the form ``["A", "B"]`` (comma + space).

    Skill names contain no character that JSON would escape.
    """
    return F.when(F.size(skills_arr) > 0, F.concat(F.lit('["'), F.concat_ws('", "', skills_arr), F.lit('"]'))).when(
        skills_arr.isNotNull(), F.lit("[]"))


def skills_from_json(js: Column) -> Column:
    """Decode a skills JSON text; NULL gives an empty array."""
    return F.coalesce(F.from_json(js, "array<string>"), F.array().cast("array<string>"))


# -- B3 language gate ----------------------------------------------------

def _any_literal(low: Column, literals: list[str]) -> Column:
    return functools.reduce(Column.__or__, [low.contains(lit) for lit in literals])


# Literal necessary conditions of the lowercase-text rules (every pattern of the
# group contains one of them verbatim; the regexes run on the same lowercased
# string, so the test is exact). An optimisation only.
LANGUAGE_GATE_LITERALS = {"english_ok": ["english", "german"],
                          "german_required": ["deutsch", "german"]}
SENIORITY_LITERALS = {"werkstudent": ["student"], "intern": ["intern", "prakti"],
                      "junior": ["junior", "einsteiger", "entry"],
                      "senior": ["senior", "lead", "staff", "principal"], "mid": ["mid"]}


def language_gate(text: Column, gated: bool = True, low: Column | None = None) -> Column:
    """B3; ``low``: the lowercased text, if at hand."""
    low = F.lower(_nz(text)) if low is None else low
    en = low.rlike("(?U)" + _alt(T.ENGLISH_FRIENDLY_PATTERNS))
    de = low.rlike("(?U)" + _alt(T.GERMAN_REQUIRED_PATTERNS))
    if gated:
        en, de = (low.rlike("(?U)" + _by_letter(p)) for p in (T.ENGLISH_FRIENDLY_PATTERNS, T.GERMAN_REQUIRED_PATTERNS))
        en = _any_literal(low, LANGUAGE_GATE_LITERALS["english_ok"]) & en
        de = _any_literal(low, LANGUAGE_GATE_LITERALS["german_required"]) & de
    return (F.when(en, F.lit("english_ok")).when(de, F.lit("german_required"))
            .otherwise(F.lit("unclear")))


# -- B4 seniority ----------------------------------------------------------

def seniority(title: Column, description: Column, gated: bool = True, hay: Column | None = None) -> Column:
    """B4; ``hay``: the lowercased title, line break and description, if at hand."""
    hay = F.lower(F.concat(_nz(title), F.lit("\n"), _nz(description))) if hay is None else hay
    out = None
    for level in T.SENIORITY_PRIORITY:
        cond = hay.rlike("(?U)" + _alt(T.SENIORITY_PATTERNS[level]))
        if gated:
            cond = _any_literal(hay, SENIORITY_LITERALS[level]) & hay.rlike("(?U)" + _by_letter(T.SENIORITY_PATTERNS[level]))
        out = F.when(cond, F.lit(level)) if out is None else out.when(cond, F.lit(level))
    return out.otherwise(F.lit(T.SENIORITY_UNKNOWN))


# -- B5 salary -------------------------------------------------------------

def locale_number(s: Column, thousands: Column) -> Column:
    """Parse a number written with ``.``/``,`` separators.

    Both separators present: the last one is the decimal mark. Only one kind
    present: a single separator followed by exactly three digits is a
    thousands mark, otherwise a comma is a decimal mark and dots are kept.
    ``thousands`` (the ``k`` suffix) multiplies by 1000. Unparseable text
    (e.g. ``1.234.567``) yields NULL instead of failing the task.
    """
    has_dot = F.instr(s, ".") > 0
    has_comma = F.instr(s, ",") > 0
    last_sep = F.regexp_extract(s, r"([.,])[^.,]*$", 1)
    norm = (
        F.when(has_dot & has_comma,
               F.when(last_sep == ",", F.translate(F.translate(s, ".", ""), ",", "."))
               .otherwise(F.translate(s, ",", "")))
        .when(has_comma,
              F.when(s.rlike(r"^[^,]*,[^,]{3}$"), F.translate(s, ",", ""))
              .otherwise(F.translate(s, ",", ".")))
        .when(s.rlike(r"^[^.]*\.[^.]{3}$"), F.translate(s, ".", ""))
        .otherwise(s)
    )
    val = F.when(s != "", norm).try_cast("double")
    return F.when(thousands, val * F.lit(1000.0)).otherwise(val)


SALARY_PARTS = ("_sal_h", "_sal_a1", "_sal_a2", "_sal_a3", "_sal_a4")
#: what may stand before the first number of a pay
_SALARY_PREFIX = T.SALARY_CURRENCY + r"?\s*"
SALARY_NUMBERS = ("_sal_hv", "_sal_lo", "_sal_hi")


def salary_extracts(text: Column) -> list[Column]:
    """Stage 1 of B5: first hourly match and the first annual-range match.

    The text is scanned once per pattern; the annual groups are then taken
    from the (short) matched text. The annual pattern has no anchors,
    boundaries or look-around, so matching it again on its own first match
    yields the same groups.

    The scans leave out the optional currency and white space before the first number: these
    hold no digit, so the leftmost match has the same first number with and without them.
    Without them a position that is no digit fails at once.
    """
    t = _nz(text)
    hourly = "(?iU)" + T.SALARY_HOURLY.removeprefix(_SALARY_PREFIX)
    annual = "(?iU)" + T.SALARY_ANNUAL_RANGE.removeprefix(_SALARY_PREFIX)
    # what an hourly match holds; the number's many readings are tried only in texts that have it
    unit = t.rlike(r"(?iU)(?:/|pro|per)\s*(?:h|st)")
    return [F.when(unit, F.regexp_extract(t, hourly, 1)).otherwise(F.lit("")).alias("_sal_h"),
            F.when(t != "", F.regexp_extract(t, annual, 0)).otherwise(F.lit("")).alias("_sal_a0")]


def salary_groups() -> list[Column]:
    annual = "(?iU)" + T.SALARY_ANNUAL_RANGE
    m = F.col("_sal_a0")
    return [F.regexp_extract(m, annual, i).alias(f"_sal_a{i}") for i in (1, 2, 3, 4)]


def salary_numbers() -> list[Column]:
    """Stage 2 of B5: locale-aware numbers of the extracted groups."""
    h, a1, a2, a3, a4 = (F.col(n) for n in SALARY_PARTS)
    cols = [locale_number(h, F.lit(False)), locale_number(a1, a2 != ""),
            locale_number(a3, a4 != "")]
    return [c.alias(n) for c, n in zip(cols, SALARY_NUMBERS)]


def salary_fields() -> list[Column]:
    """Stage 3 of B5: ``salary_min_eur``, ``salary_max_eur``, ``salary_period``.

    Hourly first (only its first match is considered), accepted within
    5..150; otherwise the first annual range, accepted when both ends lie in
    10k..500k and low <= high; otherwise all NULL.
    """
    h, lo, hi = (F.col(n) for n in SALARY_NUMBERS)
    ok_h = F.coalesce(h.between(T.HOURLY_MIN, T.HOURLY_MAX), F.lit(False))
    ok_a = F.coalesce(lo.between(T.ANNUAL_MIN, T.ANNUAL_MAX)
                      & hi.between(T.ANNUAL_MIN, T.ANNUAL_MAX) & (lo <= hi), F.lit(False))
    null_d = F.lit(None).cast("double")
    return [
        F.when(ok_h, h).when(ok_a, lo).otherwise(null_d).alias("salary_min_eur"),
        F.when(ok_h, h).when(ok_a, hi).otherwise(null_d).alias("salary_max_eur"),
        F.when(ok_h, F.lit("hour")).when(ok_a, F.lit("year"))
        .otherwise(F.lit(None).cast("string")).alias("salary_period"),
    ]


def with_salary(df, text_col: str = "description"):
    """Add the three B5 salary columns to ``df`` (staged projections).

    Both patterns begin with a digit, so they read the text from its first digit on.
    """
    df = df.select("*", F.regexp_extract(_nz(F.col(text_col)), r"(?sU)\d.*", 0).alias("_sal_t"))
    df = df.select("*", *salary_extracts(F.col("_sal_t"))).drop("_sal_t")
    df = df.select("*", *salary_groups()).drop("_sal_a0")
    df = df.select("*", *salary_numbers()).drop(*SALARY_PARTS)
    return df.select("*", *salary_fields()).drop(*SALARY_NUMBERS)


def with_texts_rules(df):
    """``df`` plus B1 and B3-B5 of ``title`` and ``description``; each text is lowercased once."""
    df = df.select("*", F.lower(_nz(F.col("description"))).alias("_low"))
    # no case rule looks past a line break, so the parts may be lowercased apart
    df = df.select("*", F.concat(F.lower(_nz(F.col("title"))), F.lit("\n"), F.col("_low")).alias("_hay"))
    df = df.select("*", seniority(F.col("title"), F.col("description"), hay=F.col("_hay")).alias("seniority"),
                   language_gate(F.col("description"), low=F.col("_low")).alias("language_gate")).drop("_hay")
    return with_salary(with_skills(df.drop("_low")))


# -- B6 city ---------------------------------------------------------------

def title_case(s: Column) -> Column:
    """Capitalise every run of letters (``baden-baden`` -> ``Baden-Baden``)."""
    runs = F.regexp_extract_all(s, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda w: F.initcap(w)), "")


def strip(s: Column) -> Column:
    """Remove leading/trailing Unicode whitespace (``trim`` only drops spaces)."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def city(location: Column, remote: Column) -> Column:
    loc = _nz(location)
    low = F.lower(loc)
    rem = F.coalesce(remote, F.lit(False))
    first_part = title_case(strip(F.split(loc, ",", 2).getItem(0)))
    out = F.when(loc == "", F.when(rem, F.lit(T.CITY_REMOTE)).otherwise(F.lit(T.CITY_UNKNOWN)))
    for alias, canonical in T.CITY_ALIASES:
        out = out.when(F.instr(low, alias) > 0, F.lit(canonical))
    return (out.when(rem, F.lit(T.CITY_REMOTE))
            .when(first_part != "", first_part)
            .otherwise(F.lit(T.CITY_UNKNOWN)))


# -- B7 / B8 fact columns --------------------------------------------------

def role_family(title: Column) -> Column:
    low = F.lower(title)
    out = None
    for family, fragments in T.ROLE_FAMILY_RULES:
        cond = None
        for frag in fragments:
            c = low.contains(frag)
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(family)) if out is None else out.when(cond, F.lit(family))
    return out.otherwise(F.lit(T.ROLE_FAMILY_OTHER))


def annualized(min_eur: Column, period: Column) -> Column:
    return (F.when(period == "hour", min_eur * F.lit(T.HOURS_PER_WEEK * T.WEEKS_PER_YEAR))
            .when(period == "year", min_eur))


# -- B9 / B10 / B16 dates ---------------------------------------------------

def posted_at(created_at: Column) -> Column:
    """Lenient timestamp: bad text becomes NULL, any UTC offset is ignored."""
    return created_at.try_cast("timestamp_ntz")


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the week, as TIMESTAMP_NTZ."""
    return F.date_trunc("week", ts).cast("timestamp_ntz")


def sunday_week_key(d: Column) -> Column:
    """``%Y-%U`` week key: Sunday-first weeks, days before the first Sunday are week 0."""
    wk = F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("int")
    return F.format_string("%04d-%02d", F.year(d), wk)


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``round(100 * part / whole, digits)``, NULL when ``whole`` is 0."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)
