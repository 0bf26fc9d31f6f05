"""DuckDB SQL for the correctness oracle.

The oracle recomputes every model from the warehouse tables in DuckDB, from
the same rule tables (``taxonomy``) and the same posting templates
(``testbed``) as the Spark jobs, so a match shows that the Spark plans compute
the specified semantics. Differences between the regex engines are handled
here, in the oracle only:

* RE2 has no look-around: the ``R`` skill's look-behind becomes an explicit
  ``(^|[^A-Za-z])`` prefix, and the ``Java`` skill's negative look-ahead
  becomes "remove every ``java\\s*script`` (replaced by a word character so no
  new word boundary appears), then search ``\\bjava\\b``".
* RE2's ``(?U)`` means *ungreedy*, so only ``(?i)`` is passed.
* RE2's ``\\b``/``\\s``/``\\d`` are ASCII; the posting templates keep
  non-ASCII letters away from rule words, so both engines agree on them.
"""

from __future__ import annotations

from hirescope.functions import taxonomy as T
from hirescope.sources.testbed import postings_sql


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _alt(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


_RE2_REWRITES = {
    "R": r"(^|[^A-Za-z])R(\s|,|\.|/|$)",
}


def skill_match(name: str, text: str) -> str:
    if name == "Java":
        return (f"regexp_matches(regexp_replace({text}, '(?i)\\bjava\\s*script', 'x', 'g'), "
                f"'(?i)\\bjava\\b')")
    pat = _RE2_REWRITES.get(name) or _alt(T.SKILL_PATTERNS[name])
    return f"regexp_matches({text}, {lit('(?i)' + pat)})"


def skills_list(text: str) -> str:
    items = ", ".join(f"CASE WHEN {skill_match(n, text)} THEN {lit(n)} END"
                      for n in T.SKILL_NAMES_SORTED)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def skills_json(lst: str) -> str:
    return f"('[' || array_to_string(list_transform({lst}, lambda x: '\"' || x || '\"'), ', ') || ']')"


def language_gate(text: str) -> str:
    low = f"lower(coalesce({text}, ''))"
    return (f"CASE WHEN regexp_matches({low}, {lit(_alt(T.ENGLISH_FRIENDLY_PATTERNS))}) "
            f"THEN 'english_ok' WHEN regexp_matches({low}, {lit(_alt(T.GERMAN_REQUIRED_PATTERNS))}) "
            f"THEN 'german_required' ELSE 'unclear' END")


def seniority(title: str, desc: str) -> str:
    hay = f"lower(coalesce({title}, '') || chr(10) || coalesce({desc}, ''))"
    whens = " ".join(
        f"WHEN regexp_matches({hay}, {lit(_alt(T.SENIORITY_PATTERNS[lv]))}) THEN {lit(lv)}"
        for lv in T.SENIORITY_PRIORITY)
    return f"CASE {whens} ELSE {lit(T.SENIORITY_UNKNOWN)} END"


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\pL+|\\PL+)', 1), "
            f"lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), '')")


def city(loc: str, remote: str) -> str:
    l = f"coalesce({loc}, '')"
    rem = f"coalesce({remote}, false)"
    first = title_case(f"regexp_replace(split_part({l}, ',', 1), '^\\s+|\\s+$', '', 'g')")
    aliases = " ".join(f"WHEN instr(lower({l}), {lit(a)}) > 0 THEN {lit(c)}"
                       for a, c in T.CITY_ALIASES)
    return (f"CASE WHEN {l} = '' THEN (CASE WHEN {rem} THEN 'Remote' ELSE 'Unknown' END) "
            f"{aliases} WHEN {rem} THEN 'Remote' "
            f"WHEN {first} <> '' THEN {first} ELSE 'Unknown' END")


def locale_number(s: str, thousands: str) -> str:
    norm = (f"CASE WHEN instr({s}, '.') > 0 AND instr({s}, ',') > 0 THEN "
            f"(CASE WHEN regexp_extract({s}, '([.,])[^.,]*$', 1) = ',' "
            f"THEN replace(replace({s}, '.', ''), ',', '.') ELSE replace({s}, ',', '') END) "
            f"WHEN instr({s}, ',') > 0 THEN "
            f"(CASE WHEN regexp_matches({s}, '^[^,]*,[^,]{{3}}$') THEN replace({s}, ',', '') "
            f"ELSE replace({s}, ',', '.') END) "
            f"WHEN regexp_matches({s}, '^[^.]*\\.[^.]{{3}}$') THEN replace({s}, '.', '') "
            f"ELSE {s} END")
    return (f"(CASE WHEN {s} = '' THEN NULL ELSE TRY_CAST({norm} AS DOUBLE) END "
            f"* CASE WHEN {thousands} THEN 1000.0 ELSE 1.0 END)")


def role_family(title: str) -> str:
    low = f"lower({title})"
    whens = []
    for fam, frags in T.ROLE_FAMILY_RULES:
        cond = " OR ".join(f"{low} LIKE {lit('%' + f + '%')}" for f in frags)
        whens.append(f"WHEN {cond} THEN {lit(fam)}")
    return f"CASE {' '.join(whens)} ELSE {lit(T.ROLE_FAMILY_OTHER)} END"


def pct(part: str, whole: str, digits: int = 1) -> str:
    return f"ROUND(CAST(100 AS DOUBLE) * {part} / NULLIF({whole}, 0), {digits})"


def count_if(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def salary_select(source: str, text: str = "description") -> str:
    """SELECT * from ``source`` plus salary_min_eur, salary_max_eur, salary_period."""
    hourly = lit("(?i)" + T.SALARY_HOURLY)
    annual = lit("(?i)" + T.SALARY_ANNUAL_RANGE)
    d = f"coalesce({text}, '')"
    h_ok = f"coalesce(_hv BETWEEN {T.HOURLY_MIN} AND {T.HOURLY_MAX}, false)"
    a_ok = (f"coalesce(_lo BETWEEN {T.ANNUAL_MIN} AND {T.ANNUAL_MAX} AND _hi BETWEEN "
            f"{T.ANNUAL_MIN} AND {T.ANNUAL_MAX} AND _lo <= _hi, false)")
    raw = (f"SELECT *, regexp_extract({d}, {hourly}, 1) AS _h, "
           f"regexp_extract({d}, {annual}, 1) AS _a1, regexp_extract({d}, {annual}, 2) AS _a2, "
           f"regexp_extract({d}, {annual}, 3) AS _a3, regexp_extract({d}, {annual}, 4) AS _a4 "
           f"FROM {source}")
    k_lo, k_hi = "_a2 <> ''", "_a4 <> ''"
    num = (f"SELECT *, {locale_number('_h', 'false')} AS _hv, "
           f"{locale_number('_a1', k_lo)} AS _lo, {locale_number('_a3', k_hi)} AS _hi "
           f"FROM ({raw})")
    return (f"SELECT * EXCLUDE (_h, _a1, _a2, _a3, _a4, _hv, _lo, _hi), "
            f"CASE WHEN {h_ok} THEN _hv WHEN {a_ok} THEN _lo END AS salary_min_eur, "
            f"CASE WHEN {h_ok} THEN _hv WHEN {a_ok} THEN _hi END AS salary_max_eur, "
            f"CASE WHEN {h_ok} THEN 'hour' WHEN {a_ok} THEN 'year' END AS salary_period "
            f"FROM ({num})")


def model_ctes() -> str:
    """``WITH postings, stg, fct`` (bridge via UNNEST) over the warehouse tables."""
    d = "coalesce(description, '')"
    hw = T.HOURS_PER_WEEK * T.WEEKS_PER_YEAR
    return f"""WITH postings AS ({postings_sql()}),
sal AS ({salary_select('postings')}),
stg0 AS (
  SELECT slug, title, company_name, location AS raw_location, {city('location', 'remote')} AS city,
         remote, url, TRY_CAST(created_at AS TIMESTAMP) AS posted_at, snapshot_date, tags,
         job_types, description, {seniority('title', 'description')} AS seniority,
         {language_gate('description')} AS language_gate,
         salary_min_eur, salary_max_eur, salary_period, {skills_list(d)} AS skills
  FROM sal),
stg AS (SELECT *, {skills_json('skills')} AS skills_json FROM stg0),
fct AS (
  SELECT slug, title, company_name, city, remote, url, posted_at, snapshot_date, seniority,
         language_gate, salary_min_eur, salary_max_eur, salary_period,
         CASE WHEN salary_period = 'hour' THEN salary_min_eur * {hw}
              WHEN salary_period = 'year' THEN salary_min_eur END AS salary_min_annualized_eur,
         {role_family('title')} AS role_family, description, skills_json, skills
  FROM stg),
bridge AS (SELECT slug, UNNEST(skills) AS skill_name FROM fct),
dim_skills AS (SELECT * FROM (VALUES {', '.join(f'({lit(n)}, {lit(c)})' for n, c, _ in T.SKILLS)}) v(skill_name, category)),
mart_language_gate AS (
  SELECT city, role_family, COUNT(*) AS n_postings,
         {count_if("language_gate = 'german_required'")} AS n_german_required,
         {count_if("language_gate = 'english_ok'")} AS n_english_ok,
         {count_if("language_gate = 'unclear'")} AS n_unclear,
         {pct(count_if("language_gate = 'german_required'"), 'COUNT(*)')} AS pct_german_required,
         {pct(count_if("language_gate = 'english_ok'"), 'COUNT(*)')} AS pct_english_ok
  FROM fct GROUP BY 1, 2 HAVING COUNT(*) >= {T.MIN_POSTINGS_LANGUAGE_GATE}),
skill_counts AS (
  SELECT b.skill_name, f.city, f.role_family, date_trunc('week', f.posted_at) AS week,
         COUNT(*) AS n_postings,
         {count_if("f.language_gate = 'german_required'")} AS n_german_required,
         {count_if("f.language_gate = 'english_ok'")} AS n_english_ok
  FROM fct f JOIN bridge b USING (slug) GROUP BY 1, 2, 3, 4),
mart_skill_demand AS (
  SELECT c.*, d.category AS skill_category, {pct('n_german_required', 'n_postings')} AS pct_german_required
  FROM skill_counts c LEFT JOIN dim_skills d ON d.skill_name = c.skill_name),
mart_pay_bands AS (
  SELECT city, role_family, COUNT(*) AS n_postings,
         COUNT(salary_min_annualized_eur) AS n_with_salary,
         ROUND(AVG(salary_min_annualized_eur), 0) AS avg_min_eur,
         ROUND(quantile_cont(salary_min_annualized_eur, 0.25), 0) AS p25_min_eur,
         ROUND(quantile_cont(salary_min_annualized_eur, 0.5), 0) AS median_min_eur,
         ROUND(quantile_cont(salary_min_annualized_eur, 0.75), 0) AS p75_min_eur
  FROM fct WHERE seniority IN ({', '.join(lit(s) for s in T.PAY_SENIORITIES)})
  GROUP BY 1, 2 HAVING COUNT(*) >= {T.MIN_POSTINGS_PAY})
"""


def with_models(select: str, recursive: bool = False) -> str:
    ctes = model_ctes()
    if recursive:
        ctes = "WITH RECURSIVE" + ctes[len("WITH"):]
    return ctes + select
