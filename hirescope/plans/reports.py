"""Reporting queries over the fact and the marts.

Each report returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirescope.functions import taxonomy as T
from hirescope.functions import text as X
from hirescope.operators.topk import semi_join_small, top_k
from hirescope.plans import models as M


@dataclass
class PostingFilter:
    """The dashboard's filter. ``None`` or an empty list means "no filter"."""

    cities: list[str] | None = None
    roles: list[str] | None = None
    english_only: bool = False

    def apply(self, fct: DataFrame) -> DataFrame:
        out = fct
        if self.cities:
            out = out.filter(F.col("city").isin(self.cities))
        if self.roles:
            out = out.filter(F.col("role_family").isin(self.roles))
        if self.english_only:
            out = out.filter(F.col("language_gate") == "english_ok")
        return out


NO_FILTER = PostingFilter()


def filtered_postings(fct: DataFrame, flt: PostingFilter) -> DataFrame:
    return flt.apply(fct).select("slug", "city", "role_family", "language_gate")


def filter_values(fct: DataFrame) -> DataFrame:
    """The distinct cities and role families offered by the filter widgets."""
    cities = fct.select(F.lit("city").alias("facet"), F.col("city").alias("value")).distinct()
    roles = fct.select(F.lit("role_family").alias("facet"),
                       F.col("role_family").alias("value")).distinct()
    return cities.unionByName(roles).orderBy("facet", F.col("value").asc_nulls_last())


def kpi_overview(fct: DataFrame, flt: PostingFilter = NO_FILTER,
                 approx_distinct: bool = False) -> DataFrame:
    """G1: one row of headline numbers (``approx_distinct``: HyperLogLog++ company count)."""
    f = flt.apply(fct)
    companies = (F.approx_count_distinct("company_name") if approx_distinct
                 else F.count_distinct("company_name"))
    return f.agg(
        F.count(F.lit(1)).alias("n_jobs"),
        companies.alias("n_companies"),
        F.sum(F.when(F.col("remote"), F.lit(1)).otherwise(F.lit(0))).alias("n_remote"),
        F.sum(F.when(F.col("language_gate") == "english_ok", F.lit(1)).otherwise(F.lit(0)))
        .alias("n_english"),
        F.round(F.avg("salary_min_annualized_eur"), 2).alias("avg_salary"),
    )


def postings_by_role(fct: DataFrame, flt: PostingFilter = NO_FILTER) -> DataFrame:
    """Postings per role family, most first."""
    return (flt.apply(fct).groupBy("role_family").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "role_family"))


def postings_by_city(fct: DataFrame, flt: PostingFilter = NO_FILTER) -> DataFrame:
    """Top 15 cities by postings."""
    counts = flt.apply(fct).groupBy("city").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, T.TOP_CITIES_REPORT, [F.col("n").desc()], ["city"])


def top_skills(fct: DataFrame, dim: DataFrame, flt: PostingFilter = NO_FILTER) -> DataFrame:
    """Top 25 skills with their category."""
    counts = (M.skill_mentions(flt.apply(fct)).groupBy("skill_name")
              .agg(F.count(F.lit(1)).alias("n")))
    with_cat = counts.join(F.broadcast(dim.select("skill_name", "category")), "skill_name", "left")
    return top_k(with_cat, T.TOP_SKILLS_REPORT, [F.col("n").desc()], ["skill_name"])


def skill_city_counts(fct: DataFrame, flt: PostingFilter = NO_FILTER) -> DataFrame:
    """Postings per skill x city."""
    return (M.skill_mentions(flt.apply(fct)).groupBy("skill_name", "city")
            .agg(F.count(F.lit(1)).alias("n")))


def skill_city_heatmap(fct: DataFrame, flt: PostingFilter = NO_FILTER,
                       long_form: bool = True) -> DataFrame:
    """Top 15 skills x top 10 cities, missing cells 0.

    Both top sets come from the G5 counts (bounded: <= 15 and <= 10 keys, so the
    semi joins broadcast them). Each skill's cells become one row, which is then
    exploded over the cities that any of them has: at most 15 rows with 10
    entries. ``long_form=False`` pivots that to one column per city.
    """
    counts = skill_city_counts(fct, flt)
    ts = top_k(counts.groupBy("skill_name").agg(F.sum("n").alias("t")),
               T.HEATMAP_TOP_SKILLS, [F.col("t").desc()], ["skill_name"]).select("skill_name")
    tc = top_k(counts.groupBy("city").agg(F.sum("n").alias("t")),
               T.HEATMAP_TOP_CITIES, [F.col("t").desc()], ["city"]).select("city")
    sub = semi_join_small(semi_join_small(counts, ts, "skill_name"), tc, "city")
    per = sub.groupBy("skill_name").agg(F.collect_list(F.struct("city", "n")).alias("cells"))
    shown = F.array_distinct(F.flatten(F.collect_list("cells.city").over(Window.partitionBy(F.lit(1)))))
    grid = per.withColumn("shown", shown).select("skill_name", "cells", F.explode("shown").alias("city"))
    n = F.expr("aggregate(filter(cells, c -> c.city = city), 0L, (s, c) -> s + c.n)")
    long = grid.select("skill_name", "city", n.alias("n"))
    if long_form:
        return long
    return long.groupBy("skill_name").pivot("city").agg(F.sum("n"))


def language_gate_table(mart_gate: DataFrame, cities: list[str] | None = None,
                        roles: list[str] | None = None) -> DataFrame:
    """The language-gate mart for the selected cells, most English-friendly first.

    ``None`` selects everything; an empty list selects nothing (the dashboard
    shows no table then). ``english_only`` does not apply to this table.
    """
    df = mart_gate
    if cities is not None:
        df = df.filter(F.col("city").isin(cities)) if cities else df.limit(0)
    if roles is not None:
        df = df.filter(F.col("role_family").isin(roles)) if roles else df.limit(0)
    return (df.select("city", "role_family", "pct_german_required", "pct_english_ok", "n_postings")
              .orderBy(F.col("pct_english_ok").desc_nulls_last(), "city", "role_family"))


def language_gate_pivot(mart_gate: DataFrame, cities: list[str] | None = None,
                        roles: list[str] | None = None) -> DataFrame:
    """City x role family of pct_german_required (mean), missing cells NULL.

    Role families are a fixed enumeration, so the pivot columns (those selected)
    are known without a pass over the data.
    """
    shown = [r for r in T.ROLE_FAMILIES if roles is None or r in roles]
    table = language_gate_table(mart_gate, cities, roles)
    return table.groupBy("city").pivot("role_family", shown).agg(F.avg("pct_german_required"))


def skills_gated_by_german(mart_skill: DataFrame) -> DataFrame:
    """Skills by share of German-required postings (total >= 5), top 20."""
    agg = (mart_skill.groupBy("skill_name")
           .agg(F.sum("n_postings").alias("total"), F.sum("n_german_required").alias("n_german"))
           .filter(F.col("total") >= T.MIN_TOTAL_GATED_SKILL)
           .withColumn("pct_german", X.pct(F.col("n_german"), F.col("total"))))
    return top_k(agg, T.TOP_GATED_SKILLS, [F.col("pct_german").desc_nulls_last()], ["skill_name"])


def pay_table(mart_pay: DataFrame) -> DataFrame:
    """The pay-band mart, highest median first, NULL medians last."""
    return mart_pay.orderBy(F.col("median_min_eur").desc_nulls_last(), "city", "role_family")


def english_lift(mart_skill: DataFrame, fct: DataFrame) -> DataFrame:
    """Which skills go with English-friendly postings.

    Per skill: share of its postings that are ``english_ok`` and the lift over
    the overall share of English-friendly postings. The overall share is a
    scalar subquery (one aggregate job), not a join.
    """
    overall = fct.select(F.avg(F.when(F.col("language_gate") == "english_ok", F.lit(1.0))
                               .otherwise(F.lit(0.0)))).scalar()
    agg = (mart_skill.groupBy("skill_name", "skill_category")
           .agg(F.sum("n_postings").alias("n_postings"),
                F.sum("n_english_ok").alias("n_english_ok")))
    rate = F.col("n_english_ok") / F.col("n_postings")
    return agg.select("skill_name", "skill_category", "n_postings", "n_english_ok",
                      F.round(rate, 4).alias("english_rate"),
                      F.round(rate / F.nullif(overall, F.lit(0.0)), 4).alias("lift"))
