"""Synthetic postings follow the sample generator's distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirescope import catalog
from hirescope.plans import models as M
from hirescope.sources import synth


def test_synthetic_distributions(spark):
    df = catalog.QUERIES["synth_postings"](spark, "/root/testdata/sf0.01").cache()
    n = df.count()
    raw = (df.withColumn("tags", F.from_json("tags", "array<string>"))
             .withColumn("job_types", F.from_json("job_types", "array<string>")))
    fct = M.fact(M.staging(raw)).cache()
    share = lambda cond: fct.filter(cond).count() / n
    assert abs(share(F.col("remote")) - synth.P_REMOTE) < 0.03
    assert abs(share(F.col("language_gate") == "german_required") - 0.35) < 0.03
    assert abs(share(F.col("language_gate") == "english_ok") - 0.40) < 0.03
    assert abs(share(F.col("salary_period").isNotNull()) - synth.P_SALARY) < 0.03
    # every posting's salary, when present, is parsed back into the generator's ranges
    bad = fct.filter((F.col("salary_period") == "hour")
                     & ~F.col("salary_min_eur").between(*synth.HOURLY_RANGE)).count()
    assert bad == 0
    base_titles = {t for t, _, _ in synth.ROLE_TEMPLATES}
    prefixed = df.filter(~F.col("title").isin(list(base_titles))).count()
    without = df.filter(F.col("title").isin([t for t in base_titles if "Werkstudent" not in t]))
    assert 0.15 < prefixed / (prefixed + without.count()) < 0.25
    df.unpersist()
    fct.unpersist()
