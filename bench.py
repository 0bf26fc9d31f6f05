"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once as a warm-up and once timed; the timed run executes the
whole plan into Spark's ``noop`` sink. ``build_fact`` times the enrichment of
all postings into the fact table (which the other queries then read, as the
marts read the stored fact in production); ``train_model`` times one full fit
of the salary model (scoring and explaining then use the trained artifact).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "build_fact",
    "enrich_documents",
    "enrich_pages",
    "ingest_json",
    "upsert_latest",
    "mart_language_gate",
    "mart_skill_demand",
    "mart_pay_bands",
    "kpi_overview",
    "by_city",
    "top_skills",
    "skill_city_top",
    "gate_cells",
    "gated_skills",
    "english_lift",
    "skill_share_trend",
    "snapshot_changes",
    "training_frame",
    "features_long",
    "group_folds",
    "train_model",
    "salary_scores",
    "salary_drivers",
    "salary_cv",
]
EXTRA = os.environ.get("BENCH_EXTRA", "")  # e.g. "weekly_stream"


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from hirescope import catalog
    from hirescope.session import build_session

    spark = build_session(f"local[{cpus}]", max(cpus, 8))
    spark.conf.set("hirescope.spreadTexts", "true")  # the bench tables are single row groups
    names = HEADLINE + [n for n in EXTRA.split(",") if n]

    def run(name: str, warm_up: bool = False) -> None:
        if name == "build_fact":
            df = catalog.warehouse(spark, base).fact_plan()
        elif name == "train_model":  # one full fit (150 trees), not the shared artifact
            from hirescope.plans import salary as S

            # the warm-up only needs the code path, not all 150 trees
            params = S.GBTParams(trees=10) if warm_up else S.GBTParams()
            S.train_model(catalog.training(spark, base), params, save=False)
            return
        else:
            df = catalog.QUERIES[name](spark, base)
        df.write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        run(name, warm_up=True)  # warm-up (also builds the stored fact once)
        t0 = time.time()
        run(name)
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", base)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()
