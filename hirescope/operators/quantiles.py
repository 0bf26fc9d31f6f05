"""Exact linear-interpolated quantiles without gathering a group in one task.

``percentile`` keeps one value->count map per group and merges it in a single
task per group. ``bucketed_quantiles`` computes the same numbers (the
``quantile_cont`` definition: position p*(n-1) between the two neighbouring
order statistics) from aggregates whose size is bounded independently of the
group's row count:

1. counts per (group, value)              - a distributed aggregation
2. counts per (group, bucket)             - bucket = floor(value / width)
3. cumulative counts over buckets         - window per group over <= #buckets rows
4. for every wanted rank, its bucket      - equi join on the group, small tables
5. cumulative counts inside that bucket   - window over the values of one bucket
6. the order statistics, interpolated     - small aggregation

A hot group is spread over many tasks in step 1 and never needs more than one
bucket's distinct values in one place afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bucketed_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                       width: float, weight: str | None = None) -> DataFrame:
    """``keys`` + one column ``q<i>`` per probability (NULL for groups without values).

    ``weight``: a column of row counts, where ``df`` holds counted values.

    Groups whose values are all NULL are absent; join the result back to the
    group list when those groups must appear.
    """
    v = F.col(value)
    vc = (df.filter(v.isNotNull()).groupBy(*keys, value)
          .agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_c"))
          .withColumn("_b", F.floor(v / F.lit(width))))
    bc = vc.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
    w = Window.partitionBy(*keys).orderBy("_b")
    bc = (bc.withColumn("_end", F.sum("_bc").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_n", F.sum("_bc").over(Window.partitionBy(*keys)))
            .withColumn("_start", F.col("_end") - F.col("_bc")))
    # wanted ranks: for each p the lower and upper neighbour of position p*(n-1)
    n = bc.select(*keys, "_n").distinct()
    wanted = n.select(*keys, "_n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("qi"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]))
        .alias("_q")).select(*keys, "_n", "_q.qi", "_q.p")
    pos = F.col("p") * (F.col("_n") - F.lit(1))
    wanted = wanted.withColumn("_pos", pos).select(
        *keys, "qi", "_pos", F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.floor(pos).cast("long").alias("rank")),
            F.struct(F.lit(1).alias("side"), F.ceil(pos).cast("long").alias("rank"))))
        .alias("_r")).select(*keys, "qi", "_pos", "_r.side", "_r.rank")
    # the bucket holding each wanted rank (one bucket per rank, by construction)
    located = (wanted.join(bc.select(*keys, "_b", "_start", "_end"), keys)
               .filter((F.col("rank") >= F.col("_start")) & (F.col("rank") < F.col("_end"))))
    # order statistics inside the located buckets only
    cand = vc.join(located.select(*keys, "_b", "_start").distinct(), [*keys, "_b"])
    wb = Window.partitionBy(*keys, "_b").orderBy(value)
    cand = cand.withColumn("_cend", F.col("_start") + F.sum("_c").over(
        wb.rowsBetween(Window.unboundedPreceding, 0)))
    cand = cand.withColumn("_cstart", F.col("_cend") - F.col("_c"))
    stats = (located.select(*keys, "_b", "qi", "_pos", "side", "rank")
             .join(cand.select(*keys, "_b", value, "_cstart", "_cend"), [*keys, "_b"])
             .filter((F.col("rank") >= F.col("_cstart")) & (F.col("rank") < F.col("_cend"))))
    per_q = stats.groupBy(*keys, "qi").agg(
        F.first("_pos").alias("_pos"),
        F.max(F.when(F.col("side") == 0, F.col(value))).alias("_lo"),
        F.max(F.when(F.col("side") == 1, F.col(value))).alias("_hi"))
    frac = F.col("_pos") - F.floor("_pos")
    per_q = per_q.withColumn("_q", F.col("_lo") + frac * (F.col("_hi") - F.col("_lo")))
    return (per_q.groupBy(*keys).pivot("qi", list(range(len(probs)))).agg(F.first("_q"))
            .select(*keys, *[F.col(f"`{i}`").alias(f"q{i}") for i in range(len(probs))]))
