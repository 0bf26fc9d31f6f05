"""Mixing sources to target weights (DataFrame functions only).

Every document gets a hash that depends only on its content and id. Per
source the words are summed by hash bucket; a budget is met by all documents
below a hash threshold. The bucket in which the running sum crosses the
budget is split into finer buckets, over the documents of that bucket alone,
until the threshold is ``LEVELS * BITS`` bits long. Filtering by the
threshold then needs no sort, and a smaller budget of the same source always
keeps a subset of a larger one (nested thresholds): a budget above the
source's size takes every document once and the nested remainder twice.

Defined results: null text has size 0; a document without words is taken as often as
its hash says, at most ``CAP`` times; null source is a source of its own,
ordered last; rows that agree in id, source and text are taken or left
together; an empty table gives an empty mix; extra columns pass through
``mix`` untouched (helper columns carry a ``__mix_`` prefix).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirescope.llm.common import n_words, read, small_side, stored

BITS = 12
LEVELS = 3
HASH_BITS = 60
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0


def row_hash(key: Column, source: Column, text: Column) -> Column:
    """60 hash bits of a document, the same in every engine that has md5."""
    s = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|"),
                 F.coalesce(source, F.lit("")), F.lit("|"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Weights repeat over the sources in code point order, null last. A target
    stops at ``cap`` times its source's size and the excess is reshared by
    weight, so target = min(cap * size, level * weight) for one common level:
    with the sources ordered by cap * size / weight, the first at which the
    words left over, shared by the weights left over, stay below that ratio.
    That share rises up to this source and falls after it: it is the largest.
    The windows run over one row per source, never over documents.
    """
    ranked = sizes.withColumn("__w", F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        (F.pmod(F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1,
                F.lit(len(weights))) + 1).cast("int")))
    lim = F.col("source_size") * F.lit(float(cap))
    whole = W.partitionBy(F.lit(1))
    upto = W.orderBy(lim / F.col("__w"), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1)
    leveled = (ranked
               .withColumn("__level", (F.sum("source_size").over(whole) * F.lit(float(share))
                                       - F.coalesce(F.sum(lim).over(upto), F.lit(0.0)))
                           / (F.sum("__w").over(whole) - F.coalesce(F.sum("__w").over(upto), F.lit(0.0))))
               .withColumn("__common", F.max("__level").over(whole)))
    return leveled.select(
        "source", "source_size",
        F.least(lim, F.col("__common") * F.col("__w")).alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, upto): per source the hash prefix below which documents meet its budget.

    ``rows`` (source, size, h); ``budgets`` (source, budget). Each level sums
    the words by the next ``BITS`` hash bits, of the boundary bucket alone
    after the first, with partial sums before the shuffle; running sums go
    over at most 2^BITS buckets per source.
    """
    state = budgets.select("source", F.lit(0).cast("long").alias("prefix"), F.col("budget").alias("left"))
    for level in range(LEVELS):
        shift = HASH_BITS - BITS * (level + 1)
        s = small_side(state).select(F.col("source").alias("__s"), "prefix", "left")
        bucket = F.shiftright("h", shift)
        cond = F.col("source").eqNullSafe(F.col("__s")) & (F.shiftright("h", shift + BITS) == F.col("prefix"))
        hist = rows.join(s, cond).groupBy("__s", "left", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"))
        w = W.partitionBy("__s").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
        run = hist.withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0)))
        last = level == LEVELS - 1
        # the boundary: the first bucket with which the running sum exceeds the budget
        # (at the finest level: comes nearer to it without than with the bucket)
        over = F.col("before") + (F.col("words") / 2 if last else F.col("words")) > F.col("left")
        hit = run.filter(over).groupBy("__s").agg(
            F.min(F.struct("bucket", "before", "left")).alias("b"))
        # a budget that no bucket exceeds takes everything of this prefix
        state = stored(
            state.join(hit, F.col("source").eqNullSafe(F.col("__s")), "left").select(
                "source",
                F.coalesce(F.col("b.bucket"), F.shiftleft(F.col("prefix") + 1, BITS)).alias("prefix"),
                F.when(F.col("b").isNotNull(), F.col("b.left") - F.col("b.before"))
                 .otherwise(F.lit(0.0)).alias("left")), "mix-threshold")
    return state.select("source", F.col("prefix").alias("upto"))


def mix_plan(docs: DataFrame, key: str = "doc_id", weights: tuple[float, ...] = WEIGHTS,
             share: float = SHARE, cap: float = CAP) -> tuple[DataFrame, DataFrame]:
    """The narrow rows (key, source, size, h), and per source (source, source_size, target, full, upto).

    ``full`` whole passes over the source, then once more the documents whose
    hash prefix lies below ``upto``.
    """
    rows = stored(docs.select(F.col(key), F.col("source"), n_words(F.col("text")).alias("size"),
                              row_hash(F.col(key), F.col("source"), F.col("text")).alias("h")), "mix-rows")
    targets = stored(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")),
                                    weights, share, cap), "mix-targets")
    size, target = F.col("source_size"), F.col("target")
    full = F.when(size > 0, F.floor(target / size)).otherwise(F.lit(0)).cast("int")
    plans = targets.withColumn("full", full).withColumn("budget", target - F.col("full") * size)
    cut = thresholds(rows, plans.select("source", "budget"))
    cut = cut.select(F.col("source").alias("__s"), "upto")
    # nothing is left after the whole passes: no remainder (its boundary would still let wordless documents in)
    upto = F.when((F.col("full") > 0) & (F.col("budget") <= 0), F.lit(0).cast("long")).otherwise(F.col("upto"))
    plans = stored(plans.join(cut, F.col("source").eqNullSafe(F.col("__s"))).select(
        "source", "source_size", "target", "full", upto.alias("upto")), "mix-plan")
    return rows, plans


def copies(hash_: Column) -> Column:
    """How often the mix takes a document, next to its source's plan columns."""
    return F.col("full") + (F.shiftright(hash_, HASH_BITS - BITS * LEVELS) < F.col("upto")).cast("int")


def mix(docs: DataFrame, key: str = "doc_id", weights: tuple[float, ...] = WEIGHTS,
        share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    _, plans = mix_plan(docs, key, weights, share, cap)
    p = small_side(plans).select(*[F.col(c).alias(f"__mix_{c}") for c in ("source", "full", "upto")])
    h = row_hash(F.col(key), F.col("source"), F.col("text"))
    taken = F.col("__mix_full") + (F.shiftright(h, HASH_BITS - BITS * LEVELS)
                                   < F.col("__mix_upto")).cast("int")
    return (docs.join(p, F.col("source").eqNullSafe(F.col("__mix_source")))
            .withColumn("__mix_n", taken).filter("__mix_n > 0")
            .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_n"))))
            .select(*docs.columns))


def op1_source_mixing(spark: SparkSession, base: str) -> DataFrame:
    """All documents with the words that the mix takes of each."""
    rows, plans = mix_plan(read(spark, base, "documents"))
    p = small_side(plans).withColumnRenamed("source", "__s")
    return rows.join(p, F.col("source").eqNullSafe(F.col("__s"))).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"),
        (F.col("size") * copies(F.col("h"))).alias("taken"))


ORACLE_SQL = r"""
WITH rows AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0
              ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(source, '') || '|'
                             || md5(coalesce(text, ''))), 1, 15))::BIGINT >> 24 AS p
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
            WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM sizes),
leveled AS (
  SELECT *,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) OVER o, 0))
      / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS lev
  FROM ranked
  WINDOW o AS (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size,
    (SELECT max(lev) FROM leveled) * w) AS target FROM leveled),
plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS full_passes FROM targets),
atoms AS (
  SELECT source, p, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY p) - sum(size) AS before
  FROM rows GROUP BY source, p),
cut AS (
  SELECT a.source, min(a.p) AS upto
  FROM atoms a JOIN plans t ON a.source IS NOT DISTINCT FROM t.source
  WHERE a.before + a.words / 2.0 > t.target - t.full_passes * t.source_size GROUP BY a.source)
SELECT r.doc_id, r.size::BIGINT AS size, t.source_size, round(t.target, 6) AS target,
       (r.size * (t.full_passes + CASE WHEN c.upto IS NULL OR r.p < c.upto THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rows r JOIN plans t ON r.source IS NOT DISTINCT FROM t.source
LEFT JOIN cut c ON r.source IS NOT DISTINCT FROM c.source
"""
