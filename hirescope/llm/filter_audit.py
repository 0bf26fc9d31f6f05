"""Filter interaction audit: what each of several filters removes, in every order.

Five filters are judged once per document, each failure a bit:

* A, too few words; B, too few distinct words; C, too many capitals; D, marked
  characters: from the document's own text;
* E, a copy: an existential self-join. Rows whose 64-bit text hash occurs with
  more than one id are left-semi joined, on hash and exact text, with the
  smallest id of every distinct text among them (the one witness that decides
  whether any smaller id exists).

The ids that fail E are united with the rows' other failure bits and summed up
per document; documents are then counted by (part, bit combination, labels). All
orders and steps are read from these few cells: no document is looked at once an
order, and an order's running filters need no state.

Skew: a group of copies becomes one witness per task before the shuffle (partial
aggregation); the copies themselves are dealt by hash and a salt, ``SPLIT`` rows
a piece, each piece with the witness' row. Only rows whose hash repeats carry
their text through a shuffle.

Defined results: null text is empty; empty texts are copies of each other; null
and empty lang are the part ``""``; a null id is never a copy and makes none;
repeated rows count each (rows of one id are not each other's copies); of several
label rows of an id the largest value counts, unlabelled documents are in no
``*_lost`` count; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import common as C

FILTERS = "ABCDE"
E_BIT = 1 << FILTERS.index("E")
MIN_WORDS = 100
MIN_DISTINCT_PCT = 80
MAX_CAPITALS_PCT = 10
MARKS = "[#$%&*|]"
SPLIT = 500  # copies of one hash that meet in a task


def text_bits(text: Column) -> Column:
    """The failures A to D of a text (not null) as bits 0 to 3."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = (n < MIN_WORDS, distinct * 100 < n * MIN_DISTINCT_PCT,
             F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * MAX_CAPITALS_PCT, text.rlike(MARKS))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def copies(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, h, part) of the rows of ``docs`` whose text a smaller id has too; ``rows`` holds h of each."""
    # narrow: which hashes occur with several ids, the smallest of them, and how often
    twice = C.stored(rows.filter("doc_id is not null").groupBy("h").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"))
        .filter("least < most").select("h", "least", "n"), "audit-hashes")
    twice = C.small_side(twice)
    text = F.coalesce("text", F.lit(""))
    again = (docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"),
                         F.xxhash64(text).alias("h")).filter("doc_id is not null").join(twice, "h")
             .withColumn("pieces", F.ceil(F.col("n") / SPLIT).cast("int")))
    witness = (again.groupBy("h", "text", "pieces").agg(F.min("doc_id").alias("least"))
               .select("h", "text", F.col("least").alias("smaller"),
                       F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("salt")).alias("w"))
    late = (again.filter("doc_id > least")
            .withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("pieces")).cast("int")).alias("d"))
    return late.join(witness, (F.col("d.h") == F.col("w.h")) & (F.col("d.salt") == F.col("w.salt"))
                     & (F.col("d.text") == F.col("w.text")) & (F.col("w.smaller") < F.col("d.doc_id")),
                     "left_semi").select("doc_id", "h", "part")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents by the filters they fail."""
    text = F.coalesce("text", F.lit(""))
    rows = C.stored(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.xxhash64(text).alias("h"),
                                text_bits(text).alias("bits")), "audit-rows")
    found = copies(docs, rows).distinct()
    both = (rows.withColumn("n", F.lit(1)).unionByName(
        found.withColumn("bits", F.lit(E_BIT)).withColumn("n", F.lit(0))))
    per_doc = both.groupBy("doc_id", "h", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    # an id's rows by part and bits, so that an id of many rows meets its label as a few rows
    per_id = per_doc.groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
    marks = labels.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").alias("quality"),
                                                                 F.max("toxic").alias("toxic"))
    known = per_id.join(marks, F.col("doc_id") == F.col("label_id"), "left")
    return known.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("quality") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))


def audit(cell: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, filter order and step from :func:`cells` (a few rows a part)."""
    plan = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, f in enumerate(order, 1):
            plan.append(F.struct(F.lit("".join(filters[i] for i in order)).alias("filter_order"),
                                 F.lit(step).alias("step"), F.lit(before).alias("before"), F.lit(1 << f).alias("bit")))
            before |= 1 << f
    bits, n = F.col("bits"), F.col("n")
    fails = bits.bitwiseAND(F.col("bit")) != 0
    gone = bits.bitwiseAND(F.col("before")) != 0

    def total(cond: Column, of: Column = n) -> Column:
        return F.sum(F.when(cond, of).otherwise(0)).cast("long")

    orders = F.lit(len(plan) // len(filters))
    return (cell.select("*", F.explode(F.array(*plan)).alias("o")).select("part", "bits", "n", "good", "toxic", "o.*")
            .groupBy("part", "filter_order", "step").agg(
                total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"),
                total(fails & gone).alias("redundant"), total(bits == F.col("bit")).alias("unique_fails"),
                total(fails & ~gone, F.col("good")).alias("good_lost"),
                total(fails & ~gone, F.col("toxic")).alias("toxic_lost"),
                # of the filters that a document fails, each comes first in an equal share of the orders
                total(fails, n * F.expr("cast(1 as long)") * (orders / F.greatest(F.bit_count(bits), F.lit(1)))
                      .cast("long")).alias("shapley")))


def op13_filter_audit(spark: SparkSession, base: str) -> DataFrame:
    """All documents through the five filters in all 120 orders."""
    return audit(cells(C.read(spark, base, "documents"), C.read(spark, base, "labels")))


ORACLE_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
counted AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
least AS (SELECT text, min(doc_id) AS least FROM docs GROUP BY text),
failing AS (
  SELECT c.part, coalesce(m.quality = 1, false) AS good, coalesce(m.toxic = 1, false) AS toxic,
         list_concat(CASE WHEN len(words) < 100 THEN ['A'] ELSE [] END,
         list_concat(CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN ['B'] ELSE [] END,
         list_concat(CASE WHEN 100 * len(regexp_extract_all(c.text, '[A-Z]')) > 10 * length(c.text) THEN ['C'] ELSE [] END,
         list_concat(CASE WHEN regexp_matches(c.text, '[#$%&*|]') THEN ['D'] ELSE [] END,
                     CASE WHEN c.doc_id > l.least THEN ['E'] ELSE [] END)))) AS fails
  FROM counted c JOIN least l ON c.text = l.text LEFT JOIN marks m ON c.doc_id = m.doc_id),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
          FROM failing GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
           WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS f, string_split(substr(filter_order, 1, step - 1), '') AS before
          FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
rows AS (
  SELECT part, filter_order, step, s.f,
         coalesce(sum(n) FILTER (WHERE NOT list_contains(fails, s.f) AND NOT list_has_any(fails, before)), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE list_contains(fails, s.f) AND NOT list_has_any(fails, before)), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE list_contains(fails, s.f) AND list_has_any(fails, before)), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = [s.f]), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE list_contains(fails, s.f) AND NOT list_has_any(fails, before)), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE list_contains(fails, s.f) AND NOT list_has_any(fails, before)), 0)::BIGINT AS toxic_lost
  FROM cells, steps s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM rows
"""
