"""Quality rules with adaptive thresholds.

Per document, plain counts over the whole text; a fixed base rule; then, per
language and source, cutoffs read from quantile sketches of the documents that
passed the base rule. The sketch is a log-linear histogram of an integer
measure: a value is named by its leading ``SKETCH_BITS`` bits, so a bucket is
at most 1/32 wide relative to its value. Sketches of parts merge by adding
counts - which is how Spark builds them (partial sums before the shuffle) and
how a group with few documents borrows its language's sketch, or the whole
corpus', by merging those of its sources.

Defined results: null or empty text has no words and fails the base rule;
null language or source is a group of its own; repeated rows are judged each
by itself, alike; an empty table gives an empty result; extra columns pass
through ``keep`` (helper columns carry a ``__q_`` prefix).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirescope.llm import common as C

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8
SKETCH_BITS = 6
SCALE = 10_000  # measures are integers: ratios times this
MIN_GROUP = 200  # a smaller group merges into its language, then into all
#: measure -> (numerator, denominator, fence on low side, slack in units of SCALE)
MEASURES = {
    "symbols_per_word": ("n_symbols", "n_words", False, 1_000),
    "dup_lines_per_word": ("n_dup_lines", "n_words", False, 500),
    "repeat_share": ("n_repeat_words", "n_words", False, 2_500),
    "chars_per_word": ("word_chars", "n_words", True, 20_000),
}
SPREAD = 6  # a fence lies this many quartile distances beyond the median

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _per_doc(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    run = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=run[1:])
    return run[ends[1:]] - run[ends[:-1]]


def _seen_before(group: np.ndarray, h: np.ndarray, later_only: bool) -> np.ndarray:
    """Per item: is there another (``later_only``: an earlier) equal item in its group?"""
    key = C.mix64(h + C.mix64(group.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    k = key[order]
    equal = k[1:] == k[:-1]
    same[1:] = equal
    if not later_only:
        same[:-1] |= equal
    out = np.zeros(len(key), bool)
    out[order] = same
    return out


def text_metrics(texts: pa.Array) -> list[np.ndarray]:
    """METRICS of every text (null: all zero)."""
    data, ends = C.text_bytes(texts)
    n = len(ends) - 1
    starts, lens, doc = C.word_spans(data, ends)
    words = C.per_text(doc, n)
    # code points in words: bytes of words that do not continue a code point
    inside = ~C._SPACE[data]
    chars = _per_doc(inside & ((data & 0xC0) != 0x80), ends)
    symbols = _per_doc(_SYMBOL[data], ends)

    # lines: split at \n; those with a word, equal to an earlier one
    newline = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([ends[:-1], newline + 1]))
    line_start = line_start[line_start < len(data)]
    line_stop = np.append(line_start[1:], len(data)) if len(line_start) else line_start
    line_doc = np.searchsorted(ends, line_start, "right") - 1
    # a line stops at its newline or at its text's end
    has_nl = np.zeros(len(line_start), bool)
    if len(line_start):
        has_nl = (data[line_stop - 1] == 10)
    length = line_stop - line_start - has_nl
    run = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=run[1:])
    worded = (run[line_start + length] - run[line_start]) > 0 if len(line_start) else has_nl
    ls, ll, ld = line_start[worded], length[worded], line_doc[worded]
    dup = _seen_before(ld, C.run_hashes(data, ls, ll), True)
    dup_lines = np.bincount(ld[dup], minlength=n).astype(np.int64)

    # words inside a window of 8 words that is found at least twice in the text
    repeat = np.zeros(n, np.int64)
    if len(doc) >= WINDOW:
        h = C.run_hashes(data, starts, lens)
        m = len(h) - WINDOW + 1
        win = np.zeros(m, np.uint64)
        for k in range(WINDOW):
            win = win * np.uint64(0x100000001B3) + h[k:k + m]
        ok = doc[:m] == doc[WINDOW - 1:]
        at = np.flatnonzero(ok)
        twice = at[_seen_before(doc[at], win[at], False)]
        cover = np.zeros(len(h) + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + WINDOW, -1)
        repeat = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n).astype(np.int64)
    return [words, chars, symbols, dup_lines, repeat]


def measured(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` plus the METRICS columns (named with ``prefix``)."""
    schema = T.StructType([*docs.schema.fields, *[T.StructField(prefix + m, T.LongType()) for m in METRICS]])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, text):
            cols = [pa.array(x, pa.int64()) for x in text_metrics(b.column(text))]
            yield pa.RecordBatch.from_arrays(list(b.columns) + cols, names=names)

    return docs.mapInArrow(run, schema)


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PCT * n)


def measure(name: str, prefix: str = "") -> Column:
    num, den, _, _ = MEASURES[name]
    return F.expr(f"CASE WHEN {prefix}{den} > 0 THEN {SCALE} * {prefix}{num} div {prefix}{den} END")


def sketch_bucket(v: Column) -> Column:
    """The lower edge of a value's bucket: its leading SKETCH_BITS bits."""
    s = F.greatest(F.length(F.bin(v)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, s), s)


def sketches(rows: DataFrame, prefix: str = "") -> DataFrame:
    """(lang, source, measure, bucket, n) over the rows that passed the base rule."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), sketch_bucket(measure(m, prefix)).alias("bucket"))
        for m in MEASURES])).alias("m")
    return (rows.filter(~base_failed(prefix)).select("lang", "source", pairs)
            .groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count("*").alias("n")))


def cutoffs(sk: DataFrame) -> DataFrame:
    """(lang, source, lo_*, hi_*): fences of every group from its own or a merged sketch."""
    levels = (sk.withColumn("up", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
              .withColumn("gl", F.when(F.col("up") < 2, F.col("lang")))
              .withColumn("gs", F.when(F.col("up") < 1, F.col("source"))))
    merged = levels.groupBy("up", "gl", "gs", "measure", "bucket").agg(F.sum("n").alias("n"))
    w = W.partitionBy("up", "gl", "gs", "measure")
    run = (merged.withColumn("total", F.sum("n").over(w))
           .withColumn("upto", F.sum("n").over(w.orderBy("bucket"))))
    q = {p: F.min(F.when(F.col("upto") * 4 >= F.col("total") * p, F.col("bucket"))) for p in (1, 2, 3)}
    fences = run.groupBy("up", "gl", "gs", "measure").agg(
        F.max("total").alias("total"), *[q[p].alias(f"q{p}") for p in q])
    slack = F.create_map(*[x for m, (_, _, _, s) in MEASURES.items() for x in (F.lit(m), F.lit(s))])[F.col("measure")]
    fences = fences.select(
        "up", "gl", "gs", "measure", "total",
        (F.col("q2") + SPREAD * (F.col("q3") - F.col("q2")) + slack).alias("hi"),
        (F.col("q2") - SPREAD * (F.col("q2") - F.col("q1")) - slack).alias("lo"))
    wide = fences.groupBy("up", "gl", "gs").agg(
        F.max("total").alias("total"),
        *[F.max(F.when(F.col("measure") == m, F.col(x))).cast("long").alias(f"{x}_{m}")
          for m in MEASURES for x in ("lo", "hi")])
    cols = [f"{x}_{m}" for m in MEASURES for x in ("lo", "hi")]
    fence = F.struct(*cols).alias("f")
    groups = wide.filter("up = 0").select(F.col("gl").alias("lang"), F.col("gs").alias("source"), "total", fence)
    langs = wide.filter("up = 1").select(F.col("gl").alias("l2"), F.col("total").alias("t2"), F.struct(*cols).alias("f2"))
    every = wide.filter("up = 2").select(F.struct(*cols).alias("f3"))
    j = (groups.join(langs, F.col("lang").eqNullSafe(F.col("l2")), "left")
         .join(F.broadcast(every), F.lit(True), "left"))  # exactly one row at most
    pick = (F.when(F.col("total") >= MIN_GROUP, F.col("f"))
            .when(F.col("t2") >= MIN_GROUP, F.col("f2")).otherwise(F.col("f3")))
    return j.select("lang", "source", pick.alias("f")).select("lang", "source", "f.*")


def verdict(prefix: str = "") -> Column:
    """Not failed by the base rule, and inside its group's fences."""
    ok = ~base_failed(prefix)
    for m, (_, _, low, _) in MEASURES.items():
        v = measure(m, prefix)
        ok = ok & (v <= F.col(f"hi_{m}"))
        if low:
            ok = ok & (v >= F.col(f"lo_{m}"))
    return F.coalesce(ok, F.lit(False))


def judged(rows: DataFrame, prefix: str = "") -> DataFrame:
    """Stored, measured rows joined with their group's fences, plus ``base_failed`` and ``kept``."""
    cut = C.stored(cutoffs(sketches(rows, prefix)), "quality-cutoffs")
    cut = C.small_side(cut.withColumnRenamed("lang", "__q_lang").withColumnRenamed("source", "__q_source"))
    return (rows.join(cut, F.col("lang").eqNullSafe(F.col("__q_lang"))
                      & F.col("source").eqNullSafe(F.col("__q_source")), "left")
            .withColumn(prefix + "base_failed", base_failed(prefix))
            .withColumn(prefix + "kept", verdict(prefix)))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    rows = C.stored(measured(docs, prefix="__q_"), "quality-rows")
    return judged(rows, "__q_").filter("__q_kept").select(*[f"`{c}`" for c in docs.columns])


def op10_quality_rules(spark: SparkSession, base: str) -> DataFrame:
    """Every document with its counts, the base rule and the verdict."""
    docs = C.read(spark, base, "documents").select("doc_id", "lang", "source", "text")
    rows = C.stored(measured(docs).drop("text"), "quality-rows")
    return judged(rows).select("doc_id", *METRICS, "base_failed", "kept")


_FENCED = " AND ".join(
    f"NOT EXISTS (SELECT 1 FROM judged j WHERE j.rid = t.rid AND j.measure = '{m}' AND (j.v > j.hi"
    + (" OR j.v < j.lo" if low else "") + "))" for m, (_, _, low, _) in MEASURES.items())
ORACLE_SQL = rf"""
WITH src AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
tok AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, string_split(text, chr(10)) AS ls FROM src),
win AS (SELECT rid, i, list_aggregate(ws[i:i+7], 'string_agg', ' ') AS w
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM tok WHERE len(ws) >= 8)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS pos FROM twice) GROUP BY rid),
lines AS (SELECT rid, unnest(ls) AS l FROM tok),
dup AS (SELECT rid, sum(c - 1) AS n FROM (SELECT rid, l, count(*) AS c FROM lines
        WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid, l) GROUP BY rid),
t AS (SELECT tok.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM tok LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid)),
b AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words) AS base_failed FROM t),
v AS (SELECT rid, lang, source, m.measure, m.v, m.slack FROM b,
        LATERAL (SELECT unnest([{", ".join(f"{{'measure': '{m}', 'v': {SCALE} * {num} // {den}, 'slack': {slack}}}" for m, (num, den, _, slack) in MEASURES.items())}]) AS m)
      WHERE NOT base_failed),
s AS (SELECT *, (v >> greatest(length(bin(v)) - {SKETCH_BITS}, 0)) << greatest(length(bin(v)) - {SKETCH_BITS}, 0) AS bucket FROM v),
g AS (SELECT up, measure, bucket, slack, CASE WHEN up < 2 THEN lang END AS gl, CASE WHEN up < 1 THEN source END AS gs, count(*) AS n
      FROM s, (VALUES (0), (1), (2)) AS u(up) GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY up, gl, gs, measure) AS total,
             sum(n) OVER (PARTITION BY up, gl, gs, measure ORDER BY bucket) AS upto FROM g),
q AS (SELECT up, gl, gs, measure, max(total) AS total, max(slack) AS slack,
             min(CASE WHEN upto * 4 >= total THEN bucket END) AS q1,
             min(CASE WHEN upto * 4 >= total * 2 THEN bucket END) AS q2,
             min(CASE WHEN upto * 4 >= total * 3 THEN bucket END) AS q3 FROM r GROUP BY ALL),
f AS (SELECT *, q2 + {SPREAD} * (q3 - q2) + slack AS hi, q2 - {SPREAD} * (q2 - q1) - slack AS lo FROM q),
judged AS (SELECT v.rid, v.measure, v.v,
    CASE WHEN f0.total >= {MIN_GROUP} THEN f0.hi WHEN f1.total >= {MIN_GROUP} THEN f1.hi ELSE f2.hi END AS hi,
    CASE WHEN f0.total >= {MIN_GROUP} THEN f0.lo WHEN f1.total >= {MIN_GROUP} THEN f1.lo ELSE f2.lo END AS lo
  FROM v JOIN f f0 ON f0.up = 0 AND f0.gl IS NOT DISTINCT FROM v.lang AND f0.gs IS NOT DISTINCT FROM v.source AND f0.measure = v.measure
         JOIN f f1 ON f1.up = 1 AND f1.gl IS NOT DISTINCT FROM v.lang AND f1.measure = v.measure
         JOIN f f2 ON f2.up = 2 AND f2.measure = v.measure)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_FENCED} AS kept
FROM b t
"""
