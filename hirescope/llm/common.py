"""Helpers shared by the training-data operators.

``stored`` writes an intermediate table under the cluster's shared checkpoint
folder and reads it back (lineage cut, known size for the optimizer).
``word_hashes`` tokenises a whole Arrow column of texts at once: words are
runs of bytes other than ``\\x20`` and ``\\x09-\\x0D``, each named by a 64-bit
hash, so a batch costs a few NumPy passes and no per-word Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"

#: a task tokenises at most this many bytes of text at once (one text is never cut)
CHUNK_BYTES = 1 << 20

#: a side is broadcast only below this many (narrow) rows
BROADCAST_ROWS = 5_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a stored narrow table for broadcast if its counted rows are few."""
    n = df.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def most_frequent(counts: DataFrame, top: int, n: str = "n") -> DataFrame:
    """The rows with the largest counts, at most ``top``: all from a count on.

    The count is read from a histogram of the counts' leading 8 bits (some
    thousand rows at most), so no task and no driver sorts the table. Of the bucket
    with which ``top`` would be exceeded, a share by hash of the whole row fills up
    what is left, so the result has about ``top`` rows at most.
    """
    shift = F.greatest(F.length(F.bin(F.col(n))) - 8, F.lit(0))
    bucket = F.call_function("shiftleft", F.call_function("shiftright", F.col(n), shift), shift)
    floor, held, edge, share = None, 0, None, 0.0
    for r in sorted(counts.groupBy(bucket.alias("b")).agg(F.count("*").alias("m")).collect(), reverse=True):
        held += r.m
        if held > top:
            edge, share = r.b, 1 - (held - top) / r.m
            break
        floor = r.b
    whole = F.lit(False) if floor is None else F.col(n) >= floor
    if edge is None or share <= 0:
        return counts.filter(whole)
    draw = F.pmod(F.xxhash64(*counts.columns, F.lit(29)), F.lit(1 << 40)) < int(share * (1 << 40))
    return counts.filter(whole | ((bucket == edge) & draw))


def hash_sample(df: DataFrame, keys: list[str], rows: int, wanted: int) -> DataFrame:
    """About ``wanted`` of the ``rows`` rows, by a hash of the keys; equal ones once, so that many copies of a row can't add up."""
    share = min(1.0, wanted / max(rows, 1))
    return df.filter(F.pmod(F.xxhash64(*keys, F.lit(11)), F.lit(1 << 40)) < int(share * (1 << 40))).dropDuplicates(keys)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 1024)
        p = np.full(size, _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.cumprod(p, dtype=np.uint64)
    return _POWERS


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts joined, and where each text begins and ends (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = texts.buffers()
    ends = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def run_hashes(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``data[start:start+len]`` (runs disjoint, in order, not empty)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    total = int(lens.sum())
    at = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=at[1:])
    rel = np.arange(total, dtype=np.int64) - np.repeat(at, lens)
    idx = rel + np.repeat(starts, lens)
    vals = _BYTE_CODE[data[idx]]
    vals *= _powers(int(lens.max()))[rel]
    h = np.add.reduceat(vals, at)
    return mix64(h ^ (lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def word_spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: start, length and the index of its text."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    first = ends[:-1]
    before[first[first < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    last = ends[1:] - 1
    after[last[last >= 0]] = False
    stops = np.flatnonzero(inside & ~after) + 1
    return starts, stops - starts, np.searchsorted(ends, starts, "right") - 1


def word_hashes(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per word of all texts, in order: its 64-bit hash and the index of its text."""
    data, ends = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    starts, lens, doc = word_spans(data, ends)
    return run_hashes(data, starts, lens), doc


def chunks(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of ``column`` (a longer text stays whole)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        _, ends = text_bytes(b.column(column))
        at = 0
        while at < b.num_rows:
            to = int(np.searchsorted(ends, ends[at] + limit, "right")) - 1
            to = min(max(to, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to


def per_text(doc: np.ndarray, n: int) -> np.ndarray:
    """Words per text."""
    return np.bincount(doc, minlength=n).astype(np.int64)
