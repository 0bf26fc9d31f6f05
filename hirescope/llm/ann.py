"""Approximate nearest neighbours with an inverted multi-index.

Each vector is cut into two halves and each half quantised by a codebook of
its own; the pair of centroids is the vector's cell. A query visits cells in
order of the summed squared distance of its halves to the two centroids, taken
from a heap over the two sorted lists, until the visited cells hold enough
vectors; those are reranked with exact double precision distances.

* The codebooks are k-means on a bounded sample (``SAMPLE`` vectors or
  so, by hash of the id); K = sqrt(rows / CELL), at most ``MAX_K``, so the table of cell
  sizes that steers the traversal has at most MAX_K^2 entries. Every row is indexed.
* How many vectors are enough is measured: for ``PROBES`` sample queries the
  true neighbours are found by brute force over all rows, and the share of
  rows to visit is the one at which ``TARGET`` of them have been met. The
  same rule holds at every size.
* The index is packed into blocks of about ``BLOCK`` vectors of neighbouring
  cells; a cell with more is split over several blocks, so a hot vector does
  not make a hot task. Queries are packed into blocks of ``QUERIES`` with a
  common region, dealt by cell and id; an index block meets just the queries that visit it, with
  the visits to its own cells, and each meeting returns the best k per query.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do those of another length than the most common one among the rest (the shorter on ties);
vectors of one component have one codebook; equal
distances go to the smaller id; repeated rows of an id count once per query,
at their smallest distance; fewer candidates than k give all of them; an
empty table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirescope.llm import common as C

SAMPLE = 20_000
PROBES = 100
TARGET = 0.96
CELL = 10
MAX_K = 256
BLOCK = 4096
QUERIES = 256
FLOOR = 500  # vectors visited at least


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their vectors as float64."""
    lens = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ok = np.flatnonzero(lens == dim)
    if not len(ok):
        return ok, np.zeros((0, dim))
    flat = column.take(pa.array(ok)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    m = flat.reshape(len(ok), dim)
    good = np.isfinite(m).all(axis=1) & (m != 0).any(axis=1)
    return ok[good], m[good]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(1)[None] - 2 * x @ centres.T).argmin(1)


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds from a random start of distinct rows."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        a = _nearest(x, centres)
        n = np.bincount(a, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, a, x)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


class Cells:
    """The two codebooks and the order in which a query visits their pairs."""

    def __init__(self, one: np.ndarray, two: np.ndarray) -> None:
        self.one, self.two, self.half = one, two, one.shape[1]

    def of(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x[:, :self.half], self.one) * len(self.two) + _nearest(x[:, self.half:], self.two)

    def visit(self, q: np.ndarray) -> Iterator[int]:
        """Cells by summed distance: a heap over the pairs of two sorted lists."""
        d1 = ((self.one - q[:self.half]) ** 2).sum(1)
        d2 = ((self.two - q[self.half:]) ** 2).sum(1)
        o1, o2 = np.argsort(d1, kind="stable").tolist(), np.argsort(d2, kind="stable").tolist()
        s1, s2 = d1[o1].tolist(), d2[o2].tolist()
        heap = [(s1[0] + s2[0], 0, 0)]
        n1, n2, m2 = len(o1), len(o2), len(self.two)
        while heap:
            _, i, j = heapq.heappop(heap)
            yield o1[i] * m2 + o2[j]
            if j + 1 < n2:
                heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
            if j == 0 and i + 1 < n1:
                heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))


def top_k(queries: np.ndarray, x: np.ndarray, ids: np.ndarray, own: np.ndarray, allowed: np.ndarray,
          k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query (index, rows, distances) of its k nearest allowed ids, each at its nearest row, ties to the smaller id."""
    if not len(x):
        return
    rough = (queries ** 2).sum(1)[:, None] + (x ** 2).sum(1)[None] - 2 * queries @ x.T
    rough[~allowed | (ids[None] == own[:, None])] = np.inf
    # an id's rows count once, at the nearest
    by_id = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(ids[by_id]) != 0))
    nearest = rough if len(first) == len(ids) else np.minimum.reduceat(rough[:, by_id], first, axis=1)
    kk = min(k, nearest.shape[1])
    limit = np.partition(nearest, kk - 1, axis=1)[:, kk - 1]
    scale = (x ** 2).sum(1).max() + (queries ** 2).sum(1).max()
    for i in range(len(queries)):
        # rounding can't hide a near or equal one: all within a margin are measured exactly
        near = np.flatnonzero((rough[i] <= limit[i] + 1e-9 * scale) & np.isfinite(rough[i]))
        if len(near):
            d = np.sqrt(((x[near] - queries[i]) ** 2).sum(1))
            best = np.lexsort((ids[near], d))
            best = best[np.sort(np.unique(ids[near][best], return_index=True)[1])][:k]
            yield i, near[best], d[best]


def fit(vectors: DataFrame, dim: int, rows: int, sample: int = SAMPLE, seed: int = 7) -> Cells:
    """The codebooks, from a bounded sample (at most ``sample`` rows reach the driver)."""
    part = C.hash_sample(vectors.select("id", "v"), ["id", "v"], rows, sample).toArrow().sort_by("id")
    _, x = _matrix(part.column("v").combine_chunks(), dim)
    if not len(x):  # a few rows, none of them sampled
        _, x = _matrix(vectors.select("v").limit(sample).toArrow().column("v").combine_chunks(), dim)
    k = int(min(MAX_K, max(1, (rows / CELL) ** 0.5), max(1, len(x))))
    half = max(1, dim // 2)
    two = kmeans(x[:, half:], k, seed + 1) if dim > 1 else np.zeros((1, 0))  # nothing to cut: one half is empty
    return Cells(kmeans(x[:, :half], k, seed), two)


def index(vectors: DataFrame, cells: Cells, dim: int) -> DataFrame:
    """(id, v, cell) of every vector that takes part, equal rows once."""
    kind = vectors.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok, x = _matrix(b.column(1), dim)
            if len(ok):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(ok)), b.column(1).take(pa.array(ok)),
                     pa.array(cells.of(x).astype(np.int32))], names=["id", "v", "cell"])

    return vectors.select("id", "v").mapInArrow(run, f"id long, v {kind}, cell int").dropDuplicates()


def share_to_visit(indexed: DataFrame, cells: Cells, sizes: np.ndarray, dim: int, is_query: str, k: int,
                   target: float) -> float:
    """The share of all rows at which ``target`` of the true neighbours of sample queries have been met."""
    queries = indexed.filter(is_query)
    part = C.hash_sample(queries, ["id", "v"], queries.count(), PROBES).toArrow().sort_by("id")
    _, q = _matrix(part.column("v").combine_chunks(), dim)
    if not len(q):
        return 1.0
    own = part.column("id").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, x = _matrix(b.column(1), dim)
            ids, cell = b.column(0).to_numpy(), b.column(2).to_numpy()
            for i, near, d in top_k(q, x, ids, own, np.ones((len(q), len(x)), bool), k):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(near), i, np.int32)), pa.array(ids[near]), pa.array(d),
                     pa.array(cell[near])], names=["q", "id", "d", "cell"])

    w = W.partitionBy("q").orderBy("d", "id")
    true = (indexed.mapInArrow(run, "q int, id long, d double, cell int")
            .groupBy("q", "id").agg(F.min(F.struct("d", "cell")).alias("m")).select("q", "id", "m.d", "m.cell")
            .withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).collect())  # PROBES * k rows
    met: list[int] = []
    for i in range(len(q)):
        want = [r.cell for r in true if r.q == i]
        seen, at = {}, 0
        need = set(want)
        for c in cells.visit(q[i]):
            at += int(sizes[c])
            if c in need:
                seen[c] = at
                if len(seen) == len(need):
                    break
        met += [seen[c] for c in want]
    return float(np.quantile(met, target)) / max(int(sizes.sum()), 1) if met else 1.0


def search(table: DataFrame, is_query: str, key: str = "vec_id", vector: str = "embedding", k: int = 10,
           target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found. ``is_query`` is SQL over ``id``."""
    spark = table.sparkSession
    # original precision: float stays float, anything else is double
    kind = "float" if table.select(vector).dtypes[0][1] == "array<float>" else "double"
    real = np.float32 if kind == "float" else np.float64
    vectors = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(f"array<{kind}>").alias("v")).filter(
        "id is not null and v is not null")
    found = "query_id long, vec_id long, score double"
    vectors = vectors.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                             & F.exists("v", lambda x: x != 0))
    dims = (vectors.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "dim").limit(1).collect())
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = dims[0].dim
    vectors = vectors.filter(F.size("v") == dim)
    cells = fit(vectors, dim, dims[0].n)
    indexed = C.stored(index(vectors, cells, dim), "ann-index")
    sizes = np.zeros(len(cells.one) * len(cells.two), np.int64)
    for r in indexed.groupBy("cell").agg(F.count("*").alias("n")).collect():  # at most MAX_K^2 rows
        sizes[r.cell] = r.n
    share = share_to_visit(indexed, cells, sizes, dim, is_query, k, target)
    enough = max(int(np.ceil(share * sizes.sum())), min(FLOOR, int(sizes.sum())))

    # neighbouring cells share a block; a large cell is split
    parts = np.maximum(1, -(-sizes // BLOCK))
    first = np.zeros(len(sizes), np.int64)
    block = fill = 0
    for c, n in enumerate(sizes.tolist()):
        if n == 0:
            first[c] = block
        elif n > BLOCK:
            block += 1 if fill else 0
            first[c] = block
            block, fill = block + int(parts[c]), 0
        else:
            if fill + n > BLOCK:
                block, fill = block + 1, 0
            first[c], fill = block, fill + n

    def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, ids = b.column(2).to_numpy(), b.column(0).to_numpy()
            salt = (C.mix64(ids.astype(np.uint64)) % parts[cell].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(first[cell] + salt), *b.columns],
                                             names=["block", "id", "v", "cell"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by block to one row per block."""
        held: list[pa.RecordBatch] = []

        def packed(rows: pa.Table) -> pa.RecordBatch:
            v = rows.column("v").combine_chunks().flatten().to_numpy().astype(real)
            return pa.RecordBatch.from_arrays(
                [pa.array([rows.column("block")[0].as_py()], pa.int64()),
                 pa.array([rows.column("id").to_numpy().tobytes()], pa.binary()),
                 pa.array([rows.column("cell").to_numpy().astype(np.int32).tobytes()], pa.binary()),
                 pa.array([v.tobytes()], pa.binary())], names=["block", "ids", "cells", "vs"])

        for b in batches:
            held.append(b)
            t = pa.Table.from_batches(held)
            at = t.column("block").to_numpy()
            cut = np.flatnonzero(np.diff(at)) + 1
            begin = 0
            for e in cut.tolist():
                yield packed(t.slice(begin, e - begin))
                begin = e
            held = t.slice(begin).combine_chunks().to_batches()
        if held:
            yield packed(pa.Table.from_batches(held))

    blocks = (indexed.mapInArrow(block_rows, f"block long, id long, v array<{kind}>, cell int")
              .repartition("block").sortWithinPartitions("block")
              .mapInArrow(pack, "block long, ids binary, cells binary, vs binary"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per index block that a block of queries visits."""
        for b in batches:
            for at in range(0, b.num_rows, QUERIES):
                p = b.slice(at, QUERIES)
                _, q = _matrix(p.column(1), dim)
                seen = np.zeros((len(q), len(sizes)), bool)
                for i in range(len(q)):
                    got = 0
                    for c in cells.visit(q[i]):
                        seen[i, c] = True
                        got += int(sizes[c])
                        if got >= enough:
                            break
                ids = p.column(0).to_numpy()
                used = np.flatnonzero(seen.any(axis=0) & (sizes > 0))
                for at_block in np.unique(np.concatenate(
                        [np.arange(first[c], first[c] + parts[c]) for c in used] or [np.zeros(0, np.int64)])).tolist():
                    # the visits to the cells of this block alone, and the queries that make them
                    lo, hi = int(low[at_block]), int(high[at_block]) + 1
                    mine = seen[:, lo:hi].any(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([at_block], pa.int64()), pa.array([lo], pa.int32()),
                         pa.array([ids[mine].tobytes()], pa.binary()), pa.array([q[mine].astype(real).tobytes()], pa.binary()),
                         pa.array([np.packbits(seen[mine, lo:hi], axis=1).tobytes()], pa.binary())],
                        names=["block", "lo", "qids", "qs", "seen"])

    # the cells of each block are neighbours: from low to high
    low, high = np.full(block + 1, len(sizes)), np.zeros(block + 1, np.int64)
    for c in np.flatnonzero(sizes).tolist():
        span = slice(int(first[c]), int(first[c] + parts[c]))
        low[span], high[span] = np.minimum(low[span], c), np.maximum(high[span], c)

    routed = C.stored(indexed.filter(is_query).repartitionByRange("cell", "id").sortWithinPartitions("cell", "id")
                      .mapInArrow(route, "block long, lo int, qids binary, qs binary, seen binary"), "ann-queries")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                qids = np.frombuffer(r["qids"], np.int64)
                q = np.frombuffer(r["qs"], real).reshape(len(qids), dim).astype(np.float64)
                ids = np.frombuffer(r["ids"], np.int64)
                x = np.frombuffer(r["vs"], real).reshape(len(ids), dim).astype(np.float64)
                seen = np.unpackbits(np.frombuffer(r["seen"], np.uint8).reshape(len(qids), -1), axis=1)
                allowed = seen[:, np.frombuffer(r["cells"], np.int32) - r["lo"]].astype(bool)
                for i, near, d in top_k(q, x, ids, qids, allowed, k):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(near), qids[i])), pa.array(ids[near]), pa.array(d)],
                        names=["query_id", "vec_id", "score"])

    pairs = routed.join(blocks, "block")
    best = (pairs.select("lo", "qids", "qs", "seen", "ids", "cells", "vs").mapInArrow(meet, found)
            .groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))
    w = W.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_inverted_multi_index(spark: SparkSession, base: str) -> DataFrame:
    """The 10 nearest of every vector whose id is divisible by 100."""
    return search(C.read(spark, base, "embeddings"), "id % 100 = 0")
