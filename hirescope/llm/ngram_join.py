"""Exact n-gram Jaccard join as a blocked sparse matrix product.

Rows of the incidence matrix are documents (one per distinct shingle set),
columns are 5-word shingles; the product of the matrix with its transpose
holds the overlaps. Two sets of n and m shingles link when 4 * overlap >=
3 * union, that is overlap >= 3 (n + m) / 7. Only entries that can reach this
bound are computed:

1. Columns in hash order; a set's first 40 % of them are its head. Sets that
   link share at least 15 % of the larger one's size within their heads (the
   3/7 bound less what lies behind the heads). So the heads' postings are dealt
   out by column, columns with one set are dropped, and a set with fewer shared
   head columns than its bound links nothing and is dropped. The most frequent
   columns are known before: each task keeps a summary of its ``HEAVY`` most
   frequent ones, and the summaries add up. Such a column counts as frequent
   without being gathered; its postings are dealt out by set as well.
2. Of the shared head columns a set keeps, rarest first, as many as a linked
   partner cannot all avoid. Frequent columns - passages that many documents
   share - thereby block almost nothing.
3. The product is taken over what the kept columns tie together. Pairs of sets
   that share a column of at most ``FEW`` sets are listed once and their overlap
   counted on the full sets. Sets tied by more frequent columns form groups; a
   group's incidence matrix is cut into chunks of rows in order of set size, two
   chunks meet in a task unless all their sizes are too far apart, and the task
   accumulates the overlaps slab of columns by slab. Pairs below the bound are
   discarded there, and of the links only those that join something are given
   out, so a group of thousands of near copies leaves thousands of rows, not
   their square. No pair is left undecided.
4. Components are found by alternating stars on the link table.

Shingle sets, columns and set names are 64-bit hashes. Bounded in memory: runs
of a column stream through a task and at most ``HOT`` rows of one are held.

Defined results: null, empty and wordless texts have no shingles, link with
nothing and are their own component; a text of one to four words is one
shingle; repeated rows are one set; a null id takes part and its component is
the smallest id reached, null if there is none; an empty table gives an empty
result; only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirescope.llm import common as C

WORDS = 5
HOT = 1024
FEW = 8  # a column with more sets is multiplied as part of a group
CHUNK = 500_000  # entries of a chunk of a group's rows
ROWS = 2_500  # rows of a chunk, if they are short: a task's overlaps are at most some (4 * ROWS)^2 numbers
SLAB = 4096  # columns multiplied at once
BROADCAST_IDS = 400_000  # 8-byte ids of documents to be looked up: at most some 10 MB
HEAVY = 8192  # columns in a task's summary of the most frequent ones
SPLIT = 16_384  # columns with more than this share of all rows are joined by broadcast: there are no more than this many
PIECES = 4096  # tasks over which the sets of such a column are dealt out


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles by (text, hash): the hashes, where each text's begin and end, and each text's
    number of shingles and set name."""
    n = len(texts)
    h, doc = C.word_hashes(texts, True)
    words = C.per_text(doc, n)
    begin = np.cumsum(words) - words
    k = len(h) - WORDS + 1
    win = np.zeros(0, np.uint64)
    at = np.zeros(0, np.int64)
    if k > 0:
        win = np.zeros(k, np.uint64)
        for i in range(WORDS):
            win = win * np.uint64(0x9E3779B97F4A7C15) + h[i:i + k]
        full = doc[:k] == doc[WORDS - 1:]
        win, at = win[full], doc[:k][full]
    short = np.flatnonzero((words > 0) & (words < WORDS))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for i in range(WORDS - 1):
            has = words[short] > i
            whole[has] = whole[has] * np.uint64(0x9E3779B97F4A7C15) + h[begin[short[has]] + i]
        win = np.concatenate([win, whole + words[short].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)])
        at = np.concatenate([at, short])
    win = C.mix64(win)
    order = np.lexsort((win, at))
    win, at = win[order], at[order]
    new = np.ones(len(win), bool)
    new[1:] = (win[1:] != win[:-1]) | (at[1:] != at[:-1])
    win, at = win[new], at[new]
    size = np.bincount(at, minlength=n).astype(np.int64)
    ends = np.zeros(n + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    run = np.zeros(len(win) + 1, np.uint64)
    np.cumsum(C.mix64(win ^ np.uint64(0xA0761D6478BD642F)), out=run[1:])
    name = C.mix64((run[ends[1:]] - run[ends[:-1]]) ^ (size.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)))
    return win.view(np.int64), ends, size, name.view(np.int64)


def heads(win: np.ndarray, ends: np.ndarray, size: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The head columns of a batch's sets and, beside each, its set; equal sets give one."""
    _, first = np.unique(name, return_index=True)
    first = first[size[first] > 0]
    n = size[first]
    head = np.maximum(-(-2 * n // 5), n // 4 + 1)
    stop = np.cumsum(head)
    idx = np.arange(int(head.sum())) + np.repeat(ends[:-1][first] - (stop - head), head)
    return win[idx], np.repeat(name[first], head)


def summed(known: np.ndarray, counts: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A summary of at most HEAVY columns and lower bounds of their counts, with ``cols`` added.

    What the largest column left out counts is taken off all others (Misra and
    Gries), so no bound is too high, and none too low by more than the postings seen
    over HEAVY.
    """
    new, times = np.unique(cols, return_counts=True)
    known, at = np.unique(np.concatenate([known, new]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([counts, times]), len(known)).astype(np.int64)
    if len(known) > HEAVY:
        counts = counts - np.partition(counts, len(counts) - HEAVY - 1)[len(counts) - HEAVY - 1]
        known, counts = known[counts > 0], counts[counts > 0]
    return known, counts


def digests(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text_id, n, name, heavy) of every row; name null without shingles.

    ``heavy`` is null but for one more row of each task, which holds its summary of frequent
    head columns and as n the number of its head postings.
    """
    src = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_id"))
    kind = src.schema["doc_id"].dataType.simpleString()
    heavy_type = pa.list_(pa.struct([("h", pa.int64()), ("c", pa.int64())]))
    names = ["doc_id", "text_id", "n", "name", "heavy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, total, id_type = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, None
        for b in C.chunks(batches, "text"):
            win, ends, size, name = shingle_sets(b.column(1))
            cols, _ = heads(win, ends, size, name)
            known, counts = summed(known, counts, cols)
            total += len(cols)
            id_type = b.column(0).type
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(size), pa.array(name, mask=size == 0),
                                              pa.nulls(len(size), heavy_type)], names=names)
        if total:  # columns far below the share of a heavy one are left out
            told = np.flatnonzero(4 * HEAVY * counts > total)
            heavy = [{"h": int(known[i]), "c": int(counts[i])} for i in told]
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.array([total]),
                                              pa.nulls(1, pa.int64()), pa.array([heavy], heavy_type)], names=names)

    return src.mapInArrow(run, f"doc_id {kind}, text_id long, n long, name long, heavy array<struct<h: long, c: long>>")


def heavy_columns(summaries: DataFrame) -> DataFrame:
    """(h): head columns that surely have over ``2 * HOT`` postings and over 1 / SPLIT of all; so at most SPLIT columns.

    A column left out has at most that share and 1.25 / HEAVY of all postings.
    """
    total = summaries.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    return (summaries.select(F.explode("heavy").alias("e")).groupBy("e.h").agg(F.sum("e.c").alias("c"))
            .filter(F.col("c") > max(2 * HOT, total // SPLIT)).select("h"))


def head_postings(docs: DataFrame, text: str) -> DataFrame:
    """(h, name): the head columns of every set; equal sets of a batch give one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, "text"):
            cols, sets = heads(*shingle_sets(b.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(cols), pa.array(sets)], names=["h", "name"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "h long, name long")


def shared_columns(postings: DataFrame, heavy: DataFrame) -> DataFrame:
    """(name, h, df): the postings of columns with at least two sets; df is at most HOT.

    Those of ``heavy`` columns (at most SPLIT, known to be frequent) are dealt out by column and set
    and pass as they are; all others are dealt out by column.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_h, held_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        hot: int | None = None

        def out(h: np.ndarray, name: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(name), pa.array(h), pa.array(df.astype(np.int32))],
                                              names=["name", "h", "df"])

        def close(h: np.ndarray, name: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Whole runs: distinct sets per column, columns with one set dropped."""
            order = np.lexsort((name, h))
            h, name = h[order], name[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (name[1:] != name[:-1])
            h, name = h[new], name[new]
            _, run_of, size = np.unique(h, return_inverse=True, return_counts=True)
            df = np.minimum(size[run_of], HOT)
            keep = df > 1
            if keep.any():
                yield out(h[keep], name[keep], df[keep])

        for b in batches:
            h, name = b.column(0).to_numpy(), b.column(1).to_numpy()
            split = b.column(2).to_numpy() > 0
            if split.any():
                yield out(h[split], name[split], np.full(int(split.sum()), HOT))
            h = np.concatenate([held_h, h[~split]])
            name = np.concatenate([held_n, name[~split]])
            if hot is not None:  # the run that is known to be long goes on
                same = h == hot
                if same.any():
                    yield out(h[same], name[same], np.full(int(same.sum()), HOT))
                h, name = h[~same], name[~same]
                if not len(h):
                    held_h, held_n = h, name
                    continue
                hot = None
            last = int(np.searchsorted(h, h[-1], "left")) if len(h) else 0
            if last:
                yield from close(h[:last], name[:last])
            held_h, held_n = h[last:], name[last:]
            if len(held_h) > 2 * HOT:
                distinct = np.unique(held_n)
                if len(distinct) > HOT:
                    hot = int(held_h[0])
                    yield out(np.full(len(distinct), hot), distinct, np.full(len(distinct), HOT))
                    held_h = held_n = np.zeros(0, np.int64)
                else:
                    held_h, held_n = np.full(len(distinct), held_h[0]), distinct
        if len(held_h):
            yield from close(held_h, held_n)

    known = F.broadcast(heavy.withColumnRenamed("h", "heavy"))
    piece = F.when(F.col("heavy").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("name"), F.lit(PIECES)) + 1)
    dealt = postings.join(known, F.col("h") == F.col("heavy"), "left").select("h", "name", piece.cast("int").alias("piece"))
    return (dealt.repartition("h", "piece").sortWithinPartitions("h")
            .mapInArrow(run, "name long, h long, df int"))


def tied_columns(kept: DataFrame) -> DataFrame:
    """``kept`` with every column's number of sets c and smallest set m; columns kept by one set alone are dropped.

    Columns with more than 1 / SPLIT of the rows (at most SPLIT) are joined by broadcast, so that none
    of them is dealt to one task; the others by column.
    """
    columns = C.stored(kept.groupBy("h").agg(F.count("*").alias("c"), F.min("name").alias("m")).filter("c > 1")
                       .withColumnRenamed("h", "ch"), "join-columns")
    large = F.col("c") > max(HOT, kept.count() // SPLIT)
    some = F.broadcast(columns.filter(large))
    here = F.col("h") == F.col("ch")
    rest = kept.join(some.select("ch"), here, "left_anti").join(columns.filter(~large), here)
    return kept.join(some, here).drop("ch").unionByName(rest.drop("ch"))


def blocks(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """(h, name, n): per set the rarest shared head columns that a linked partner cannot all avoid."""
    cols = F.array_sort(F.collect_set(F.struct("df", "h")))
    need = F.expr("(3 * n + 19) div 20")
    kept = (shared.groupBy("name").agg(cols.alias("cols"))
            .join(classes.select("name", "n"), "name")
            .withColumn("keep", F.size("cols") - need + 1).filter("keep > 0"))
    return kept.select("name", "n", F.explode(F.slice("cols", F.lit(1), F.col("keep").cast("int"))).alias("c")).select(
        "c.h", "name", "n")


def full_sets(docs: DataFrame, key: str, text: str, wanted: DataFrame, rows: int) -> DataFrame:
    """(name, n, s) for the documents in ``wanted`` (doc_id), one row per set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, "text"):
            win, ends, size, name = shingle_sets(b.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(name), pa.array(size), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(win))],
                names=["name", "n", "s"])

    w = wanted.withColumnRenamed("doc_id", "__id")
    short = not isinstance(wanted.schema["doc_id"].dataType, (T.StringType, T.BinaryType))
    w = F.broadcast(w) if short and rows <= BROADCAST_IDS else w
    src = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    found = src.join(w, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").select("text")
    return found.mapInArrow(run, "name long, n long, s array<long>").filter("n > 0").dropDuplicates(["name"])


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets overlap enough."""
    one = sets.select(F.col("name").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    two = sets.select(F.col("name").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    both = pairs.join(one, "a").join(two, "b")
    return both.filter(7 * F.size(F.array_intersect("sa", "sb")) >= 3 * (F.col("na") + F.col("nb"))).select("a", "b")


def with_smallest(ends: DataFrame, rows: int) -> DataFrame:
    """(u, v, m): every row with the smallest v of its u.

    A u with more than 1 / SPLIT of the rows and over HOT (at most SPLIT of them, ``rows``
    in all) is joined by broadcast, so its rows stay where they are.
    """
    least = ends.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c")).withColumnRenamed("u", "w")
    here = F.col("u") == F.col("w")
    if rows <= HOT:  # there can't be such a u
        return ends.join(least, here).select("u", "v", "m")
    large = F.col("c") > max(HOT, rows // SPLIT)
    hubs = F.broadcast(least.filter(large))
    rest = ends.join(hubs.select("w"), here, "left_anti").join(least.filter(~large), here)
    return ends.join(hubs, here).select("u", "v", "m").unionAll(rest.select("u", "v", "m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): comp is the smallest node reached, by alternating stars until nothing changes.

    Each star step replaces a node's edges by edges to its smallest neighbour;
    minima are partial aggregates and a node with many edges is not dealt to one task.
    """
    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                  F.bit_xor(F.xxhash64("v", "u", F.lit(5))).alias("y")).first()  # edges are distinct
        return r.n, r.x, r.y

    e = C.stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .filter("u <> v").distinct(), "join-edges")
    last = state(e)
    while last[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (with_smallest(both, 2 * last[0]).filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        small = (with_smallest(large, 2 * last[0])
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").filter("u <> v").distinct())
        e = C.stored(small, "join-edges")
        now = state(e)
        if now == last:
            break
        last = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))


def product(sizes: np.ndarray, lens_a: np.ndarray, cols_a: np.ndarray, lens_b: np.ndarray,
            cols_b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per row of A the rows of B that overlap enough: A times B transposed, slab of columns by slab.

    ``sizes`` are A's then B's set sizes. Only columns that both sides have are multiplied.
    """
    na, nb = len(lens_a), len(lens_b)
    common = np.intersect1d(cols_a, cols_b)
    row_a, row_b = np.repeat(np.arange(na), lens_a), np.repeat(np.arange(nb), lens_b)

    def entries(cols: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(common, cols), max(len(common) - 1, 0))
        hit = common[at] == cols if len(common) else np.zeros(len(cols), bool)
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], rows[hit][order]

    (ca, ra), (cb, rb) = entries(cols_a, row_a), entries(cols_b, row_b)
    overlap = np.zeros((na, nb), np.float32)
    for lo in range(0, len(common), SLAB):
        hi = min(lo + SLAB, len(common))
        x, y = np.zeros((na, hi - lo), np.float32), np.zeros((nb, hi - lo), np.float32)
        s = slice(*np.searchsorted(ca, [lo, hi]))
        x[ra[s], ca[s] - lo] = 1
        s = slice(*np.searchsorted(cb, [lo, hi]))
        y[rb[s], cb[s] - lo] = 1
        overlap += x @ y.T
    enough = 7 * overlap >= 3 * (sizes[:na, None] + sizes[None, na:])
    for i in np.flatnonzero(enough.any(axis=1)):
        yield int(i), np.flatnonzero(enough[i])


def spanning(names: np.ndarray, rows: Iterator[tuple[int, np.ndarray]]) -> tuple[list[int], list[int]]:
    """Of the links (row, rows) those that join something not joined before."""
    label = np.arange(len(names))
    a: list[int] = []
    b: list[int] = []
    for i, js in rows:
        ls, first = np.unique(label[js], return_index=True)
        new = ls != label[i]
        if new.any():
            a += [int(names[i])] * int(new.sum())
            b += names[js[first[new]]].tolist()
            label[np.isin(label, ls)] = label[i]
    return a, b


def group_links(frequent: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links that span the components among sets that share frequent columns (with their smallest set m).

    The sets that such columns tie together are a group. Its rows, in order of
    size, are cut into chunks of about ``CHUNK`` entries or ``ROWS`` short rows (no
    task ever sorts a whole group); two chunks meet in a task unless all their
    sizes are too far apart. A task holds two chunks.
    """
    groups = components(frequent.select(F.col("name").alias("a"), F.col("m").alias("b")).distinct())
    groups = groups.select(F.col("node").alias("name"), F.col("comp").alias("g")).union(
        groups.select(F.col("comp").alias("name"), F.col("comp").alias("g")).distinct())
    sized = groups.join(sets.select("name", "n"), "name").withColumn(
        "load", F.greatest(F.col("n"), F.lit(CHUNK // ROWS)))
    # chunks are dealt out by set size; the sets of one size are split by hash where they fill several
    w = W.partitionBy("g").orderBy("n").rowsBetween(W.unboundedPreceding, -1)  # one row per set size
    steps = sized.groupBy("g", "n").agg(F.sum("load").alias("t")).select(
        F.col("g").alias("tg"), F.col("n").alias("tn"),
        F.floor(F.coalesce(F.sum("t").over(w), F.lit(0)) / CHUNK).alias("first"), F.ceil(F.col("t") / CHUNK).alias("parts"))
    placed = C.stored(
        sized.join(steps, (F.col("g") == F.col("tg")) & (F.col("n") == F.col("tn")))
        .select("g", "name", "n", (F.col("first") + F.pmod(F.xxhash64("name"), F.col("parts"))).cast("int").alias("c")),
        "join-groups")
    spans = placed.groupBy("g", "c").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    one = spans.select(F.col("g").alias("g1"), F.col("c").alias("i"), F.col("hi").alias("hi1"))
    meets = (spans.join(one, (F.col("g") == F.col("g1")) & (F.col("i") <= F.col("c"))
                        & (4 * F.col("hi1") >= 3 * F.col("lo")))
             .select("g", "i", F.col("c").alias("j")))
    sides = meets.select("g", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("side"))
    rows = (placed.select("g", "c", "name").join(sides.withColumnRenamed("g", "sg"),
                                                 (F.col("g") == F.col("sg")) & (F.col("c") == F.col("side")))
            .select("g", "i", "j", "side", F.col("name").alias("member"))
            .join(sets, F.col("member") == F.col("name")).select("g", "i", "j", "side", "name", "s"))

    def multiply(t: pa.Table) -> pa.RecordBatch:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        side = t.column("side").to_numpy()
        names = t.column("name").to_numpy()
        lists = t.column("s").combine_chunks()
        lens = lists.value_lengths().to_numpy()
        flat = lists.flatten().to_numpy()
        cut = int((side == i).sum())  # sorted by side
        at = int(lens[:cut].sum())
        if i == j:
            found = ((r, k[k > r]) for r, k in product(np.concatenate([lens, lens]), lens, flat, lens, flat))
        else:
            found = ((r, k + cut) for r, k in product(lens, lens[:cut], flat[:at], lens[cut:], flat[at:]))
        a, b = spanning(names, ((r, k) for r, k in found if len(k)))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            key = np.stack([b.column(c).to_numpy() for c in (0, 1, 2)])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                part = b.slice(lo, hi - lo)
                if held and any(held[0].column(c)[0] != part.column(c)[0] for c in (0, 1, 2)):
                    yield multiply(pa.Table.from_batches(held))
                    held = []
                held.append(part)
        if held:
            yield multiply(pa.Table.from_batches(held))

    return (rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "side", "name")
            .mapInArrow(run, "a long, b long"))


def link_components(kept: DataFrame, sets: DataFrame) -> DataFrame:
    """(name, comp) of the sets that link with another."""
    many = C.stored(group_links(kept.filter(F.col("c") > FEW), sets), "join-links")
    # columns of at most FEW sets: a set meets FEW - 1 others in one, and each pair is counted once
    few = kept.filter(F.col("c") <= FEW)
    other = few.select(F.col("h").alias("h2"), F.col("name").alias("b"), F.col("n").alias("nb"))
    pairs = (few.join(other, (F.col("h") == F.col("h2")) & (F.col("name") < F.col("b"))
                      & (4 * F.least("n", "nb") >= 3 * F.greatest("n", "nb")))
             .select(F.col("name").alias("a"), "b").distinct())
    links = many.union(linked(pairs, sets))
    return components(links).select(F.col("node").alias("name"), "comp")


def classified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text_id, n_shingles, component_id) of every row."""
    told = C.stored(digests(docs, key, text), "join-rows")
    rows = told.filter("heavy is null").drop("heavy")
    heavy = C.stored(heavy_columns(told.filter("heavy is not null").select("n", "heavy")), "join-heavy")
    classes = C.stored(rows.filter("name is not null").groupBy("name").agg(
        F.min("doc_id").alias("doc_id"), F.min("n").alias("n")), "join-classes")
    kept = C.stored(blocks(shared_columns(head_postings(docs, text), heavy), classes), "join-kept")
    kept = C.stored(tied_columns(kept), "join-tied")
    wanted = C.stored(classes.join(kept.select("name").distinct(), "name", "left_semi").select("doc_id"), "join-wanted")
    sets = C.stored(full_sets(docs, key, text, wanted, wanted.count()), "join-sets")
    comps = link_components(kept, sets)

    c = comps.select(F.col("name").alias("cn"), "comp")
    named = classes.join(c, F.col("name") == F.col("cn"), "left").select(
        "name", "doc_id", F.coalesce("comp", "name").alias("comp"))
    smallest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("comp", "sc")
    of = named.join(smallest, F.col("comp") == F.col("sc")).select(F.col("name").alias("on"), "component_id")
    of = C.stored(of, "join-components")
    return rows.join(of, F.col("name") == F.col("on"), "left").select(
        "doc_id", "text_id", F.col("n").alias("n_shingles"),
        F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    return classified(docs, key, text).drop("text_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document whose id names it.

    Rows that repeat its id and text stay once; rows without shingles all stay.
    """
    ids = C.stored(
        classified(docs, key, text).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("doc_id", "text_id").agg(F.sum((F.col("n_shingles") > 0).cast("int")).alias("__n"))
        .select(F.col("doc_id").alias("__keep"), F.col("text_id").alias("__text"), "__n"), "join-keep")
    mine = F.col(key).eqNullSafe(F.col("__keep")) & (F.xxhash64(text) == F.col("__text"))
    once = docs.join(ids.filter("__n < 2").drop("__n"), mine, "left_semi")
    repeated = ids.filter("__n > 1").drop("__n")
    if not repeated.limit(1).count():
        return once
    return once.unionByName(docs.join(repeated, mine, "left_semi").dropDuplicates([key, text]))


def op6_ngram_jaccard(spark: SparkSession, base: str) -> DataFrame:
    """All documents with their component."""
    return jaccard_join(C.read(spark, base, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS rid, list_transform(
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS sh FROM w),
e AS (SELECT rid, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.rid AS x, b.rid AS y FROM e a JOIN e b ON a.g = b.g AND a.rid < b.rid
      GROUP BY a.rid, b.rid HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
l AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r AS (SELECT rid AS a, rid AS b FROM s UNION SELECT r.a, l.y FROM r JOIN l ON r.b = l.x)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, min(t.doc_id) AS component_id
FROM r JOIN s ON r.a = s.rid JOIN s t ON r.b = t.rid GROUP BY s.rid, s.doc_id, s.sh
"""
