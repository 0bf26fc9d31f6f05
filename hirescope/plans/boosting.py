"""Second-order boosted trees on Spark, with L1 and L2 terms and columns drawn per tree.

Squared loss, so a row's gradient is prediction - label and its hessian 1. A tree
grows level by level: each task adds up gradients and row counts per (node,
feature, bin) of its rows, and the driver adds the tasks' histograms (at most
nodes x features x bins cells a task, one task per split of the stored blocks) and takes
the best split of each node from them. With T(G) the gradient sum shrunk by L1,

    gain = T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2),
    leaf = - learning_rate * T(G) / (H + l2).

A feature of few values gets one bin a value; the bins of the others come from
``percentile_approx`` (a mergeable sketch), cut between neighbouring values. Features
are drawn per tree, rows per tree by a hash of their key, so a fit does not depend on
how the rows are dealt.

Training reads the rows once per tree and level, so they are stored as blocks of up
to ``BLOCK`` rows, by column, and kept by the executors (in memory, else on their disks;
what is lost is made again from the stored blocks). The bins of several features are the
digits of one code, so one count by code serves them all; sets of rows are bitmaps, and
whether rows lie above a cut follows from the bitmaps of the digits. Of the two children
of a split the one with fewer rows is added up, the other has what the parent has left.
Gradients and draws are carried in the blocks and brought up to date every ``KEEP`` trees.
The models of a cross-validation (:func:`fit_folds`) are trained side by side on the same
blocks, each on the rows of the other folds.

Defined results: null or NaN features go left (bin 0); rows without a label are left out;
without rows the model is empty and predicts null; ties between splits go to the
first feature and the smallest cut.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions import taxonomy as T
from hirescope.session import scratch_path

KEEP = 5
BLOCK = 1 << 15  # rows of a block
DIGITS = 10  # binary digits of a code, unless one feature needs more: its sums stay in the nearest cache
LOOKUP = 12  # binary digits of a place in several trees
SKETCH = 10_000  # accuracy of the sketch: ranks within rows / SKETCH

# fixed values: the regularisation of the salary model
L1, L2 = 1.0, 2.0


@dataclass
class BoostParams:
    trees: int = T.GBT_TREES
    depth: int = T.GBT_DEPTH
    learning_rate: float = T.GBT_LEARNING_RATE
    min_child: int = T.GBT_MIN_CHILD
    subsample: float = T.GBT_SUBSAMPLE
    colsample: float = T.GBT_COLSAMPLE
    l1: float = L1
    l2: float = L2
    bins: int = 32
    seed: int = T.GBT_SEED


@dataclass
class Tree:
    """A tree as arrays over heap positions (children of i: 2i + 1, 2i + 2); feature -1: leaf."""

    feature: np.ndarray
    cut: np.ndarray  # rows with a bin above it go right
    value: np.ndarray  # the leaf's (or would-be leaf's) step
    rows: np.ndarray
    gain: np.ndarray
    drawn: list[int] = field(default_factory=list)

    @classmethod
    def empty(cls, depth: int, drawn: list[int]) -> Tree:
        n = (1 << (depth + 1)) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64), np.zeros(n), drawn)

    def level(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(is a node, value) of every place at ``depth``; below a leaf the value is the leaf's."""
        live, value = np.ones(1, bool), self.value[:1]
        for d in range(depth):
            split = live & (self.feature[(1 << d) - 1:(2 << d) - 1] >= 0)
            live = np.repeat(split, 2)
            value = np.where(live, self.value[(2 << d) - 1:(4 << d) - 1], np.repeat(value, 2))
        return live, value


@dataclass
class BoostedModel:
    features: list[str]
    edges: list[list[float]]
    base: float | None
    trees: list[Tree]
    params: BoostParams

    def tree_table(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, threshold, gain, n_rows, value): every node of every tree."""
        rows = []
        for t, tree in enumerate(self.trees):
            live = {0}
            for i in range(len(tree.feature)):
                if i not in live:
                    continue
                f = int(tree.feature[i])
                if f >= 0:
                    live |= {2 * i + 1, 2 * i + 2}
                rows.append((t, i, self.features[f] if f >= 0 else None,
                             float(self.edges[f][tree.cut[i]]) if f >= 0 else None,
                             float(tree.gain[i]), int(tree.rows[i]), float(tree.value[i])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, gain double, "
                                           "n_rows long, value double")

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` plus its prediction.

        Only the decisions leave the JVM, ``WORD`` to a number: every distinct cut, whether the row lies above it.
        """
        cuts = sorted({(int(f), int(c)) for t in self.trees for f, c in zip(t.feature, t.cut, strict=True) if f >= 0})
        if self.base is None or not cuts:
            alike = None if self.base is None else self.base + sum(float(t.value[0]) for t in self.trees)
            return df.withColumn(out, F.lit(alike).cast("double"))

        def right(f: int, cut: int) -> Column:
            x = F.col(f"`{self.features[f]}`").cast("double")
            return x.isNotNull() & ~F.isnan(x) & (x > self.edges[f][cut])

        base, trees, depth = self.base, self.trees, self.params.depth

        def run(*words: pa.Array) -> pa.Array:
            given = [w.to_numpy(zero_copy_only=False) for w in words]
            rows = _Rows(len(given[0]), {c: np.packbits((given[i // WORD] & (1 << i % WORD)) != 0) for i, c in enumerate(cuts)})
            return pa.array(rows.after(np.full(rows.rows, base), trees, depth))

        return df.withColumn(out, F.arrow_udf(run, "double")(*packed([right(f, c) for f, c in cuts])))


WORD = 8


def packed(flags: list[Column]) -> list[Column]:
    """``WORD`` flags (never null) to an integer, in their order from the lowest digit."""
    return [functools.reduce(Column.bitwiseOR, [F.when(flag, F.lit(1 << j)).otherwise(F.lit(0))
                                               for j, flag in enumerate(flags[i:i + WORD])])
            for i in range(0, len(flags), WORD)]


def few_values(df: DataFrame, features: list[str], most: int) -> list[np.ndarray | None]:
    """Per feature its distinct values, None where there are more than ``most``.

    A task holds at most ``most`` + 1 values a feature beside its batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [np.empty(0) for _ in features]
        for b in batches:
            for j, have in enumerate(known):
                if len(have) > most:
                    continue
                x = b.column(j).to_numpy(zero_copy_only=False)
                new = x == x
                if len(have) <= 4:
                    for v in have:
                        new &= x != v
                else:
                    new &= have[np.minimum(np.searchsorted(have, x), len(have) - 1)] != x
                if new.any():
                    known[j] = np.union1d(have, x[new])[:most + 1]
        at = np.repeat(np.arange(len(known), dtype=np.int32), [len(k) for k in known])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.concatenate(known))], names=["i", "v"])

    src = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    found: list[set] = [set() for _ in features]
    for r in src.mapInArrow(run, "i int, v double").distinct().collect():
        found[r.i].add(r.v)
    return [np.array(sorted(v)) if len(v) <= most else None for v in found]


def bin_edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Per feature the cuts between its bins: at most ``bins`` - 1.

    One bin a value where there are at most ``bins`` values, else from a mergeable
    quantile sketch; one row with one array a feature reaches the driver.
    """
    values = few_values(df, features, bins)
    many = [i for i, v in enumerate(values) if v is None]
    if many:
        probs = [(i + 0.5) / (4 * bins) for i in range(4 * bins)]
        cols = {i: F.when(~F.isnan(F.col(f"`{features[i]}`").cast("double")), F.col(f"`{features[i]}`").cast("double"))
                for i in many}
        row = df.agg(*[F.percentile_approx(c, probs, SKETCH).alias(f"q{i}") for i, c in cols.items()],
                     *[F.min(c).alias(f"lo{i}") for i, c in cols.items()],
                     *[F.max(c).alias(f"hi{i}") for i, c in cols.items()]).first()
        for i in many:
            v = np.unique(np.array([row[f"lo{i}"], *row[f"q{i}"], row[f"hi{i}"]]))
            if len(v) > bins:
                v = np.unique(v[np.linspace(0, len(v) - 1, bins).round().astype(int)])
            values[i] = v
    return [((v[1:] + v[:-1]) / 2).tolist() for v in values]


def _hash01(key: np.ndarray, salt: int) -> np.ndarray:
    """A uniform number of each 64-bit key (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = key.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


BLOCKS = "keys binary, folds binary, grads binary, draws binary, codes binary"


def _layout(cells: list[int]) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Per feature (code, shift, digits) of its bin within the rows' codes, and the digits of every code."""
    at, sizes = [], [0]
    for n in cells:
        digits = (n - 1).bit_length()
        if sizes[-1] + digits > max(DIGITS, digits):
            sizes.append(0)
        at.append((len(sizes) - 1, sizes[-1], digits))
        sizes[-1] += digits
    return at, sizes


def _draws(keys: np.ndarray, number: int, p: BoostParams) -> bytes:
    """Whether each row is drawn, for tree ``number`` and those up to the next writing of the blocks: one bit each."""
    return b"".join(np.packbits(_hash01(keys, p.seed * 100_003 + t) < p.subsample).tobytes()
                    for t in range(number, number + KEEP))


def _packed(key: np.ndarray, fold: np.ndarray, y: np.ndarray, codes: np.ndarray, bases: list[float],
            p: BoostParams) -> list[bytes]:
    """One block of rows (``codes``: code by row), as the fields of ``BLOCKS``."""
    return [key.tobytes(), fold.tobytes(), (np.array(bases)[:, None] - y[None]).tobytes(), _draws(key, 0, p), codes.tobytes()]


def _blocks(df: DataFrame, key: str, label: str, features: list[str], edges: list[list[float]], bases: list[float],
            fold: Column, p: BoostParams | None = None) -> DataFrame:
    """The training rows in blocks (``BLOCKS``): one gradient a row and base, bins as digits of a few codes."""
    cuts = [np.array(e) for e in edges]
    at, sizes = _layout([len(e) + 1 for e in edges])
    p = p or BoostParams()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []

        def block() -> pa.RecordBatch:
            packed = _packed(*[np.concatenate(v, axis=-1) for v in zip(*parts, strict=True)], bases, p)
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in packed],
                                              names=[c.split()[0] for c in BLOCKS.split(", ")])

        size = 0
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                b = whole.slice(start, BLOCK)
                if size + b.num_rows > BLOCK and parts:
                    yield block()
                    size = 0
                codes = np.zeros((len(sizes), b.num_rows), np.uint16)
                for j, (c, (code, shift, digits)) in enumerate(zip(cuts, at, strict=True)):
                    if not digits:
                        continue
                    x = b.column(j + 3).to_numpy(zero_copy_only=False)
                    bins = x > c[0] if len(c) == 1 else np.where(np.isnan(x), 0, np.searchsorted(c, x, "left"))
                    codes[code] |= bins.astype(np.uint16) << np.uint16(shift)
                parts.append((b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int16), b.column(2).to_numpy(), codes))
                size += b.num_rows
        if parts:
            yield block()

    src = df.select(F.xxhash64(key).alias("key"), fold.cast("int").alias("fold"), F.col(label).cast("double").alias("y"),
                    *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)]).filter("y is not null")
    return src.mapInArrow(run, BLOCKS)


class _Rows:
    """Rows of which is ``known`` for every (feature, cut) which lie above; sets of rows are bitmaps of one bit a row."""

    def __init__(self, rows: int, known: dict[tuple, np.ndarray]):
        self.rows, self.width, self.known = rows, (rows + 7) // 8, known

    def bits(self, bitmap: np.ndarray) -> np.ndarray:
        return np.unpackbits(bitmap, count=self.rows)

    def right(self, f: int, cut: int) -> np.ndarray:
        return self.known[f, cut]

    def inside(self, tree: Tree, depth: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(the rows of every place at ``depth``, the rows that went right at every level above); below a leaf: left."""
        nodes, ways = [np.full(self.width, 255, np.uint8)], []
        for d in range(depth):
            below, way = [], np.zeros(self.width, np.uint8)
            for i, here in enumerate(nodes):
                f = int(tree.feature[(1 << d) - 1 + i])
                right = here & self.right(f, int(tree.cut[(1 << d) - 1 + i])) if f >= 0 else np.zeros_like(here)
                below += [here ^ right, right]
                way |= right
            nodes = below
            ways.append(way)
        return nodes, ways

    def after(self, start: np.ndarray, trees: list[Tree], depth: int) -> np.ndarray:
        """``start`` moved by the rows' steps in ``trees``; the steps of several trees are looked up at once."""
        group = max(1, LOOKUP // depth)
        for first in range(0, len(trees), group):
            at, steps = np.zeros(self.rows, np.uint16), np.zeros(1)
            for t in trees[first:first + group]:
                for way in self.inside(t, depth)[1]:
                    at <<= np.uint16(1)
                    at |= self.bits(way)
                steps = np.add.outer(steps, t.level(depth)[1]).ravel()
            start = start + steps.take(at.astype(np.intp), mode="wrap")  # whole words, unchecked: in half the time
        return start


class _Block(_Rows):
    """A block's arrays."""

    def __init__(self, held: tuple[bytes, ...], layout: list[tuple[int, int, int]]):
        self.keys, self.folds = np.frombuffer(held[0], np.int64), np.frombuffer(held[1], np.int16)
        super().__init__(len(self.keys), {})
        self.grads = np.frombuffer(held[2], np.float64).reshape(-1, self.rows)
        self.draws = np.frombuffer(held[3], np.uint8).reshape(KEEP, -1)
        self.codes = np.frombuffer(held[4], np.uint16).reshape(-1, self.rows)
        self.layout = layout

    def digit(self, code: int, bit: int) -> np.ndarray:
        got = self.known.get((None, code, bit))
        if got is None:
            got = self.known[None, code, bit] = np.packbits((self.codes[code] & np.uint16(1 << bit)) != 0)
        return got

    def right(self, f: int, cut: int) -> np.ndarray:
        """The rows above a cut of a feature: its bin compared with ``cut`` digit by digit, from the first."""
        got = self.known.get((f, cut))
        if got is None:
            code, shift, digits = self.layout[f]
            above, equal = np.zeros(self.width, np.uint8), np.full(self.width, 255, np.uint8)
            for i in reversed(range(digits)):
                one = self.digit(code, shift + i)
                if cut >> i & 1:
                    equal = equal & one
                else:
                    above, equal = above | (equal & one), equal & ~one
            got = self.known[f, cut] = above
        return got

    def moved(self, k: int, trees: list[Tree], depth: int) -> np.ndarray:
        """Model ``k``'s gradients after ``trees``."""
        return self.after(self.grads[k], trees, depth)


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "boosting")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dealt(rows: DataFrame) -> RDD:
    """The stored blocks as tuples of bytes, dealt evenly to as many tasks as there are cores."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism

    def run(part: int, held: Iterator) -> Iterator[tuple]:
        for i, r in enumerate(held):
            yield (part + i) % tasks, tuple(bytes(v) for v in r)

    return rows.rdd.mapPartitionsWithIndex(run).partitionBy(tasks, int).values()


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def histograms(rows: DataFrame | RDD, trees: list[list[Tree]], growing: list[Tree], number: int, level: int,
               edges: list[list[float]], p: BoostParams, folds: bool,
               above: list[tuple[np.ndarray, np.ndarray]] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per model the gradient sums and row counts of the level's nodes: [node, drawn feature, bin].

    With the histograms of the level ``above``, only the smaller child of every split is added up from rows;
    its sibling is what the parent has left.
    """
    nodes = 1 << level
    layout, sizes = _layout([len(e) + 1 for e in edges])
    ends = np.cumsum([1 << d for d in sizes])
    shape = (len(growing), nodes, int(ends[-1]))
    wanted = []
    for t in growing:
        live = np.flatnonzero(t.level(level)[0]).tolist()
        if above is not None:
            # the children of a split are 2i and 2i + 1 of their level
            live = [i for i in live if (t.rows[nodes - 1 + i], i) < (t.rows[nodes - 1 + (i ^ 1)], i ^ 1)]
        wanted.append(live)

    def run(held: Iterator[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        g, n = np.zeros(shape), np.zeros(shape, np.int64)
        for b in (_Block(h, layout) for h in held):
            codes = b.codes.astype(np.intp)
            drawn = b.draws[number % KEEP] if p.subsample < 1 else np.full(b.draws.shape[1], 255, np.uint8)
            for k, tree in enumerate(growing):
                if not wanted[k]:
                    continue
                use = drawn & np.packbits(b.folds != k) if folds else drawn
                grad = b.moved(k, trees[k], p.depth)
                places = b.inside(tree, level)[0]
                for i in wanted[k]:
                    at = np.flatnonzero(b.bits(places[i] & use).view(bool))
                    weights = grad.take(at, mode="wrap")
                    for code, end, digits in zip(codes, ends, sizes, strict=True):
                        here, size = code.take(at, mode="wrap"), 1 << digits
                        g[k, i, end - size:end] += np.bincount(here, weights, size)
                        n[k, i, end - size:end] += np.bincount(here, minlength=size)
        yield by_bin(g), by_bin(n)

    cells = [len(e) + 1 for e in edges]
    first = np.cumsum(cells) - cells

    def by_bin(v: np.ndarray) -> np.ndarray:
        """Sums by code as sums by bin, the features side by side."""
        out = []
        for (code, shift, digits), c in zip(layout, cells, strict=True):
            one = v[:, :, ends[code] - (1 << sizes[code]):ends[code]]
            out.append(one.reshape(*v.shape[:2], -1, 1 << digits, 1 << shift).sum(axis=(2, 4))[:, :, :c])
        return np.concatenate(out, axis=2)

    parts = (_dealt(rows) if isinstance(rows, DataFrame) else rows).mapPartitions(run).collect()
    g, n = sum(v for v, _ in parts), sum(v for _, v in parts)
    out = []
    for k, tree in enumerate(growing):
        hg, hn = np.zeros((nodes, len(tree.drawn), p.bins)), np.zeros((nodes, len(tree.drawn), p.bins), np.int64)
        for i, f in enumerate(tree.drawn):
            at = slice(first[f], first[f] + cells[f])
            hg[:, i, :cells[f]], hn[:, i, :cells[f]] = g[k][:, at], n[k][:, at]
        if above is not None:
            for i in wanted[k]:
                hg[i ^ 1], hn[i ^ 1] = above[k][0][i >> 1] - hg[i], above[k][1][i >> 1] - hn[i]
        out.append((hg, hn))
    return out


def best_splits(g: np.ndarray, n: np.ndarray, p: BoostParams) -> list[tuple]:
    """Per node (gain, column, cut, (left g, left n), (right g, right n)); gain 0: no split."""
    gl, nl = g.cumsum(2)[:, :, :-1], n.cumsum(2)[:, :, :-1]
    gt, nt = g.sum(2)[:, :, None], n.sum(2)[:, :, None]
    gr, nr = gt - gl, nt - nl

    def worth(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return shrunk(a, p.l1) ** 2 / (b + p.l2)

    gain = worth(gl, nl) + worth(gr, nr) - worth(gt, nt)
    gain = np.where((nl >= p.min_child) & (nr >= p.min_child), gain, 0.0)
    out = []
    for i in range(len(g)):
        # sums differ in the last digits by their order: equal gains go to the first
        top = gain[i].max() if gain[i].size else 0.0
        if top <= 1e-9:
            out.append((0.0, -1, 0, None, None))
            continue
        j, c = np.unravel_index(int(np.flatnonzero(gain[i].ravel() >= top * (1 - 1e-9))[0]), gain[i].shape)
        out.append((float(gain[i, j, c]), int(j), int(c), (gl[i, j, c], nl[i, j, c]), (gr[i, j, c], nr[i, j, c])))
    return out


def _grow(tree: Tree, level: int, g: np.ndarray, n: np.ndarray, p: BoostParams) -> None:
    """The next level of ``tree`` from its nodes' histograms."""
    for i, (gain, j, cut, left, right) in enumerate(best_splits(g, n, p)):
        at = (1 << level) - 1 + i
        if level == 0:
            total, count = g[i].sum(1)[0], n[i].sum(1)[0]
            tree.value[at], tree.rows[at] = -p.learning_rate * float(shrunk(total, p.l1)) / (count + p.l2), count
        if j < 0:
            continue
        tree.feature[at], tree.cut[at], tree.gain[at] = tree.drawn[j], cut, gain
        for child, (cg, cn) in ((2 * at + 1, left), (2 * at + 2, right)):
            tree.value[child], tree.rows[child] = -p.learning_rate * float(shrunk(cg, p.l1)) / (cn + p.l2), cn


def _fit(df: DataFrame, key: str, label: str, features: list[str], p: BoostParams, bases: list[float | None],
         fold: Column | None) -> list[BoostedModel]:
    """One model per base, trained side by side; with ``fold``, model k on the rows of the other folds."""
    models = [BoostedModel(features, [[] for _ in features], None if b is None else float(b), [], p) for b in bases]
    live = [k for k, m in enumerate(models) if m.base is not None]
    if not live or not features:
        return models
    edges = bin_edges(df, features, p.bins)
    rows = _dealt(_stored(_blocks(df, key, label, features, edges, [m.base or 0.0 for m in models],
                                  F.lit(-1) if fold is None else fold, p))).persist(StorageLevel.MEMORY_AND_DISK)
    width, kept = len(features), 0
    rng = np.random.default_rng(p.seed)
    for number in range(p.trees):
        drawn = sorted(rng.permutation(width)[:max(1, int(np.ceil(p.colsample * width - 1e-9)))].tolist())
        growing, sums = [Tree.empty(p.depth, drawn) for _ in models], None
        for level in range(p.depth):
            if not any(t.level(level)[0].any() for t in growing):
                break
            sums = histograms(rows, [m.trees[kept:] for m in models], growing, number, level, edges, p, fold is not None, sums)
            for tree, (g, n) in zip(growing, sums, strict=True):
                _grow(tree, level, g, n, p)
        for k in live:
            models[k].trees.append(growing[k])
        if number + 1 - kept >= KEEP and number + 1 < p.trees:
            old, rows = rows, _moved(rows, [m.trees[kept:] for m in models], number + 1, edges, p).persist(StorageLevel.MEMORY_AND_DISK)
            rows.count()  # kept before the others go
            old.unpersist()
            kept = number + 1
    rows.unpersist()
    for k in live:
        models[k].edges = edges
    return models


def fit(df: DataFrame, key: str, label: str, features: list[str], p: BoostParams | None = None) -> BoostedModel:
    """The model of ``label`` on the numeric ``features``; ``key`` names a row (for the row draws)."""
    df = df.filter(F.col(label).isNotNull())
    return _fit(df, key, label, features, p or BoostParams(), [df.agg(F.avg(label)).first()[0]], None)[0]


def fit_folds(df: DataFrame, key: str, label: str, features: list[str], fold: str, folds: int,
              p: BoostParams | None = None) -> list[BoostedModel]:
    """Cross-validation: per fold the model of the rows outside it, all trained side by side."""
    df = df.filter(F.col(label).isNotNull())
    row = df.agg(*[F.avg(F.when(~F.col(fold).eqNullSafe(k), F.col(label))).alias(f"b{k}") for k in range(folds)]).first()
    return _fit(df, key, label, features, p or BoostParams(), list(row), F.coalesce(F.col(fold), F.lit(-1)))


def _moved(rows: RDD, trees: list[list[Tree]], number: int, edges: list[list[float]], p: BoostParams) -> RDD:
    """The blocks with their gradients after ``trees`` and the draws from tree ``number`` on."""
    layout = _layout([len(e) + 1 for e in edges])[0]

    def run(held: Iterator[tuple]) -> Iterator[tuple]:
        for h in held:
            b = _Block(h, layout)
            grads = np.stack([b.moved(k, t, p.depth) for k, t in enumerate(trees)])
            yield h[0], h[1], grads.tobytes(), _draws(b.keys, number, p), h[4]

    return rows.mapPartitions(run)


def root_gains(df: DataFrame, label: str, features: list[str], p: BoostParams | None = None) -> DataFrame:
    """(feature, n_right, gain): the first split's gain of every 0/1 feature, as one aggregation (for checks)."""
    p = p or BoostParams()
    base = df.agg(F.avg(label)).first()[0]
    g = F.lit(base) - F.col(label)
    one = df.agg(F.sum(g).alias("g"), F.count(F.lit(1)).alias("n"),
                 *[F.sum(F.when(F.col(f"`{c}`") > 0.5, g).otherwise(0.0)).alias(f"g{i}") for i, c in enumerate(features)],
                 *[F.count(F.when(F.col(f"`{c}`") > 0.5, 1)).alias(f"n{i}") for i, c in enumerate(features)])
    each = one.select("g", "n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"g{i}").alias("gr"), F.col(f"n{i}").alias("nr"))
        for i, c in enumerate(features)])).alias("f")).select("g", "n", "f.*")

    def worth(a: Column, b: Column) -> Column:
        t = F.greatest(F.abs(a) - p.l1, F.lit(0.0))
        return t * t / (b + p.l2)

    gain = worth(F.col("g") - F.col("gr"), F.col("n") - F.col("nr")) + worth(F.col("gr"), F.col("nr")) - worth(F.col("g"), F.col("n"))
    ok = (F.col("nr") >= p.min_child) & (F.col("n") - F.col("nr") >= p.min_child)
    return each.select("feature", F.col("nr").alias("n_right"), F.round(F.when(ok, gain).otherwise(0.0), 4).alias("gain"))


def save(spark: SparkSession, model: BoostedModel, path: str) -> None:
    """The trees and the layout as Parquet tables."""
    path = path.rstrip("/")
    model.tree_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
    rows = [(i, f, e, model.base) for i, (f, e) in enumerate(zip(model.features, model.edges, strict=True))]
    spark.createDataFrame(rows, "i int, feature string, edges array<double>, base double").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/layout")
    spark.createDataFrame([tuple(asdict(model.params).values())], list(asdict(model.params))).write.mode(
        "overwrite").parquet(f"{path}/params")


def load(spark: SparkSession, path: str) -> BoostedModel:
    path = path.rstrip("/")
    layout = spark.read.parquet(f"{path}/layout").orderBy("i").collect()
    p = BoostParams(**spark.read.parquet(f"{path}/params").first().asDict())
    features, edges = [r.feature for r in layout], [list(r.edges) for r in layout]
    trees: dict[int, Tree] = {}
    for r in spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect():
        t = trees.setdefault(r.tree, Tree.empty(p.depth, []))
        if r.feature is not None:
            f = features.index(r.feature)
            t.feature[r.node], t.cut[r.node] = f, edges[f].index(r.threshold)
        t.gain[r.node], t.rows[r.node], t.value[r.node] = r.gain, r.n_rows, r.value
    return BoostedModel(features, edges, layout[0].base if layout else None, [trees[i] for i in sorted(trees)], p)
