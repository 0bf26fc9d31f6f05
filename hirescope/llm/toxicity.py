"""Toxicity by multiple-instance learning: documents carry labels, sentences are judged.

A sentence is toxic with probability s(bias + sum of the weights of its
features), a document if any of its sentences is (noisy-or):

    p(document) = 1 - product over its sentences of (1 - p(sentence))

Only document labels are known; the weights maximise their likelihood, which pulls
up just those sentences whose features tell toxic documents from others, and these
are then located (:func:`offending`).

A sentence ends at ``. ! ?`` before white space or the text's end, or at a line's
end; it counts if it holds a word (letters and digits, lower-cased). Features are
whole words and their leading ``PREFIXES`` bytes (stems), each named by a 64-bit
hash, present or absent in a sentence. The vocabulary are the features found in
toxic documents more often than chance (likelihood ratio over documents, with a
bound that rises with the number of features tested so that about one passes by
accident), at most ``VOCABULARY``.

The classifier is fitted on a bounded sample: at most about ``SAMPLE`` labelled ids
of each class, drawn by hash and weighted back; equal texts share one weight. Its
counts, likelihood and gradient are sums over partitions of that sample; the driver
holds the weights only. Every document is scored, whole.

Defined results: null or empty text has no sentence and scores 0; null ids are not
held out; an id labelled twice counts as toxic if any of its rows is; null labels
are none; repeated documents are scored alike; without an informative feature
(no labels, one class) every document scores the smoothed share of toxic labels;
an empty table gives an empty result; lang, source and extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import common as C

FOLDS, HELD = 5, 0
SAMPLE = 20_000  # labelled ids of each class that the classifier is fitted on
VOCABULARY = 16_384
PREFIXES = (4, 5, 6)
MIN_TOXIC = 3  # toxic documents that must hold a feature
ROUNDS = 25
PULL = 0.5  # of the weights towards 0
BIAS = -6.0  # where the bias is pulled to

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x80:] = np.arange(0x80, 256)
for _a, _b in (("a", "z"), ("0", "9")):
    _LETTER[ord(_a):ord(_b) + 1] = np.arange(ord(_a), ord(_b) + 1)
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True
_WHOLE = np.uint64(0x5DEECE66D)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def parse(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per sentence of all texts: its text's index and its first byte (last: the total);
    per (word, feature): its sentence and the feature's hash; and the bytes of all texts."""
    data, ends = C.text_bytes(pc.utf8_lower(texts))
    starts, lens, doc = C.word_spans(_LETTER[data], ends)
    # sentence breaks: behind . ! ? before white space, behind a newline, and where a text begins
    blank = np.ones(len(data) + 1, bool)
    blank[:-1] = C._SPACE[data]
    blank[ends[1:-1]] = True  # the next text's first byte
    breaks = np.flatnonzero((_STOP[data] & blank[1:]) | (data == 10)) + 1
    cut = np.unique(np.concatenate([ends[:-1], breaks]))
    at = np.searchsorted(cut, starts, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    sentence = np.cumsum(new) - 1
    first = cut[at[new]]
    hashes = [C.run_hashes(_LETTER[data], starts, lens) ^ _WHOLE]
    where = [sentence]
    run = np.zeros(len(starts), np.uint64)
    powers = C._powers(max(PREFIXES))
    alive = np.arange(len(starts))
    for j in range(max(PREFIXES)):
        alive = alive[lens[alive] > j]
        run[alive] += C._BYTE_CODE[data[starts[alive] + j]] * powers[j]
        if j + 1 in PREFIXES:
            hashes.append(C.mix64(run[alive] ^ np.uint64(j + 1)))
            where.append(sentence[alive])
    return doc[new], np.append(first, len(data)), np.concatenate(where), np.concatenate(hashes), data


def pairs(group: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (group, item) pairs."""
    order = np.lexsort((item, group))
    g, i = group[order], item[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (i[1:] != i[:-1])
    return g[new], i[new]


# -- the sample and its features -----------------------------------------------

def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> tuple[DataFrame, float, float]:
    """(text, toxic, weight) of the labelled training sample; all toxic and all labelled training ids."""
    known = C.stored(labels.filter("toxic is not null and doc_id is not null")
                     .groupBy(F.col("doc_id").alias("label_id")).agg(F.max(F.least("toxic", F.lit(1))).alias("toxic"))
                     .filter(~held_out(F.col("label_id"))), "toxicity-labels")
    n = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {y: min(1.0, rows / max(n.get(y, 0), 1)) for y in (0, 1)}
    draw = F.pmod(F.xxhash64("label_id", F.lit(17)), F.lit(1 << 40)) / float(1 << 40)
    # at most about 2 * rows ids: a bounded broadcast
    ids = known.filter(((F.col("toxic") == 1) & (draw < share[1])) | ((F.col("toxic") == 0) & (draw < share[0])))
    text = F.coalesce("text", F.lit(""))
    got = C.stored(docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
                   .join(F.broadcast(ids), F.col("doc_id") == F.col("label_id")).select("text", "h", "toxic"), "toxicity-sample")
    twins = C.stored(got.groupBy(F.col("h").alias("twin"), F.col("toxic").alias("t")).agg(F.count("*").alias("m"))
                     .filter("m > 1"), "toxicity-twins")
    back = F.when(F.col("toxic") == 1, 1 / share[1]).otherwise(1 / share[0])
    got = got.join(C.small_side(twins), (F.col("h") == F.col("twin")) & (F.col("toxic") == F.col("t")), "left").select(
        "text", F.col("toxic").cast("double").alias("toxic"), (back / F.coalesce("m", F.lit(1))).alias("weight"))
    return got, float(n.get(1, 0)), float(sum(n.values()))


def feature_counts(rows: DataFrame) -> DataFrame:
    """(f, n, k): the weight of all, and of toxic, sample texts that hold each feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, "text", 2 << 20):
            doc, _, where, h, _ = parse(b.column(0))
            y, w = b.column(1).to_numpy(), b.column(2).to_numpy()
            d, h = pairs(doc[where], h)
            f, at = np.unique(h, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(f.view(np.int64)), pa.array(np.bincount(at, w[d], len(f)).astype(np.float64)),
                pa.array(np.bincount(at, (w * y)[d], len(f)).astype(np.float64)),
                pa.array(np.bincount(at[y[d] > 0], minlength=len(f)))], names=["f", "n", "k", "seen"])

    return (rows.mapInArrow(run, "f long, n double, k double, seen long").groupBy("f")
            .agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("seen").alias("seen")))


def likelihood_ratio(n: Column, k: Column, total: float, toxic: float) -> Column:
    """G2 of a feature's documents against the classes."""
    def part(seen: Column, rows: Column, share: float) -> Column:
        return F.when(seen > 1e-9, seen * F.log(seen / (rows * share))).otherwise(0.0)

    rest = F.lit(total) - n
    p = toxic / total
    return 2 * (part(k, n, p) + part(n - k, n, 1 - p) + part(F.lit(toxic) - k, rest, p)
                + part(rest - F.lit(toxic) + k, rest, 1 - p))


# -- the model -----------------------------------------------------------------

@dataclass
class Model:
    """Sorted feature hashes with their weights, the bias, and the share of toxic labels."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    share: float

    def __post_init__(self) -> None:
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.features >> np.uint64(48)] = True

    def found(self, sentence: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct (sentence, feature number) pairs."""
        if not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hit = self.maybe[h >> np.uint64(48)]
        sentence, h = sentence[hit], h[hit]
        at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
        known = self.features[at] == h
        return pairs(sentence[known], at[known])

    def log_odds(self, n: int, sentence: np.ndarray, feature: np.ndarray) -> np.ndarray:
        return self.bias + np.bincount(sentence, self.weights[feature], n)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def likelihood(x: np.ndarray, y: np.ndarray, w: np.ndarray, plain: np.ndarray, doc: np.ndarray,
               sentence: np.ndarray, feature: np.ndarray) -> tuple[float, np.ndarray]:
    """Minus the noisy-or log likelihood of documents, and its gradient; ``x`` is (bias, weights).

    ``plain``: a document's sentences without a feature; ``doc``: the document of each
    other sentence; (sentence, feature): what these hold.
    """
    z = x[0] + np.bincount(sentence, x[1 + feature], len(doc))
    none = -(plain * softplus(x[0]) + np.bincount(doc, softplus(z), len(y)))  # ln p(no sentence is toxic)
    some = np.maximum(-np.expm1(none), 1e-12)
    # d(loss) / d(none)
    slope = np.where(y > 0, w * np.exp(none) / some, -w)
    loss = float(-(w * np.where(y > 0, np.log(some), none)).sum())
    dz = -slope[doc] / (1 + np.exp(-z))
    grad = np.zeros(len(x))
    grad[1:] = np.bincount(feature, dz[sentence], len(x) - 1)
    grad[0] = dz.sum() - (slope * plain).sum() / (1 + np.exp(-x[0]))
    return loss, grad


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int, keep: int = 8) -> np.ndarray:
    """Quasi-Newton descent with limited memory; each round costs one evaluation, or a few where steps are halved."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        d, stack = -grad, []
        for s, y in reversed(past):
            a = (s @ d) / (s @ y)
            d = d - a * y
            stack.append((a, s, y))
        if past:
            s, y = past[-1]
            d = d * (s @ y) / (y @ y)
        else:
            d = d / max(1.0, float(np.abs(d).max()))
        for a, s, y in reversed(stack):
            d = d + (a - (y @ d) / (s @ y)) * s
        step = 1.0
        while step > 1e-4:
            new, new_grad = f(x + step * d)
            if new <= value + 1e-4 * step * (grad @ d):
                break
            step /= 4
        else:
            return x
        s, y = step * d, new_grad - grad
        if s @ y > 1e-10:
            past = [*past, (s, y)][-keep:]
        done = value - new < 1e-5 * max(1.0, abs(new))
        x, value, grad = x + s, new, new_grad
        if done:
            break
    return x


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> Model:
    """The model from (doc_id, text) and (doc_id, toxic), of the ids that are not held out."""
    got, toxic, total = sample(docs, labels, rows)
    got = C.stored(got, "toxicity-weighted")
    model = Model(np.zeros(0, np.uint64), np.zeros(0), BIAS, toxic / (total + 1))
    held = got.agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("toxic")).alias("k")).first()
    if not held.k or held.n - held.k < 1e-9:
        return model
    counts = C.stored(feature_counts(got), "toxicity-features")
    tested = counts.count()
    g2 = likelihood_ratio(F.col("n"), F.col("k"), held.n, held.k)
    told = (counts.filter((F.col("seen") >= MIN_TOXIC) & (F.col("k") / F.col("n") > held.k / held.n))
            .withColumn("g2", g2).filter(F.col("g2") > 2 * np.log(max(tested, 2)) - 4)
            .orderBy(F.desc("g2"), "f").limit(vocabulary).select("f").collect())
    if not told:
        return model
    model = Model(np.sort(np.array([r.f for r in told], np.int64).view(np.uint64)), np.full(len(told), 1.0), BIAS, model.share)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, "text"):
            n = b.num_rows
            doc, _, where, h, _ = parse(b.column(0))
            s, f = model.found(where, h)
            held, number = np.unique(s, return_inverse=True)
            of = doc[held]  # the text of each sentence that holds a feature
            plain = np.bincount(doc, minlength=n) - np.bincount(of, minlength=n)
            first = np.searchsorted(of, np.arange(n + 1))
            cut = np.searchsorted(number, first)
            local = number - first[of[number]] if len(number) else number
            yield pa.RecordBatch.from_arrays([
                b.column(1), b.column(2), pa.array(plain.astype(np.int64)), pa.array(np.diff(first).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(local.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(f.astype(np.int32)))],
                names=["toxic", "weight", "plain", "held", "sentence", "feature"])

    rows_ = C.stored(got.mapInArrow(coded, "toxic double, weight double, plain long, held long, "
                                           "sentence array<int>, feature array<int>"), "toxicity-coded")

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, grad = 0.0, np.zeros(len(x))
            for b in batches:
                held = b.column(3).to_numpy()
                doc = np.repeat(np.arange(b.num_rows), held)
                base = np.cumsum(held) - held
                s, f = b.column(4), b.column(5)
                of = np.repeat(np.arange(b.num_rows), pc.list_value_length(s).to_numpy())
                more, slope = likelihood(x, b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), doc,
                                         base[of] + s.flatten().to_numpy(), f.flatten().to_numpy().astype(np.int64))
                loss, grad = loss + more, grad + slope
            out = np.append(grad, loss)
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], names=["cell", "v"])

        flat = np.zeros(len(x) + 1)
        for r in rows_.mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
            flat[r.cell] = r.v
        pull = x - np.append(BIAS, np.zeros(len(x) - 1))
        return flat[-1] + PULL / 2 * float(pull @ pull), flat[:-1] + PULL * pull

    x = minimise(evaluate, np.append(model.bias, model.weights), rounds)
    return Model(model.features, x[1:], float(x[0]), model.share)


# -- use -----------------------------------------------------------------------

def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_sentences and the worst sentence (number from 1, probability) of every document."""
    names = ["doc_id", "score", "n_sentences", "worst_sentence", "worst_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, "text"):
            n = b.num_rows
            doc, _, where, h, _ = parse(b.column(1))
            s, f = model.found(where, h)
            z = model.log_odds(len(doc), s, f)
            p = 1 / (1 + np.exp(-z))
            total = -np.expm1(-np.bincount(doc, softplus(z), n).astype(np.float64))
            if not len(model.features):
                total = np.full(n, model.share)
            count = np.bincount(doc, minlength=n).astype(np.int64)
            begin = np.cumsum(count) - count
            # the first sentence of the largest probability
            order = np.lexsort((np.arange(len(p)), -p, doc))
            has = count > 0
            worst = np.zeros(n, np.int64)
            worst[has] = order[begin[has]]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(total), pa.array(count), pa.array(worst - begin + 1, mask=~has),
                pa.array(p[worst] if len(p) else np.zeros(n), mask=~has)], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, n_sentences long, worst_sentence long, worst_score double")


def offending(docs: DataFrame, model: Model, at_least: float = 0.5) -> DataFrame:
    """doc_id, sentence (number from 1), score and text of every sentence whose probability is at least ``at_least``."""
    names = ["doc_id", "sentence", "score", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, "text"):
            doc, first, where, h, _ = parse(b.column(1))
            # lower-casing may change a text's length in bytes: cut the text as parsed where it did
            data, ends = C.text_bytes(b.column(1))
            low, low_ends = C.text_bytes(pc.utf8_lower(b.column(1)))
            s, f = model.found(where, h)
            p = 1 / (1 + np.exp(-model.log_odds(len(doc), s, f)))
            count = np.bincount(doc, minlength=b.num_rows)
            number = np.arange(len(doc)) - (np.cumsum(count) - count)[doc] + 1
            hit = np.flatnonzero(p >= at_least)
            texts = []
            for i in hit.tolist():
                d = doc[i]
                same = ends[d + 1] - ends[d] == low_ends[d + 1] - low_ends[d]
                src, off = (data, ends[d] - low_ends[d]) if same else (low, 0)
                stop = min(first[i + 1], low_ends[d + 1])
                texts.append(bytes(src[first[i] + off:stop + off]).decode("utf-8", "replace").strip())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc[hit])), pa.array(number[hit]), pa.array(p[hit]),
                                              pa.array(texts, pa.string())], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, sentence long, score double, text string")


def op12_toxicity(spark: SparkSession, base: str) -> DataFrame:
    """All documents, scored by the model trained on the labelled ones that are not held out."""
    docs = C.read(spark, base, "documents").select("doc_id", "text")
    model = train(docs, C.read(spark, base, "labels").select("doc_id", "toxic"))
    got = score(docs, model)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "worst_sentence", "worst_score")
