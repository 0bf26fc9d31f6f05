"""Scoring texts with a hidden Markov language model.

Words (lower-cased, with one end token a text) are counted over all training
texts. The ``TOP`` most frequent words are symbols of their own; every other
word is a member of a class named by its last letters, and its probability
inside the class is its smoothed count's share, so the model gives every word,
known or not, a positive probability (every unknown word gets that of a
count of 0, so unknown words' shares are not divided among them). A hidden Markov model with ``STATES``
states emits the symbols:

    p(text) = p(symbols) * product over class members of p(word | class)

Training is Baum-Welch: each round computes expected transition and emission
counts (forward-backward with scaling) over all training tokens and adds the
partitions' counts. Each text is cut by itself into stretches of ``STRETCH``
tokens; a stretch is read with ``CONTEXT`` tokens of its text before and behind it,
whose own counts belong to its neighbours, so every token and every transition
of a text counts once, none across texts, start counts come from text beginnings
only, and what a text adds does not depend on the batch or partition it lies in. The
first states come from expectation maximisation on the matrix of neighbouring symbol
classes, itself counted over all training tokens. Scoring is the exact scaled
forward recursion over the whole text.

The word list that tasks hold has a fixed bound (``TOP`` words); the counts of
all other words are joined to (text, word) pairs by a shuffle. A word is named
by a 64-bit hash.

Defined results: null text has only the end token; a null id counts as not
held out; repeated rows are scored alike, each with its own counts; an empty
table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import common as C

TOP = 32_768  # words with a symbol in the task's list
OWN = 2_048  # of these, symbols of their own in the model
CLASSES = 512  # classes of all other words
STATES = 8
ROUNDS = 3
STRETCH = 64
CONTEXT = 8
COARSE = 384
FOLDS, HELD = 7, 2
END = np.uint64(0x656E64)  # the end token's name
SYMBOLS = OWN + 1 + CLASSES  # own words, end, classes
END_SYMBOL = OWN
_LOG10 = np.log(10.0)


def held_out(ids: list) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % FOLDS == HELD for i in ids], bool)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its 64-bit name, its class (by the last three bytes) and its text."""
    data, ends = C.text_bytes(texts)
    data = C._LOWER[data]
    starts, lens, doc = C.word_spans(data, ends)
    h = C.run_hashes(data, starts, lens)
    stop = starts + lens
    tail = np.zeros(len(h), np.uint64)
    for k in (1, 2, 3):
        at = np.where(lens >= k, stop - k, 0)
        tail = tail * np.uint64(257) + np.where(lens >= k, data[at].astype(np.uint64) + np.uint64(1), np.uint64(0)) \
            if len(data) else tail
    cls = (C.mix64(tail) % np.uint64(CLASSES)).astype(np.int64)
    return h, cls, doc


def word_counts(docs: DataFrame) -> DataFrame:
    """(w, cls, n): every word of the training texts, end included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, "text", 8 << 20):
            train = ~held_out(b.column(0).to_pylist())
            h, cls, doc = tokens(b.column(1))
            use = train[doc]
            w, at, n = np.unique(h[use], return_index=True, return_counts=True)
            c = cls[use][at]
            ends = int(train.sum())
            if ends:
                w, c, n = np.append(w, END), np.append(c, 0), np.append(n, ends)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c.astype(np.int32)), pa.array(n)],
                                             names=["w", "cls", "n"])

    return (docs.mapInArrow(run, "w long, cls int, n long")
            .groupBy("w").agg(F.min("cls").alias("cls"), F.sum("n").alias("n")))


class Model:
    """What tasks need: the bounded word list, class totals and the hidden Markov model."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, vocab: int,
                 class_words: np.ndarray, class_types: np.ndarray) -> None:
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        # rank by frequency -> symbol; the end has its own; words beyond OWN are class members
        symbol = np.full(len(words), -1, np.int64)
        own = np.flatnonzero(words != END)[:OWN]
        symbol[own] = np.arange(len(own))
        symbol[words == END] = END_SYMBOL
        self.symbol = symbol[order]
        self.total, self.vocab = total, vocab
        self.class_log = np.log(class_words + class_types + 1.0)
        self.start = self.move = self.emit = None

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.words):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return at, self.words[at] == h

    def symbols(self, h: np.ndarray, cls: np.ndarray) -> np.ndarray:
        at, known = self.find(h)
        s = OWN + 1 + cls
        if len(self.words):
            mine = known & (self.symbol[at] >= 0)
            s[mine] = self.symbol[at[mine]]
        return s


def fit_words(counts: DataFrame) -> Model:
    """The model's word part. To the driver: at most TOP words, the end token and CLASSES + 1 totals."""
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    end = F.col("w") == int(END)
    top = C.most_frequent(counts, TOP).filter(~end).collect() + counts.filter(end).collect()  # the end is always known
    top.sort(key=lambda r: (-r.n, r.w))
    words = np.array([r.w for r in top], np.int64).view(np.uint64)
    n = np.array([r.n for r in top], np.float64)
    model = Model(words, n, int(totals.n or 0), int(totals.v), np.zeros(CLASSES), np.zeros(CLASSES))
    rows = counts.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    cw, ct = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rows:
        cw[r.cls], ct[r.cls] = r.n, r.v
    # words with a symbol of their own leave their class
    by_name = {r.w: (r.cls, r.n) for r in top}
    for w, s in zip(model.words.view(np.int64).tolist(), model.symbol.tolist(), strict=True):
        if s >= 0:
            c, k = by_name[w]
            cw[c] -= k
            ct[c] -= 1
    model.class_log = np.log(cw + ct + 1.0)
    return model


def coded(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, row_key, held_out, n_tokens, top_log, top_known, class_log, tail_log, symbols) of every text.

    ``top_log`` is the sum of ln(count + 1) over the words in the list, ``top_known``
    their number; ``class_log`` the class totals' part of the class members;
    ``tail_log`` the list's class members' part of ln(count + 1).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "row_key", "held_out", "n_tokens", "top_log", "top_known", "class_log", "tail_log", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, "text", 4 << 20):
            n = b.num_rows
            h, cls, doc = tokens(b.column(1))
            # every text's end token behind its words
            sizes = C.per_text(doc, n)
            at, known = model.find(h)
            log = np.zeros(len(h))
            if len(model.words):
                log[known] = np.log(model.counts[at[known]] + 1)
            sym = model.symbols(h, cls)
            member = sym > OWN
            end_at, end_known = model.find(np.array([END]))
            end_log = float(np.log(model.counts[end_at[0]] + 1)) if end_known[0] else 0.0
            out = np.full(len(h) + n, END_SYMBOL, np.uint16)
            out[np.arange(len(h)) + doc] = sym
            ends = np.cumsum(sizes + 1)
            flat = out.tobytes()
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(2), pa.array(held_out(b.column(0).to_pylist())), pa.array(sizes + 1),
                pa.array(np.bincount(doc, log, n).astype(np.float64) + end_log),
                pa.array(np.bincount(doc, known, n).astype(np.int64) + int(end_known[0])),
                # without a member NumPy counts in integers
                pa.array(np.bincount(doc[member], model.class_log[cls[member]], n).astype(np.float64)),
                pa.array(np.bincount(doc[member], log[member], n).astype(np.float64)),
                pa.array([flat[2 * (e - s):2 * e] for s, e in zip((sizes + 1).tolist(), ends.tolist(), strict=True)],
                         pa.binary())], names=names)

    return docs.mapInArrow(run, f"doc_id {kind}, row_key long, held_out boolean, n_tokens long, top_log double, "
                                "top_known long, class_log double, tail_log double, symbols binary")


def rest_words(docs: DataFrame, model: Model) -> DataFrame:
    """(row_key, w, n): the words of each text that are not in the task's list, and its row with w null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, "text", 8 << 20):
            h, _, doc = tokens(b.column(1))
            _, known = model.find(h)
            key = b.column(2).to_numpy()
            h, doc = h[~known], doc[~known]
            pair = np.stack([doc.astype(np.uint64), h], axis=1)
            order = np.lexsort((h, doc))
            pair = pair[order]
            new = np.ones(len(pair), bool)
            new[1:] = (pair[1:] != pair[:-1]).any(axis=1)
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(pair)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[pair[at, 0].astype(np.int64)]), pa.array(pair[at, 1].view(np.int64)), pa.array(n.astype(np.int32))],
                names=["row_key", "w", "n"])

    return docs.mapInArrow(run, "row_key long, w long, n int")


# -- the hidden Markov model ---------------------------------------------------

def stretches(symbols: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every text cut into rows: its stretches with their context.

    Returns the rows (padded), which places hold a token of the text, which of them are the
    stretch's own, and which rows begin a text.
    """
    sizes = np.array([len(s) // 2 for s in symbols], np.int64)
    flat = np.frombuffer(b"".join(symbols), np.uint16).astype(np.int64)
    parts = -(-sizes // STRETCH)
    text = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = (np.cumsum(sizes) - sizes)[text]
    first = nth == 0
    # a text's first stretch has nothing before it: its row begins with its own tokens
    lead = np.where(first, 0, CONTEXT)
    place = nth[:, None] * STRETCH - lead[:, None] + np.arange(STRETCH + 2 * CONTEXT)[None]
    mask = place < sizes[text][:, None]
    core = mask & (place >= nth[:, None] * STRETCH) & (place < (nth[:, None] + 1) * STRETCH)
    mask &= place < (nth[:, None] + 1) * STRETCH + CONTEXT
    x = np.full(place.shape, END_SYMBOL, np.int64)
    x[mask] = flat[(begin[:, None] + place)[mask]]
    return x, mask, core, first


def settled(move: np.ndarray) -> np.ndarray:
    """The states' shares that ``move`` keeps: where a stretch inside a text begins."""
    p = np.full(len(move), 1 / len(move))
    for _ in range(64):
        p = p @ move
    return p / p.sum()


def expected(x: np.ndarray, mask: np.ndarray, core: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray,
             emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected start, transition and emission counts of the rows' own places (scaled forward-backward)."""
    n, width = x.shape
    k = len(start)
    b = emit.T  # symbol -> states
    alpha = np.empty((width, n, k))
    scale = np.empty((width, n, 1))
    a = np.where(first[:, None], start[None], settled(move)[None]) * b[x[:, 0]]
    for t in range(width):
        if t:
            a = (alpha[t - 1] @ move) * b[x[:, t]]
        scale[t] = a.sum(1, keepdims=True)
        alpha[t] = a / scale[t]
    moved = np.zeros((k, k))
    emitted = np.zeros((emit.shape[1], k))
    beta = np.ones((n, k))
    for t in range(width - 1, -1, -1):
        on, own = mask[:, t], core[:, t]
        if own.any():
            g = alpha[t][own] * beta[own]
            g /= g.sum(1, keepdims=True)
            for s in range(k):
                emitted[:, s] += np.bincount(x[own, t], g[:, s], emit.shape[1])
        if t:
            ahead = b[x[:, t]] * beta / scale[t]
            # the step into an own token is the row's
            moved += (alpha[t - 1][own].T @ ahead[own]) * move
            # a padded place tells nothing
            beta = np.where(on[:, None], ahead @ move.T, 1.0)
    begin = alpha[0][first] * beta[first]
    return (begin / begin.sum(1, keepdims=True)).sum(0), moved, emitted.T


def neighbours(texts: DataFrame, coarse_of: np.ndarray) -> np.ndarray:
    """Counts of neighbouring coarse symbols over all training tokens (COARSE^2 cells at most)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COARSE * COARSE, np.int64)
        for b in batches:
            flat = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint16)
            c = coarse_of[flat].astype(np.int64)
            if len(c) > 1:
                inside = flat[:-1] != END_SYMBOL  # a text's last token has no neighbour
                total += np.bincount((c[:-1] * COARSE + c[1:])[inside], minlength=COARSE * COARSE)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    out = np.zeros(COARSE * COARSE)
    for r in texts.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out.reshape(COARSE, COARSE)


def first_states(pairs: np.ndarray, states: int, seed: int = 3, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation maximisation of start, move and coarse emission on neighbour counts."""
    rng = np.random.default_rng(seed)
    base = pairs.sum(1) + pairs.sum(0) + 1e-3
    emit = (base / base.sum())[None] * rng.uniform(0.3, 1.7, (states, len(base)))
    emit /= emit.sum(1, keepdims=True)
    # states last: a state is more likely followed by itself
    move = np.full((states, states), 0.5 / states) + 0.5 * np.eye(states)
    start = np.full(states, 1 / states)
    for _ in range(rounds):
        left, right = start[:, None] * emit, emit
        p = left.T @ move @ right + 1e-300
        r = pairs / p
        joint = (left @ r @ right.T) * move
        e = left * (move @ (right @ r.T)) + right * (move.T @ (left @ r))
        start = joint.sum(1) + 1e-9
        start /= start.sum()
        move = joint + 1e-6 * joint.sum() + 1e-12
        move /= move.sum(1, keepdims=True)
        emit = e + (1e-6 * e.sum() + 1e-12) * base[None] / base.sum()
        emit /= emit.sum(1, keepdims=True)
    return start, move, emit


def baum_welch(texts: DataFrame, unigram: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> tuple:
    """start, move and emit, trained on (symbols) of all training texts."""
    coarse_of = np.full(SYMBOLS, 0, np.int64)
    order = np.argsort(-unigram, kind="stable")
    coarse_of[order] = np.minimum(np.arange(SYMBOLS), COARSE - 1 - (np.arange(SYMBOLS) % 32))
    pairs = neighbours(texts, coarse_of)
    start, move, coarse = first_states(pairs, states)
    prior = (unigram + 1) / (unigram + 1).sum()
    # a coarse class's emission is shared out by the symbols' counts
    mass = np.bincount(coarse_of, prior, COARSE)
    emit = coarse[:, coarse_of] * (prior / mass[coarse_of])[None]

    for _ in range(rounds):
        model = (start, (move + 1e-6) / (move + 1e-6).sum(1, keepdims=True), emit)

        def run(batches: Iterator[pa.RecordBatch], model: tuple = model) -> Iterator[pa.RecordBatch]:
            s, m, e = np.zeros(states), np.zeros((states, states)), np.zeros((states, SYMBOLS))
            for b in batches:
                rows = stretches(b.column(0).to_pylist())
                for at in range(0, len(rows[0]), 2048):
                    ds, dm, de = expected(*(r[at:at + 2048] for r in rows), *model)
                    s, m, e = s + ds, m + dm, e + de
            flat = np.concatenate([s, m.ravel(), e.ravel()])
            used = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], names=["cell", "n"])

        # at most states * (1 + states + SYMBOLS) rows a partition, and as many sums
        flat = np.zeros(states * (1 + states + SYMBOLS))
        for r in texts.mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            flat[r.cell] = r.n
        start = flat[:states] + 1e-3
        move = flat[states:states + states ** 2].reshape(states, states) + 1e-3
        emit = flat[states + states ** 2:].reshape(states, SYMBOLS)
        emit = emit + 20 * prior[None]
        start, move, emit = (start / start.sum(), move / move.sum(1, keepdims=True),
                             emit / emit.sum(1, keepdims=True))
    return start, move, emit


def forward(symbols: list[bytes], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Exact ln p(symbols) of every text: scaled forward recursion, texts of like length side by side."""
    sizes = np.array([len(s) // 2 for s in symbols], np.int64)
    out = np.zeros(len(symbols))
    order = np.argsort(-sizes, kind="stable")
    flat = np.frombuffer(b"".join(symbols), np.uint16).astype(np.int64)
    begin = (np.cumsum(sizes) - sizes)[order]
    size = sizes[order]
    b = emit.T
    live = int((size > 0).sum())
    a = np.repeat(start[None], live, 0)
    log = np.zeros(len(symbols))
    t = 0
    while live:
        a = a[:live] if t == 0 else a[:live] @ move
        a = a * b[flat[begin[:live] + t]]
        total = a.sum(1)
        log[:live] += np.log(total)
        a /= total[:, None]
        t += 1
        live = int(np.searchsorted(-size[:live], -t, "left"))
    out[order] = log
    return out


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text."""
    src = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    counts = C.stored(word_counts(src.select("doc_id", "text")), "hmm-words")
    model = fit_words(counts)
    texts = C.stored(coded(src, model), "hmm-texts")
    uni = np.zeros(SYMBOLS)

    def symbol_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint16), minlength=SYMBOLS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SYMBOLS)), pa.array(total)], names=["s", "n"])

    train = texts.filter("not held_out").select("symbols")
    for r in train.mapInArrow(symbol_counts, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).collect():
        uni[r.s] = r.n
    model.start, model.move, model.emit = baum_welch(train, uni)

    # counts of the words beyond the list, joined by word; what each text's row adds up to
    rest = rest_words(src, model)
    add = (rest.join(counts.select("w", F.col("n").alias("c")), "w")
           .groupBy("row_key").agg(F.sum(F.col("n") * F.log(F.col("c") + 1)).alias("rest_log"),
                                   F.sum("n").alias("rest_known")))
    # equal rows were added up together
    twins = src.groupBy("row_key").agg(F.count("*").alias("m")).filter("m > 1")
    add = add.join(twins.withColumnRenamed("row_key", "tk"), F.col("row_key") == F.col("tk"), "left").select(
        F.col("row_key").alias("ak"), *[(F.col(c) / F.coalesce("m", F.lit(1))).alias(c) for c in ("rest_log", "rest_known")])

    hmm = (model.start, model.move, model.emit)
    names = ["doc_id", "held_out", "row_key", "n_tokens", "top_log", "top_known", "class_log", "tail_log", "hmm_log"]
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            log = forward(b.column("symbols").to_pylist(), *hmm)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names[:-1]] + [pa.array(log)], names=names)

    scored = texts.select(*names[:-1], "symbols").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, row_key long, n_tokens long, top_log double, top_known long, "
             "class_log double, tail_log double, hmm_log double")
    n, v = model.total, model.vocab
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    return scored.join(add, F.col("row_key") == F.col("ak"), "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("top_known") + F.coalesce(F.col("rest_known"), F.lit(0)).cast("long")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        ((F.col("top_log") + rest_log - F.col("n_tokens") * F.lit(float(np.log(n + v + 1)))) / _LOG10).alias("base_score"),
        ((F.col("hmm_log") + F.col("tail_log") + rest_log - F.col("class_log")) / _LOG10).alias("score"))


def op7_hmm_scoring(spark: SparkSession, base: str) -> DataFrame:
    """All documents, scored by the model trained on those not held out."""
    return score(C.read(spark, base, "documents"))
