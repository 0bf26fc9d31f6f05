"""URL filters: allow/block rules, then a naive Bayes judgement of host and path tokens.

Host labels are often several words written together. A unigram model,
counted over the words of all pages' texts (letters of any script, without tags,
scripts, styles and character references), lets a Viterbi search split a label into
its likeliest words ("cheappills" -> cheap, pills). A split counts if it is clean: every word
of it is known, and no short seed stands beside a short other word ("es sex win"); else the
label stays whole. The segmented host and path tokens feed a multinomial naive
Bayes model with two classes. It learns from every page of the input: a page is a
block example if two different seeds (a short list of spam words) occur among
its host and path words, or if a whole label of its host is a seed of more than
``SHORT`` letters; an allow example otherwise: one such word among others is no evidence. What it adds to the seeds
are the words, hosts and paths seen together with them. Both classes are smoothed
towards the tokens' shares in all pages, so a token that tells nothing, or a
class with few examples, moves no verdict; without a block example nothing is
blocked but by rule. The rules decide their own pages and teach nothing: a
rule for one path says nothing about that path elsewhere. Tokens are hashed to 2^18
buckets, so the model has a fixed size however many hosts there are. All words of all
pages are counted; the tasks hold those of up to ``SHORT`` letters, and the parts of
the distinct labels are joined to the counts of the longer ones, so every label is
split once, among all words that it may hold.

A host with many pages is dealt in pieces of ``SPLIT`` pages where it fetches its words.

Defined results: a null url, or one without ``://``, has an empty host and path
and no rule, and gets the class prior; a run of more than ``MAX_LABEL`` letters is no
host name's and stays whole; repeated rows are judged alike; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import html as H
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import common as C

#: (verdict, rule): the rule's host covers its subdomains, its path is a prefix; the longest wins
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
SEEDS = frozenset("""adult bet bets bonus casino cheap cialis escort farm gamble gambling jackpot loan loans nude
    payday pharma pill pills poker porn replica sex slots spam torrent viagra warez win xxx""".split())
SHORT = 3  # words of so many letters are held by every task (18,278 at most)
BUCKETS = 1 << 18
MAX_WORD = 24
MAX_LABEL = 63
SPLIT = 1_000  # pages of one host that meet in a task
BACKGROUND = 50.0  # tokens' worth of the shares in all pages, added to each class
WORDS = re.compile(r"[^\W\d_]+")
TAGS = re.compile(r"<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*(?:>|\Z)", re.S | re.I)
LETTERS = re.compile(r"[a-z]+|[0-9]+")
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_ASCII_LOWER), slash + path


def rule_of(host: str, path: str, rules: tuple = RULES) -> tuple[str | None, str | None]:
    """The longest rule that fits, and its verdict."""
    best = (None, None)
    for verdict, rule in rules:
        rule_host, slash, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path) \
                and (best[0] is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


class Segmenter:
    """Unigram Viterbi: the likeliest split of a run of letters into words."""

    def __init__(self, counts: dict[str, int], total: int | None = None) -> None:
        """``total`` of all words' counts and number; of ``counts`` if not given."""
        self.total = total = (sum(counts.values()) + len(counts) if total is None else total) + 1
        self.logp = {w: math.log((c + 1) / total) for w, c in counts.items()}
        self.unknown = math.log(1 / total)
        self.split = lru_cache(200_000)(self._split)

    def _split(self, s: str, more: dict[str, int] | None = None) -> tuple[str, ...]:
        """The words of ``s``; ``more`` are counts beside the model's own."""
        extra = {w: math.log((c + 1) / self.total) for w, c in (more or {}).items()}
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(s) + 1):
            top = (-math.inf, 0)
            for start in range(max(0, end - MAX_WORD), end):
                word = s[start:end]
                p = self.logp.get(word, extra.get(word))
                if p is None:  # an unknown word costs more the longer it is
                    p = self.unknown - 2.3 * len(word)
                cand = (best[start][0] + p, start)
                if cand[0] > top[0]:
                    top = cand
            best.append(top)
        out, end = [], len(s)
        while end:
            out.append(s[best[end][1]:end])
            end = best[end][1]
        return tuple(reversed(out))


def runs_of(host: str) -> list[str]:
    """The runs of letters and of digits of a host's labels."""
    return [run for label in host.split(".") for run in LETTERS.findall(label)]


def path_tokens(path: str) -> list[str]:
    return [f"p:{w}" if w[0].isalpha() else "p:#" for w in LETTERS.findall(path.translate(_ASCII_LOWER))]


def bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % BUCKETS


def unigrams(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n) of all words of all pages' texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, html, 8 << 20):
            seen: Counter = Counter()
            for page in b.column(0).to_pylist():
                if page:
                    seen.update(WORDS.findall(H.unescape(TAGS.sub(" ", page)).lower()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    return C.stored(pages.select(html).mapInArrow(count, "word string, n long")
                    .groupBy("word").agg(F.sum("n").alias("n")), "url-words")


def held_words(counts: DataFrame) -> tuple[dict[str, int], int]:
    """The words that every task holds, the short ones and the seeds, and the total of all words."""
    r = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    few = (F.length("word") <= SHORT) | F.col("word").isin(*sorted(SEEDS))
    held = {x.word: x.n for x in counts.filter(few).collect()}
    total = (r.n or 0) + r.v
    for w in sorted(SEEDS - held.keys()):  # the seeds are words of the language too
        held[w] = 1
        total += 2
    return held, total


def clean(words: tuple[str, ...], known: Callable[[str], bool]) -> bool:
    """Is every word known, and no short seed beside a short other word?"""
    if not all(known(w) for w in words):
        return False
    short = [w for w in words if len(w) <= SHORT]
    return not (any(w in SEEDS for w in short) and any(w not in SEEDS for w in short))


def split_labels(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) of distinct runs of letters, each split among all counted words that it holds."""
    held, total = held_words(counts)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.column(0).to_pylist():  # at most MAX_WORD parts a letter
                found = [None, *{s[i:j] for i in range(len(s) if len(s) <= MAX_LABEL else 0)
                                 for j in range(i + SHORT + 1, min(i + MAX_WORD, len(s)) + 1)}]
                yield pa.RecordBatch.from_arrays([pa.array([s] * len(found)), pa.array(found, pa.string())],
                                                 names=["label", "part"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = Segmenter(held, total)
        for b in batches:
            words = []
            for s, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                more = {x["word"]: x["n"] for x in found}
                got = seg._split(s, more) if len(s) <= MAX_LABEL else (s,)
                words.append(" ".join(got) if clean(got, lambda w: w in held or w in more) else s)  # noqa: B023
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.string())], names=["label", "words"])

    exploded = C.stored(labels.mapInArrow(parts, "label string, part string"), "url-parts")
    known = exploded.filter("part is not null").join(counts, F.col("part") == F.col("word")).select("label", "word", "n")
    return (exploded.filter("part is null").selectExpr("label", "part as word", "cast(null as long) as n").unionByName(known)
            .groupBy("label").agg(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "n"))).alias("more"))
            .mapInArrow(split, "label string, words string"))


def tokenised(pages: DataFrame, counts: DataFrame, key: str, url: str) -> DataFrame:
    """(key, host, path, words) of every page; words are its host's, split."""
    src = pages.select(key, url)
    kind = src.schema.fields[0].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [split_url(u) for u in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([x[i] for x in both], pa.string()) for i in (0, 1))],
                                             names=[key, "host", "path"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([runs_of(h) for h in hosts], pa.list_(pa.string()))],
                                             names=["host", "runs"])

    urls = C.stored(src.mapInArrow(cut, f"`{key}` {kind}, host string, path string"), "url-pages")
    # one row per run of a distinct host
    rows = C.stored(urls.select("host").distinct().mapInArrow(runs, "host string, runs array<string>")
                    .select("host", F.posexplode("runs").alias("place", "label")), "url-runs")
    labels = rows.filter(F.col("label") >= "a").select("label").distinct()
    split = C.stored(split_labels(labels, counts), "url-labels").withColumnRenamed("label", "l")
    hosts = (rows.join(split, F.col("label") == F.col("l"), "left")
             .select("host", F.struct("place", F.coalesce("words", "label").alias("w")).alias("x"))
             .groupBy(F.col("host").alias("h")).agg(F.array_sort(F.collect_list("x")).alias("xs"))
             .select("h", F.array_join(F.col("xs.w"), " ").alias("words")))
    # a host with many pages: its pages are dealt by a salt, its words go to each piece
    pages_of = C.stored(urls.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("n")), "url-hosts")
    busy = C.stored(pages_of.filter(F.col("n") > SPLIT).select(
        F.col("h").alias("busy"), F.ceil(F.col("n") / SPLIT).cast("int").alias("pieces")), "url-busy")
    dealt = urls.join(C.small_side(busy), F.col("host") == F.col("busy"), "left").withColumn(
        "salt", F.pmod(F.xxhash64(key, "path"), F.coalesce("pieces", F.lit(1))).cast("int")).drop("busy", "pieces")
    hosts = hosts.join(pages_of, "h").select("h", "words", F.explode(F.sequence(
        F.lit(0), (F.ceil(F.col("n") / SPLIT) - 1).cast("int"))).alias("piece"))
    return C.stored(dealt.join(hosts, (F.col("host") == F.col("h")) & (F.col("salt") == F.col("piece")), "left")
                    .select(key, "host", "path", F.coalesce("words", F.lit("")).alias("words")), "url-tokens")


def tokens(words: str, path: str) -> list[str]:
    return [f"h:{w}" for w in words.split()] + path_tokens(path)


def by_label(host: str, words: str) -> list[list[str]]:
    """The host's words (``words``, in order) by label."""
    left, out = words.split(), []
    for label in host.split("."):
        mine, size = [], sum(map(len, LETTERS.findall(label)))
        while left and size > 0:
            size -= len(left[0])
            mine.append(left.pop(0))
        out.append(mine)
    return out


def is_example(labels: list[list[str]], toks: list[str]) -> bool:
    """Is a page of this host and these tokens a block example?"""
    for mine in labels:
        if len(mine) == 1 and len(mine[0]) > SHORT and mine[0] in SEEDS:
            return True
    return len({t[2:] for t in toks if t[2:] in SEEDS}) > 1


def train(pages: DataFrame) -> tuple[np.ndarray, float]:
    """Log odds (block against allow) per token bucket, and of the classes themselves."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for host, words, path in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                labels = by_label(host, words)
                toks = tokens(words, path)
                label = int(is_example(labels, toks))
                seen[(-1, label)] += 1
                for t in toks:
                    seen[(bucket(t), label)] += 1
        yield pa.RecordBatch.from_arrays(  # at most 2 * BUCKETS + 2 rows a task
            [pa.array([k[0] for k in seen], pa.int64()), pa.array([k[1] for k in seen], pa.int64()),
             pa.array(seen.values(), pa.int64())], names=["bucket", "label", "n"])

    rows = (pages.select("host", "words", "path").mapInArrow(count, "bucket long, label long, n long")
            .groupBy("bucket", "label").agg(F.sum("n").alias("n")).collect())  # at most 2 * BUCKETS + 2 rows
    n = np.zeros((2, BUCKETS))
    docs = [0, 0]
    for r in rows:
        if r.bucket < 0:
            docs[r.label] += r.n
        else:
            n[r.label, r.bucket] += r.n
    if not docs[1]:
        return np.zeros(BUCKETS, np.float32), -math.inf
    return log_odds(n).astype(np.float32), math.log((docs[1] + 1) / (docs[0] + 1))


def log_odds(n: np.ndarray) -> np.ndarray:
    """ln p(token | block) - ln p(token | allow) of token counts by class, both smoothed towards all tokens' shares."""
    share = n.sum(0) / max(n.sum(), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.log((n + BACKGROUND * share) / (n.sum(1, keepdims=True) + BACKGROUND))
        return np.where(share > 0, p[1] - p[0], 0.0)


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
          rules: tuple = RULES) -> DataFrame:
    """(key, host, path, rule, verdict, score, tokens) of every page."""
    src = tokenised(pages, unigrams(pages, html), key, url)
    odds, prior = train(src)
    kind = src.schema.fields[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for host, path, words in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                rule, verdict = rule_of(host, path, rules)
                toks = tokens(words, path)
                score = prior + float(sum(odds[bucket(t)] for t in toks))
                for c, v in zip(cols, (host, path, rule, verdict or ("block" if score > 0 else "allow"),
                                       score, " ".join(t[2:] for t in toks)), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.string()) for c in cols[:4]], pa.array(cols[4], pa.float64()),
                 pa.array(cols[5], pa.string())], names=[key, "host", "path", "rule", "verdict", "score", "tokens"])

    return src.mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, verdict string, "
                               "score double, tokens string")


def op3_url_filter(spark: SparkSession, base: str) -> DataFrame:
    """Every page's url, judged."""
    return judge(C.read(spark, base, "pages"))
