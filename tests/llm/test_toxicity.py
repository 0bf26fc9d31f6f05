"""Toxicity: gradient, brute-force scores, held-out accuracy, hard rows."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirescope.llm import common as C
from hirescope.llm import toxicity as X

WORDS = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "table", "paper", "green", "Ärger", "naïve"]


def _texts(n: int = 400):
    """Every third text has one bad word (a stem with changing endings) in one of its sentences."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(WORDS, 6)) for _ in range(int(rng.integers(1, 9)))]
        bad = i % 3 == 0
        if bad:
            at = int(rng.integers(len(sentences)))
            sentences[at] = sentences[at] + " Vilest" + str(rng.choice(["en", "er", "os", "ix"])) + " you"
        rows.append((i, ". ".join(sentences) + ".", "en", "a"))
        labels.append((i, 1, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = _texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").cache()
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, labels, X.train(docs, labels)


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    x = rng.normal(size=6)
    doc = np.array([0, 0, 1, 2, 2, 2])
    sentence, feature = np.array([0, 0, 1, 2, 3, 4, 5]), np.array([0, 1, 2, 0, 3, 4, 4])
    args = (np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5]), np.array([2, 0, 5]), doc, sentence, feature)
    _, grad = X.likelihood(x, *args)
    for i in range(len(x)):
        e = np.zeros(len(x))
        e[i] = 1e-6
        assert grad[i] == pytest.approx((X.likelihood(x + e, *args)[0] - X.likelihood(x - e, *args)[0]) / 2e-6, rel=1e-5, abs=1e-8)


def _names(word: str) -> set[int]:
    b = word.encode()
    out = {int((C.run_hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)])) ^ X._WHOLE)[0])}
    for k in X.PREFIXES:
        if len(b) >= k:
            run = 0
            for j in range(k):
                run = (run + int(C._BYTE_CODE[b[j]]) * int(C._powers(k)[j])) % (1 << 64)
            out.add(int(C.mix64(np.array([run ^ k], np.uint64))[0]))
    return out


def brute(text: str | None, model: X.Model) -> tuple[float, int]:
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    none, n = 1.0, 0
    for s in re.split(r"(?<=[.!?])(?=[ \t-\r]|$)|(?<=\n)", (text or "").lower()):
        words = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", s)
        if words:
            held = set().union(*(_names(w) for w in words))
            n += 1
            none *= 1 - 1 / (1 + math.exp(-(model.bias + sum(weight.get(f, 0.0) for f in held))))
    return 1 - none, n


HARD = [(1, None), (2, ""), (3, " \n .!? "), (4, "Vilesten"), (5, "one vilestos you.two 3.5 x! y?\nz"), (None, "No id. Vilestix you!"),
        (7, "Ä vilester Ärger! " * 3000), (7, "Ä vilester Ärger! " * 3000), (8, "w" * 100_000), (9, "İstanbul vilesten. ﬁne VILESTEN you")]


def test_scores_equal_brute_force(spark, trained):
    docs, _, model = trained
    hard = spark.createDataFrame(HARD, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("worst_score", F.lit(1))
    got = [tuple(r) for r in X.score(hard, model).select("doc_id", "score", "n_sentences").collect()]
    want = [(i, *brute(t, model)) for i, t in HARD]
    for (i, s, n), (j, p, m) in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert (i, n) == (j, m) and s == pytest.approx(p, abs=1e-9)
    rows = {r.doc_id: r.text for r in docs.collect()}
    for r in X.score(docs.repartition(3), model).collect():
        assert r.score == pytest.approx(brute(rows[r.doc_id], model)[0], abs=1e-9)


def test_learns_from_document_labels_and_finds_the_sentences(spark, trained):
    docs, labels, model = trained
    got = X.score(docs, model).join(labels, "doc_id").withColumn("held", X.held_out(F.col("doc_id"))).collect()
    assert {r.held for r in got} == {True, False}
    for r in got:
        assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert (r.score >= 0.5) == (r.toxic == 1), r
    found = X.offending(docs, model).collect()
    assert len(found) == sum(r.toxic for r in got)
    assert all("Vilest" in r.text and r.score >= 0.5 for r in found)
    at = {r.doc_id: r.sentence for r in found}
    assert all(r.worst_sentence == at[r.doc_id] for r in got if r.toxic)


def test_held_out_labels_are_not_learned_from(spark, trained):
    docs, labels, model = trained
    turned = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = X.train(docs.repartition(5), turned)
    assert np.array_equal(model.features, again.features)
    assert np.allclose(model.weights, again.weights, atol=1e-3) and again.bias == pytest.approx(model.bias, abs=1e-3)


def test_no_or_odd_labels_give_a_constant(spark):
    docs = spark.createDataFrame(HARD, "doc_id long, text string")
    for rows, want in (([], 0.0), ([(1, 0), (2, 0), (None, 1), (3, None)], 0.0), ([(1, 1), (1, 0), (2, 1), (4, 1)], None)):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        got = {r.score for r in X.score(docs, X.train(docs, labels)).collect()}
        assert len(got) == 1 and all(0 <= s <= 1 for s in got)
        assert want is None or got == {want}


def test_held_out_accuracy_on_the_tables(spark):
    base = "/root/testdata/sf0.01"
    got = X.op12_toxicity(spark, base).join(C.read(spark, base, "labels"), "doc_id").collect()
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    pos, neg = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.75
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.9
