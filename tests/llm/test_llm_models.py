"""Mixing, quality, join, language model, WARC and search: brute force, hot groups and the pipeline."""

from __future__ import annotations

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirescope.llm import ann, common, hmm_lm, mixing, ngram_join, quality, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(t):
    return (t or "").encode().lower().split()


def test_targets_are_water_filled(spark):
    sizes = [("b", 10), ("a", 1000), (None, 500), ("é", 0), ("c", 400)]
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    order = sorted((s for s, _ in sizes if s is not None)) + [None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    size, want, free = dict(sizes), {}, set(order)
    left = 1.5 * sum(size.values())
    while True:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > 2 * size[s]}
        if not over:
            break
        for s in over:
            want[s] = 2.0 * size[s]
            left -= want[s]
        free -= over
    want |= {s: level * w[s] for s in free}
    assert got == pytest.approx(want)


def test_mix_meets_targets_and_nests(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 40), "en", rng.choice("aaaabcdefg"), 0) for i in range(3000)]
    d = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("mine")).withColumn("target", F.lit(1))
    small = mixing.mix(d, share=0.5).groupBy("doc_id").count().collect()
    large = {r.doc_id: r["count"] for r in mixing.mix(d).groupBy("doc_id").count().collect()}
    assert all(large.get(r.doc_id, 0) >= r["count"] for r in small)  # nested
    rows_, plans = mixing.mix_plan(d)
    assert mixing.mix(d).columns == d.columns
    for p in plans.collect():
        taken = sum(len(words(r[1])) * large.get(r[0], 0) for r in rows if r[3] == p.source)
        assert abs(taken - p.target) <= 40 and max(large.values()) <= 2


def test_mix_takes_nothing_three_times(spark):
    rows = [(i, None if i % 2 else " \n", "en", "tiny", 0) for i in range(300)] + [(1000, "one two three", "en", "tiny", 0)] + [
        (2000 + i, "w " * 50, "en", "large", 0) for i in range(400)] + [(9000 + i, "", "en", "void", 0) for i in range(50)]
    got = collections.Counter(r.doc_id for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect())
    assert max(got.values()) <= 2 and got[1000] == 2 and all(got[i] == 2 for i in range(300))
    assert all(got[9000 + i] == 1 for i in range(50))


def test_quality_keeps_columns_and_clean_rows(spark):
    clean = [(i, " ".join(f"w{(i * 7 + k * 13) % 997}" for k in range(60)), "en", "s", 1) for i in range(300)]
    junk = [(1000 + i, " ".join(f"w{k}### $$$" for k in range(40)), "en", "s", 1) for i in range(20)]
    bad = [(2000, "a b c " * 30, "en", "s", 1), (2001, None, None, None, None), (2002, "", "en", "s", 1)]
    d = spark.createDataFrame(clean + junk + bad, DOCS).withColumn("n_words", F.lit("mine")).withColumn("kept", F.lit(False))
    got = quality.keep(d)
    assert got.columns == d.columns
    assert sorted(r.doc_id for r in got.collect()) == list(range(300))


def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        n = len(sets[a] & sets[b])
        if sets[a] and 100 * n >= 75 * len(sets[a] | sets[b]) and n:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


@pytest.fixture(scope="module")
def copies():
    """Groups of copies around the threshold, hot passages, short and empty texts."""
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts, i = {}, 0
    for g in range(12):
        base = rng.choices(vocabulary, k=rng.choice([6, 20, 80, 150]))
        for _ in range(rng.choice([2, 5, 40])):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 18))):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            texts[i] = " ".join(t)
            i += 1
    for _ in range(60):  # a passage that many texts share
        texts[i] = " ".join(rng.choices(vocabulary, k=rng.choice([5, 15, 60]))) + " " + passage
        i += 1
    for t in ("", None, "a", "a", "A b c d", "a b c d", "a b c d e", passage, passage + " x"):
        texts[i] = t
        i += 1
    return texts


def test_join_equals_brute_force(spark, copies, monkeypatch):
    d = spark.createDataFrame([(k, t, "x", 1) for k, t in copies.items()], "doc_id long, text string, name string, n long").repartition(7)
    want = brute_components(copies)
    for few, chunk in ((8, 500_000), (2, 2_000), (1000, 500_000)):  # listed pairs, chunked products, all pairs listed
        monkeypatch.setattr(ngram_join, "FEW", few)
        monkeypatch.setattr(ngram_join, "CHUNK", chunk)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_join(d).collect()}
        assert got == want
    stay = ngram_join.one_of_each(d)
    assert stay.columns == d.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(k for k, (_, c) in want.items() if c == k)


def test_join_with_nulls_and_repeats(spark):
    t = " ".join(f"w{i}" for i in range(30))
    d = spark.createDataFrame([(5, t), (5, t), (None, t), (3, t + " x"), (9, "other words that are not the same"), (None, None), (7, ""), (7, "")],
                              "doc_id long, text string")
    got = sorted(map(tuple, ngram_join.jaccard_join(d).collect()), key=str)
    assert got == sorted([(5, 26, 3), (5, 26, 3), (None, 26, 3), (3, 27, 3), (9, 3, 9), (None, 0, None), (7, 0, 7), (7, 0, 7)], key=str)
    stay = [(r.doc_id, r.text) for r in ngram_join.one_of_each(d).collect()]
    assert sorted(stay, key=str) == sorted([(3, t + " x"), (9, "other words that are not the same"), (None, None), (7, ""), (7, "")], key=str)


def test_summaries_bound_the_counts(monkeypatch):
    monkeypatch.setattr(ngram_join, "HEAVY", 20)
    rng = np.random.default_rng(6)
    known, counts, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    for _ in range(30):
        cols = np.concatenate([rng.integers(0, 5000, 200), np.repeat([7, 9], [60, 30])])
        seen.append(cols)
        known, counts = ngram_join.summed(known, counts, cols)
        assert len(known) <= 20
    true = collections.Counter(np.concatenate(seen).tolist())
    told = dict(zip(known.tolist(), counts.tolist(), strict=True))
    for h, c in true.items():
        assert c - sum(true.values()) / 20 <= told.get(h, 0) <= c
    assert told[7] > told[9] > 0


def test_heavy_columns_are_split_and_lose_no_link(spark, copies, monkeypatch):
    d = spark.createDataFrame([(k, t) for k, t in copies.items()], "doc_id long, text string").repartition(5)
    for name, value in (("HOT", 3), ("SPLIT", 1 << 40), ("PIECES", 3)):  # every column of over 6 sets is heavy
        monkeypatch.setattr(ngram_join, name, value)
    heavy = ngram_join.heavy_columns(ngram_join.digests(d, "doc_id", "text").filter("heavy is not null"))
    assert heavy.count() > 20
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_join(d).collect()}
    assert got == brute_components(copies)


def test_stars_find_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7)]
    got = {r.node: r.comp for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {200: 100, 300: 100}


def test_hubs_are_joined_apart_and_change_no_component(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", 8)
    rng = random.Random(12)
    edges = [(500, k) for k in range(400, 600) if k != 500]  # a hub in the middle of its neighbours
    edges += [(599, 700), (700, 701), (900, 901)] + [(k, k + 1) for k in range(1000, 1040)]
    edges += [tuple(rng.sample(range(2000, 2060), 2)) for _ in range(40)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.comp for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_hmm_base_score_and_proper_probability(spark, base):
    docs = [(r.doc_id, r.text) for r in common.read(spark, base, "documents").collect()] + [(None, None), (1, None), (10**9, "Nie Gesehen \u00a0")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("symbols", F.lit("x"))
    got = collections.defaultdict(list)
    for r in hmm_lm.score(d).collect():
        got[r.doc_id].append(r)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    c = collections.Counter(w for i, t in docs if not held[i] for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    for i, t in docs:
        toks = [*words(t), None]
        rows = [r for r in got[i] if r.n_tokens == len(toks)]
        assert rows and rows[0].held_out == held[i] and rows[0].train_tokens == n
        assert rows[0].n_known == sum(c[w] > 0 for w in toks)
        assert rows[0].base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in toks))
    out = [r for rs in got.values() for r in rs if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # the states predict unseen text better


def test_hmm_end_is_known_after_one_very_long_text(spark):
    docs = [(5, " ".join(f"w{i}" for i in range(hmm_lm.TOP + 300))), (1, "w1 new")]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    assert held == {5: False, 1: True}
    c = collections.Counter(w for i, t in docs if not held[i] for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    for r in hmm_lm.score(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        toks = [*words(dict(docs)[r.doc_id]), None]
        assert r.n_known == sum(c[w] > 0 for w in toks)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in toks))


def test_forward_and_counts_equal_enumeration():
    rng = np.random.default_rng(0)
    k, m = 3, 5
    start, move, emit = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(m), k)
    texts = [rng.integers(0, m, n).astype(np.uint16) for n in (1, 4, 6, 4)]
    for x, got in zip(texts, hmm_lm.forward([t.tobytes() for t in texts], start, move, emit), strict=True):
        total, moves = 0.0, np.zeros((k, k))
        for z in itertools.product(range(k), repeat=len(x)):
            p = start[z[0]] * emit[z[0], x[0]] * math.prod(move[a, b] * emit[b, y] for a, b, y in zip(z, z[1:], x[1:]))
            total += p
            for a, b in zip(z, z[1:]):
                moves[a, b] += p
        assert got == pytest.approx(math.log(total))
        every = np.ones((1, len(x)), bool)
        s, mv, e = hmm_lm.expected(x[None].astype(np.int64), every, every, np.ones(1, bool), start, move, emit)
        assert mv == pytest.approx(moves / total) and s.sum() == pytest.approx(1) and e.sum() == pytest.approx(len(x))


def test_stretches_count_every_token_and_step_of_a_text_once():
    rng = np.random.default_rng(4)
    k = 3
    start, move = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k)
    emit = rng.dirichlet(np.ones(hmm_lm.SYMBOLS), k)
    texts = [np.append(rng.integers(0, hmm_lm.OWN, n), hmm_lm.END_SYMBOL).astype(np.uint16).tobytes()
             for n in (0, 3, hmm_lm.STRETCH - 1, hmm_lm.STRETCH, 5 * hmm_lm.STRETCH + 9, 700)]
    rows = hmm_lm.stretches(texts)
    assert rows[2].sum() == sum(len(t) // 2 for t in texts) and rows[3].sum() == len(texts)
    s, m, e = hmm_lm.expected(*rows, start, move, emit)
    assert s.sum() == pytest.approx(len(texts)) and e.sum() == pytest.approx(rows[2].sum())
    assert m.sum() == pytest.approx(rows[2].sum() - len(texts))
    # the same text by text, in any order: nothing runs from one text to the next
    parts = [hmm_lm.expected(*hmm_lm.stretches([t]), start, move, emit) for t in reversed(texts)]
    for whole, each in zip((s, m, e), zip(*parts), strict=True):
        assert np.allclose(whole, sum(each))
    # close to the whole text read at once
    x = np.frombuffer(texts[-1], np.uint16).astype(np.int64)[None]
    every = np.ones(x.shape, bool)
    for part, exact in zip(parts[0], hmm_lm.expected(x, every, every, np.ones(1, bool), start, move, emit), strict=True):
        assert np.abs(part - exact).sum() < 0.02 * max(1, exact.sum())


@pytest.mark.parametrize("texts", [[None, "", " "], ["hello world", "hello there"], ["x"] * 3 + [None] * 40, [None]])
def test_hmm_on_tiny_and_empty_texts(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = hmm_lm.score(d).collect()
    assert len(rows) == len(texts) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)


def test_hmm_scores_do_not_depend_on_partitions(spark, base):
    d = common.read(spark, base, "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10**8 + i, None) for i in range(50)], "doc_id long, text string"))
    one, many = ({(r.doc_id, r.n_tokens): r.score for r in hmm_lm.score(x).collect()}
                 for x in (d.coalesce(1), d.repartition(9)))
    assert one.keys() == many.keys() and all(one[k] == pytest.approx(many[k], abs=1e-5) for k in one)


def test_words_of_equal_counts_fill_up_the_list(spark):
    d = spark.range(5000).selectExpr("id as w", "case when id < 10 then 900 else 3 end as n")
    got = common.most_frequent(d, 1000).collect()
    assert {r.w for r in got} >= set(range(10)) and 800 < len(got) < 1200
    assert common.most_frequent(d, 9000).count() == 5000 and common.most_frequent(d, 0).count() == 0


def test_loser_tree_merges_any_runs():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(((f"u{rng.randint(0, 9)}", str(rng.randint(0, 3)), rng.randint(0, 5)) for _ in range(rng.randint(0, 9))), key=warc.sort_key)
                for _ in range(k)]
        assert list(map(warc.sort_key, warc.LoserTree([iter(r) for r in runs]))) == sorted(map(warc.sort_key, itertools.chain(*runs)))


def test_runs_are_merged_from_files_in_several_passes(tmp_path):
    rng = random.Random(9)
    rows = sorted((((rng.choice("abc"), f"t{rng.randrange(9)}", rng.randrange(5), "u", "response", None, 1, "d", f"ar{i % 23:02d}", i, 1))
                   for i in range(3000)), key=lambda r: (r[8], warc.sort_key(r)))
    files = warc.spilled(str(tmp_path), warc._batches(iter(rows), 700))
    assert len(files) == 23
    got = list(warc.merged(str(tmp_path), files, fan=4))
    assert [warc.sort_key(r) for r in got] == sorted(map(warc.sort_key, rows)) and sorted(got, key=str) == sorted(rows, key=str)
    assert not list(tmp_path.iterdir()) and list(warc.merged(str(tmp_path), [])) == []


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 200_000)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 100)
    pages = [(i, "http://a.b/x", "y" * n + str(i)) for i, n in enumerate([10] * 300 + [30_000] * 40 + [250_000] * 3)] + [(900, None, None)]
    d = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).selectExpr("*", "1 as size", "'x' as value", "2 as first")
    path = str(tmp_path / "w")
    warc.write_archives(d, path)
    sizes = [f.stat().st_size for f in (tmp_path / "w").glob("part-*")]
    assert all(s < 260_000 for s in sizes) and len(sizes) < 60
    got = warc.read_runs(spark, path).collect()
    assert sorted(r.page_id for r in got) == sorted(p[0] for p in pages)
    assert all(r.payload_bytes == len(pages[r.page_id][2]) for r in got if r.page_id < 300)


def test_damaged_archives_are_errors():
    good = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Date: d\r\nWARC-Payload-Digest: sha1:%s\r\nX-Payload-Length: 1\r\nContent-Length: 5\r\n\r\n"
            b"\r\n\r\nx\r\n\r\n") % b"11f6ad8ec52a2984abaafd7c3b516503785c2072"
    assert warc.parse_archive(good, "f")[0][6] == 1
    for bad in (good[:-3], good.replace(b"x\r\n\r\n", b"y\r\n\r\n"), b"junk" + good):
        with pytest.raises(ValueError):
            warc.parse_archive(bad, "f")


def test_captures_are_globally_ordered(spark, base):
    rows = warc.capture_history(common.read(spark, base, "pages").repartition(5)).collect()
    keys = [(r.urlkey, r.ts, r.page_id) for r in rows]
    assert keys == sorted(keys) and len({r.archive for r in rows}) > 1


def brute_nearest(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]]
    return [(int(ids[i]), float(d[i])) for i in order[:k]]


def test_search_recall_and_order(spark, base):
    e = common.read(spark, base, "embeddings").toPandas().sort_values("vec_id")
    x, ids = np.stack(e.embedding).astype(float), e.vec_id.to_numpy()
    got = collections.defaultdict(list)
    for r in ann.op9_inverted_multi_index(spark, base).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hit = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        want = brute_nearest(ids, x, q)
        hit += len({i for i, _ in want} & {i for i, _ in got[ids[q]]})
        total += len(want)
        assert [s for _, s in got[ids[q]]] == sorted(s for _, s in got[ids[q]])
    assert hit / total >= 0.9 and set(got) == set(ids[ids % 100 == 0].tolist())


def test_search_hard_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [0.0, 0.0]), (4, [nan, 1.0]), (5, None), (6, [None, 1.0]),
            (7, [2.0, 2.0]), (7, [2.0, 2.0]), (8, [1.0]), (200, [float("inf"), 0.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit("x"))
    got = sorted(map(tuple, ann.search(d, "id % 100 = 0").collect()))
    assert got == [(0, 1, 3, 0.0), (0, 2, 100, 0.0), (0, 3, 7, math.sqrt(5)), (100, 1, 0, 0.0), (100, 2, 3, 0.0), (100, 3, 7, math.sqrt(5))]


def test_search_takes_the_length_of_vectors_that_take_part(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 6))
    good = [(i, v.tolist()) for i, v in enumerate(x)]
    empty = [(1000 + i, []) for i in range(400)]
    nulls = [(2000 + i, [None] * 9) for i in range(400)]
    zero = [(3000 + i, [0.0] * 3) for i in range(400)]
    short = [(4000 + i, rng.normal(size=4).tolist()) for i in range(200)]
    for rows in (good + empty, good + nulls, good + zero + short):
        d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
        got = collections.defaultdict(list)
        for r in ann.search(d, "id % 100 = 0", target=1.0).orderBy("query_id", "rank").collect():
            got[r.query_id].append(r.vec_id)
        assert sorted(got) == [0, 100, 200] and sum(map(len, got.values())) == 30
        for q in got:
            assert got[q] == [i for i, _ in brute_nearest(np.arange(300), x, q)]
    one = spark.createDataFrame([(i, [float(i + 1)]) for i in range(300)], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, ann.search(one, "id % 100 = 0").collect()))
    assert len(got) == 30 and [r[2] for r in got if r[0] == 100] == [99, 101, 98, 102, 97, 103, 96, 104, 95, 105]


def test_search_repeated_ids_hide_no_neighbour(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 4))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, x[1].tolist())]
    rows += [(1, x[1].tolist())] * 25 + [(2, (x[2] + 1e-6 * j).tolist()) for j in range(25)]  # equal and unequal rows of one id
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann.search(d, "id % 100 = 0", target=1.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    for q, at in ((0, x[0]), (100, x[1])):
        near = {}
        for i, v in rows:
            near[i] = min(near.get(i, math.inf), float(np.sqrt(((np.array(v) - at) ** 2).sum())))
        near.pop(q)
        assert got[q] == sorted(near, key=lambda i: (near[i], i))[:10]
    ids = np.array([7] * 30 + list(range(10, 30)))
    _, best, _ = next(ann.top_k(np.zeros((1, 1)), np.arange(50.0)[:, None], ids, np.array([0]), np.ones((1, 50), bool), 10))
    assert ids[best].tolist() == [7, *range(10, 19)]


def test_cells_are_visited_by_summed_distance():
    rng = np.random.default_rng(1)
    c = ann.Cells(rng.normal(size=(6, 2)), rng.normal(size=(5, 2)))
    q = rng.normal(size=4)
    d = [((c.one[i] - q[:2]) ** 2).sum() + ((c.two[j] - q[2:]) ** 2).sum() for i in range(6) for j in range(5)]
    assert list(c.visit(q)) == np.argsort(d).tolist()


def test_pipeline_equals_brute_force(spark, base):
    docs = common.read(spark, base, "documents")
    kept = {r.doc_id for r in quality.op10_quality_rules(spark, base).collect() if r.kept}
    texts = {r.doc_id: r for r in docs.collect() if r.doc_id in kept}
    comp = brute_components({i: r.text for i, r in texts.items()})
    left = {i for i, (_, c) in comp.items() if c == i}
    size = collections.Counter()
    for i in left:
        size[texts[i].source] += len(words(texts[i].text))
    rows = corpus_pipeline.run(spark, base).collect()
    got = collections.Counter(r.doc_id for r in rows)
    assert set(got) <= left and max(got.values()) <= 2 and all(r.lossless for r in rows)
    taken = collections.Counter()
    for i, n in got.items():
        taken[texts[i].source] += n * len(words(texts[i].text))
    longest = max(len(words(r.text)) for r in texts.values())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= longest * len(size)


def test_stages_return_the_columns_of_documents(spark, base):
    d = common.read(spark, base, "documents").withColumn("extra", F.lit(1)).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, d, base).columns == d.columns
        assert stage(spark, d, base).count() == 0
