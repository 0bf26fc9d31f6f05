"""Regularised boosting: splits against an exhaustive search, save and load, hard rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirescope.plans import boosting as B

FEATURES = ["a", "b", "c d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 300
    a, b, c = rng.integers(0, 12, n) / 3.0, rng.normal(size=n).round(1), rng.integers(0, 2, n)
    y = 0.7 * (a > 2) + 0.5 * (b > 0.3) * (c == 1) + rng.normal(0, 0.05, n)
    data = [(f"k{i}", float(y[i]), float(a[i]), None if i % 17 == 0 else float(b[i]), float(c[i]), 1.0) for i in range(n)]
    return spark.createDataFrame(data, "slug string, label double, a double, b double, `c d` double, e double").repartition(5)


def _gain(g, left, p):
    def worth(x):
        t = np.sign(x.sum()) * max(abs(x.sum()) - p.l1, 0)
        return t * t / (len(x) + p.l2)
    return worth(g[left]) + worth(g[~left]) - worth(g)


def test_every_split_equals_an_exhaustive_search(spark, rows):
    p = B.BoostParams(trees=3, depth=3, learning_rate=0.5, subsample=1.0, colsample=1.0, bins=64)
    model = B.fit(rows, "slug", "label", FEATURES, p)
    d = rows.toPandas()
    x = d[FEATURES].to_numpy(float)
    y = d.label.to_numpy()
    pred = np.full(len(y), y.mean())
    assert model.base == pytest.approx(y.mean())
    for tree in model.trees:
        g = pred - y
        place = np.zeros(len(y), int)
        for node in range(len(tree.feature)):
            at = place == node
            if tree.rows[node] == 0:
                continue
            assert tree.rows[node] == at.sum()
            t = np.sign(g[at].sum()) * max(abs(g[at].sum()) - p.l1, 0)
            assert tree.value[node] == pytest.approx(-p.learning_rate * t / (at.sum() + p.l2), abs=1e-9)
            best = 0.0
            if node < 7:
                for j in range(len(FEATURES)):
                    for v in np.unique(x[at, j][~np.isnan(x[at, j])]):
                        left = np.isnan(x[at, j]) | (x[at, j] <= v)
                        if min(left.sum(), (~left).sum()) >= p.min_child:
                            best = max(best, _gain(g[at], left, p))
            if tree.feature[node] < 0:
                assert best <= 1e-6 or node >= 7
                continue
            assert tree.gain[node] == pytest.approx(best, rel=1e-6)
            f = tree.feature[node]
            right = ~np.isnan(x[:, f]) & (x[:, f] > model.edges[f][tree.cut[node]])
            place = np.where(at, 2 * node + 1 + right, place)
        pred = pred + tree.value[place]
    got = {r.slug: r.prediction for r in model.predict(rows).collect()}
    assert np.allclose([got[s] for s in d.slug], pred)


def test_a_fit_does_not_depend_on_partitions_and_is_loaded_as_saved(spark, rows, tmp_path):
    p = B.BoostParams(trees=12, depth=2)
    one, two = (B.fit(r, "slug", "label", FEATURES, p) for r in (rows, rows.repartition(1)))
    for s, t in zip(one.trees, two.trees, strict=True):
        assert (s.feature == t.feature).all() and (s.cut == t.cut).all() and np.allclose(s.value, t.value)
        assert len(s.drawn) == 4 and (s.rows[0] < 300)  # rows are drawn per tree
    B.save(spark, one, str(tmp_path / "m"))
    both = B.load(spark, str(tmp_path / "m")).predict(one.predict(rows, "p"), "q")
    assert both.filter(F.abs(F.col("p") - F.col("q")) > 1e-12).count() == 0


def test_no_rows_no_features_and_no_labels(spark, rows):
    for df in (rows.limit(0), rows.withColumn("label", F.lit(None).cast("double"))):
        model = B.fit(df, "slug", "label", FEATURES, B.BoostParams(trees=2))
        assert model.trees == [] and [r.prediction for r in model.predict(rows).limit(2).collect()] == [None, None]
    assert B.fit(rows, "slug", "label", [], B.BoostParams(trees=2)).trees == []


def test_blocks_hold_every_bin_and_histograms_equal_a_count_of_dense_rows(spark, rows):
    p = B.BoostParams(subsample=1.0)
    edges = B.bin_edges(rows, FEATURES, p.bins)
    base = 0.25
    stored = B._stored(B._blocks(rows, "slug", "label", FEATURES, edges, [base], F.lit(-1)))
    drawn = list(range(len(FEATURES)))
    tree = B.Tree.empty(2, drawn)
    tree.feature[0], tree.cut[0] = 0, 5
    (g, n), = B.histograms(stored, [[]], [tree], 0, 1, edges, p, False)
    d = rows.toPandas()
    x = d[FEATURES].to_numpy(float)
    bins = np.stack([np.where(np.isnan(c), 0, np.searchsorted(e, c, "left")) for c, e in zip(x.T, edges)])
    right = bins[0] > 5
    for j in drawn:
        for node, rows_in in ((0, ~right), (1, right)):
            for b in range(p.bins):
                at = rows_in & (bins[j] == b)
                assert n[node, j, b] == at.sum()
                assert g[node, j, b] == pytest.approx((base - d.label[at]).sum(), abs=1e-9)


def test_a_feature_of_few_values_has_one_bin_a_value_however_rare(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 7, 5.0).otherwise(F.col("id") % 2 * 9.0).alias("a"),
                                    F.col("id").cast("double").alias("b"))
    a, b = B.bin_edges(df, ["a", "b"], 32)
    assert a == [2.5, 7.0] and 25 <= len(b) <= 31


def test_models_of_folds_trained_side_by_side_equal_single_fits(spark, rows):
    p = B.BoostParams(trees=12, depth=3)
    held = rows.withColumn("fold", F.pmod(F.xxhash64("slug"), F.lit(3)).cast("int"))
    for k, m in enumerate(B.fit_folds(held, "slug", "label", ["a", "c d", "e"], "fold", 3, p)):
        one = B.fit(held.filter(F.col("fold") != k), "slug", "label", ["a", "c d", "e"], p)
        assert m.base == pytest.approx(one.base)
        both = one.predict(m.predict(rows, "p"), "q")
        assert both.filter(F.abs(F.col("p") - F.col("q")) > 1e-9).count() == 0


def test_wide_projections_are_cut_into_methods_that_hotspot_compiles(spark, base):
    import __spark_entry__ as entry
    from hirescope import catalog

    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    entry.queries()["boost_root_gains"](spark, base)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert len(catalog._boost_frame(spark, base)[0].names) > 10


def test_a_sibling_is_what_its_parent_has_left_and_bins_are_digits_of_codes(spark, rows):
    p = B.BoostParams(subsample=1.0, bins=64)
    edges = B.bin_edges(rows, FEATURES, p.bins)
    at, sizes = B._layout([len(e) + 1 for e in edges])
    assert all(1 << digits > len(e) for (_, _, digits), e in zip(at, edges, strict=True)) and max(sizes) <= B.DIGITS
    held = B._dealt(B._stored(B._blocks(rows, "slug", "label", FEATURES, edges, [0.25], F.lit(-1)))).cache()
    tree = B.Tree.empty(2, list(range(len(FEATURES))))
    root, = B.histograms(held, [[]], [tree], 0, 0, edges, p, False)
    B._grow(tree, 0, *root, p)
    (some, few), = B.histograms(held, [[]], [tree], 0, 1, edges, p, False, [root])
    (every, all_rows), = B.histograms(held, [[]], [tree], 0, 1, edges, p, False)
    assert tree.feature[0] >= 0 and (few == all_rows).all() and np.allclose(some, every, atol=1e-9)
    held.unpersist()


def test_a_fit_keeps_its_blocks_while_it_lasts(spark, rows, monkeypatch):
    kept = []
    real = B.histograms
    monkeypatch.setattr(B, "histograms", lambda rows, *a: kept.append(rows.is_cached) or real(rows, *a))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    B.fit(rows, "slug", "label", FEATURES, B.BoostParams(trees=7, depth=2))
    assert all(kept) and spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_predictions_are_those_of_the_trees_whatever_the_features_hold(spark, rows):
    model = B.fit(rows, "slug", "label", FEATURES, B.BoostParams(trees=9, depth=3))
    odd = [("x", None, float("nan"), 1.0, 1.0), ("y", 1e9, -1e9, None, float("nan")), ("z", 2.0, 0.3, 1.0, 1.0)]
    df = spark.createDataFrame(odd, "slug string, a double, b double, `c d` double, e double")
    plan = model.predict(df)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan  # the decisions are looked up, no expression of every tree is compiled
    for r in model.predict(df).collect():
        x = [r["a"], r["b"], r["c d"], r["e"]]
        want = model.base
        for t in model.trees:
            i = 0
            while t.feature[i] >= 0:
                v = x[t.feature[i]]
                i = 2 * i + 1 + (v is not None and v == v and v > model.edges[t.feature[i]][t.cut[i]])
            want += t.value[i]
        assert abs(r["prediction"] - want) < 1e-12
