"""Salary model: exact SHAP additivity and fold assignment."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from hirescope import catalog
from hirescope.plans import salary as S


def test_shap_sums_to_prediction(spark, base):
    t = S.training_frame(catalog.warehouse(spark, base).fact())
    sm = S.train_model(t, S.GBTParams(trees=8))
    assert sm is not None
    trees, weights = S.tree_table(sm)
    feats = sm.spec.featurize(t)
    pred = sm.model.transform(feats).select(*sm.spec.columns, "prediction").toPandas()
    X = pred[sm.spec.columns].to_numpy(dtype=float)
    phi, base_value = S.shap_values(X, trees, weights)
    np.testing.assert_allclose(phi.sum(axis=1) + base_value, pred["prediction"], atol=1e-9)


def test_shap_matches_brute_force_shapley():
    # one depth-2 tree over 3 features, brute-force Shapley with the
    # path-dependent (cover-weighted) value function
    import itertools
    import math

    tree = {0: {"value": 0, "cover": 10, "left": 1, "right": 2, "feature": 0, "split": [0.5], "ncat": -1},
            1: {"value": 0, "cover": 6, "left": 3, "right": 4, "feature": 1, "split": [0.5], "ncat": -1},
            2: {"value": 0, "cover": 4, "left": 5, "right": 6, "feature": 0, "split": [1.5], "ncat": -1},
            3: {"value": 1.0, "cover": 2, "left": -1, "right": -1, "feature": -1, "split": [], "ncat": -1},
            4: {"value": 3.0, "cover": 4, "left": -1, "right": -1, "feature": -1, "split": [], "ncat": -1},
            5: {"value": -2.0, "cover": 1, "left": -1, "right": -1, "feature": -1, "split": [], "ncat": -1},
            6: {"value": 5.0, "cover": 3, "left": -1, "right": -1, "feature": -1, "split": [], "ncat": -1}}

    def v(x, S_):
        def go(n):
            node = tree[n]
            if node["left"] < 0:
                return node["value"]
            f = node["feature"]
            if f in S_:
                return go(node["left"] if x[f] <= node["split"][0] else node["right"])
            l, r = tree[node["left"]], tree[node["right"]]
            return (go(node["left"]) * l["cover"] + go(node["right"]) * r["cover"]) / node["cover"]
        return go(0)

    X = np.array([[0.0, 0.0, 1.0], [1.0, 1.0, 0.0], [2.0, 0.0, 0.0], [0.0, 1.0, 1.0]])
    phi, base_value = S.shap_values(X, [tree], [1.0])
    M = 3
    for row, x in enumerate(X):
        for i in range(M):
            others = [j for j in range(M) if j != i]
            want = 0.0
            for k in range(M):
                for Sset in itertools.combinations(others, k):
                    w = math.factorial(k) * math.factorial(M - k - 1) / math.factorial(M)
                    want += w * (v(x, set(Sset) | {i}) - v(x, set(Sset)))
            assert abs(phi[row, i] - want) < 1e-12
    assert abs(base_value - v(X[0], set())) < 1e-12


def test_group_folds_balanced(spark, base):
    t = S.training_frame(catalog.warehouse(spark, base).fact())
    folds = S.group_folds(t).toPandas()
    assert folds["fold"].nunique() == min(5, len(folds))
    assert folds["week_key"].is_unique
    sizes = folds.groupby("fold")["n"].sum()
    assert sizes.max() - sizes.min() <= folds["n"].max()


def test_repeated_kfold_fallback_when_few_weeks(spark, base):
    t = S.training_frame(catalog.warehouse(spark, base).fact()).withColumn(
        "snapshot_date", F.to_date(F.lit("2024-01-03")))
    folded, label, count, splits = S.assign_folds(t)
    assert label == "n_repeats" and count == 5 and len(splits) == 25
    per = folded.groupBy("repeat").count().collect()
    n = t.count()
    assert sorted(r["count"] for r in per) == [n] * 5


def test_saved_model_loads_and_scores(spark, base):
    t = S.training_frame(catalog.warehouse(spark, base).fact())
    sm = S.train_model(t, S.GBTParams(trees=5))
    root = sm.path.rsplit("/", 1)[0]
    again = S.load_model(spark, root)
    assert again.spec.names == sm.spec.names
    a = sm.score(catalog.warehouse(spark, base).fact()).orderBy("slug").collect()
    b = again.score(catalog.warehouse(spark, base).fact()).orderBy("slug").collect()
    assert a == b and all(r["predicted_min_eur"] > 0 for r in a)


def test_training_gate_blocks_small_frames(spark, base):
    t = S.training_frame(catalog.warehouse(spark, base).fact()).limit(10)
    assert S.train_model(t, S.GBTParams(trees=2)) is None
    assert S.cv_metrics(t, S.GBTParams(trees=2)).count() == 0


def test_grouped_cv_metrics_on_real_rows(spark, base):
    import math

    t = S.training_frame(catalog.warehouse(spark, base).fact())
    spec = S.feature_spec(t)
    preds, label, count, data = S.cv_predictions(t, S.GBTParams(trees=3), spec)
    assert label == "n_folds" and count == 5
    assert preds.count() == t.count()  # every row is predicted exactly once
    data.unpersist()
    m = S.cv_metrics(t, S.GBTParams(trees=3), spec).first()
    assert m["n_folds"] == 5 and m["n_splits"] == 5
    assert 0 < m["mae_log"] < 5 and math.isfinite(m["r2"]) and m["r2"] <= 1


def test_cv_metrics_equal_duckdb_on_written_predictions(spark, base, tmp_path):
    """H9: MAE and R^2 recomputed from the predictions, R^2 against each split's own mean."""
    import duckdb

    t = S.training_frame(catalog.warehouse(spark, base).fact())
    preds, _, _, data = S.cv_predictions(t, S.GBTParams(trees=3))
    out = str(tmp_path / "predictions")
    preds.write.parquet(out)
    data.unpersist()
    # a split of one row has an error, but no R^2
    extra = spark.createDataFrame([(9, 0, 10.0, 10.5)], "repeat int, fold int, label double, prediction double")
    extra.select(*[F.col(f.name).cast(f.dataType) for f in preds.schema.fields]).write.mode("append").parquet(out)
    got = S.split_metrics(spark.read.parquet(out)).first()
    want = duckdb.sql(f"""
        WITH p AS (SELECT *, avg(label) OVER (PARTITION BY repeat, fold) AS m FROM read_parquet('{out}/*.parquet')),
        s AS (SELECT avg(abs(label - prediction)) AS mae, CASE WHEN count(*) > 1 THEN
                1 - sum((label - prediction) ** 2) / sum((label - m) ** 2) END AS r2 FROM p GROUP BY repeat, fold)
        SELECT avg(mae), avg(r2), count(*) FROM s""").fetchall()[0]
    np.testing.assert_allclose([got["mae_log"], got["r2"]], want[:2], rtol=1e-6)
    assert got["n_splits"] == want[2] == 6


def test_drivers_and_report_equal_duckdb_on_written_attributions(spark, base, tmp_path):
    """Mean |SHAP| of every feature, ranked, from one written value per row and feature."""
    import duckdb

    t = S.training_frame(catalog.warehouse(spark, base).fact())
    sm = S.train_model(t, S.GBTParams(trees=6))
    out = str(tmp_path / "attributions")
    S.attributions(sm, t).write.parquet(out)
    want = duckdb.sql(f"""
        SELECT feature, avg(abs(value)) AS importance FROM read_parquet('{out}/*.parquet')
        GROUP BY feature ORDER BY round(importance, 12) DESC, feature LIMIT 25""").fetchall()
    assert duckdb.sql(f"SELECT count(*) FROM read_parquet('{out}/*.parquet')").fetchall()[0][0] == t.count() * len(sm.spec.names)
    values = dict(duckdb.sql(f"SELECT feature, avg(abs(value)) FROM read_parquet('{out}/*.parquet') GROUP BY feature").fetchall())
    report = S.quality_report(sm, t, S.GBTParams(trees=2)).collect()
    drivers = {r["name"]: r["value"] for r in report if r["section"] == "driver"}
    assert len(drivers) == len(want)
    np.testing.assert_allclose(sorted(drivers.values()), sorted(v for _, v in want), rtol=1e-9, atol=1e-12)
    for name, value in drivers.items():
        np.testing.assert_allclose(value, values[name], rtol=1e-9, atol=1e-12)
    assert {r["name"] for r in report if r["section"] == "metric"} == {"mae_log", "r2", "n_folds"}


def test_shapley_values_looked_up_by_decisions_equal_those_worked_out_by_row(spark, base, monkeypatch):
    t = S.training_frame(catalog.warehouse(spark, base).fact())
    sm = S.train_model(t, S.GBTParams(trees=4))
    trees, weights = S.tree_table(sm)
    assert len(trees) == 5 and len(trees[0]) == 1  # the mean label, then the trees
    x = sm.spec.featurize(t).select(*sm.spec.columns).toPandas().to_numpy(dtype=float)
    listed, base_value = S.shap_values(x, trees, weights)
    monkeypatch.setattr(S, "MOST_LISTED", -1)
    by_row, same = S.shap_values(x, trees, weights)
    np.testing.assert_allclose(listed, by_row, atol=1e-12)
    assert base_value == same


def test_shapley_tables_are_worked_out_once_for_all_batches_of_a_task(monkeypatch):
    tree = {0: {"value": 0, "cover": 10, "left": 1, "right": 2, "feature": 1, "split": [0.5], "ncat": -1},
            1: {"value": 1.0, "cover": 6, "left": -1, "right": -1, "feature": -1, "split": [], "ncat": -1},
            2: {"value": 4.0, "cover": 4, "left": -1, "right": -1, "feature": -1, "split": [], "ncat": -1}}
    worked_out, real = [], S._tree_shapley
    monkeypatch.setattr(S, "_tree_shapley", lambda *a: worked_out.append(1) or real(*a))
    known: dict = {}
    for x in (np.eye(3, 2), np.ones((5, 2)), np.zeros((1, 2))):
        phi, base = S.shap_values(x, [tree], [1.0], known)
        np.testing.assert_allclose(phi.sum(axis=1) + base, np.where(x[:, 1] > 0.5, 4.0, 1.0))
    assert len(worked_out) == 1


def test_packed_indicators_are_the_features(spark, base):
    fct = catalog.warehouse(spark, base).fact()
    spec = S.feature_spec(S.training_frame(fct))
    want = spec.featurize(fct).select("slug", *spec.columns).toPandas().sort_values("slug")
    got = spec.packed(fct, "slug").toPandas().sort_values("slug")
    assert len(got.columns) == 1 + -(-len(spec.names) // 8)
    np.testing.assert_array_equal(spec.unpacked(got), want[spec.columns].to_numpy())
