"""Salary regression with boosted trees on Spark.

Target ``log(salary_min_annualized_eur)``; features are multi-hot skills (a
frequency-capped vocabulary), one-hot city (top cities, rest ``Other``), role
family, seniority, language gate, and the remote flag; model is a
gradient-boosted tree ensemble; quality is grouped cross-validation by
Sunday-first snapshot week; drivers are mean |SHAP| values.

Scale notes
* Vocabularies are small aggregates (<= 12 cities, <= 20 skills and a few
  enumerations), so the feature layout is decided on the driver from bounded
  results; featurisation itself is a Column projection on the executors.
* Fold assignment needs the greedy "largest group to the lightest fold" pass
  over the *group sizes* (one row per snapshot week, bounded by the calendar),
  which runs on the driver and goes back as a broadcast table.
* The trees are those of ``plans.boosting``: a fit reads column blocks once per tree
  and level. The models of a cross-validation are trained side by side, so they
  share these reads.
* SHAP runs in ``mapInPandas`` with the tree table (<= trees x 15 nodes)
  shipped in the closure; each task emits per-feature partial sums, so only
  (#features x #batches) rows are shuffled. A tree's values depend on its decisions
  only: they are worked out once per combination of decisions and looked up.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions import taxonomy as T
from hirescope.functions import text as X
from hirescope.operators.ranking import ranked
from hirescope.operators.topk import top_k
from hirescope.plans import boosting as B
from hirescope.plans import models as M
from hirescope.session import scratch_path

OTHER = T.ROLE_FAMILY_OTHER


# -- H1 ---------------------------------------------------------------------

def training_frame(fct: DataFrame) -> DataFrame:
    """Postings with an annualised salary in [10k, 250k] (pushed to the scan when
    the fact is a stored table)."""
    s = F.col("salary_min_annualized_eur")
    return (fct.filter(s.isNotNull() & s.between(T.TRAIN_SALARY_MIN, T.TRAIN_SALARY_MAX))
               .select("slug", "city", "role_family", "seniority", "remote", "language_gate",
                       s.alias("salary"), "snapshot_date",
                       F.coalesce("skills", F.array().cast("array<string>")).alias("skills")))


# -- H2 / H3 ----------------------------------------------------------------

def city_vocab(train: DataFrame) -> DataFrame:
    """The 12 most frequent cities (ties by name)."""
    counts = train.groupBy("city").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, T.TOP_N_CITIES, [F.col("n").desc()], ["city"])


def skill_counts(train: DataFrame) -> DataFrame:
    return (train.select(M.explode_skills().alias("skill_name"))
            .filter(F.col("skill_name").isNotNull())
            .groupBy("skill_name").agg(F.count(F.lit(1)).alias("n")))


def skill_vocab(train: DataFrame) -> DataFrame:
    """The 20 most frequent skills, then only those in >= 8 postings; when none
    qualifies, every skill seen."""
    counts = skill_counts(train)
    vocab = top_k(counts, T.TOP_K_SKILLS, [F.col("n").desc()], ["skill_name"]).filter(
        F.col("n") >= T.MIN_SKILL_FREQ)
    return vocab if not vocab.isEmpty() else counts


# -- H4-H6 feature layout ---------------------------------------------------

def _bucket_city(top: list[str]):
    return F.when(F.col("city").isin(top), F.col("city")).otherwise(F.lit(OTHER))


@dataclass
class FeatureSpec:
    skills: list[str]
    top_cities: list[str]
    city_levels: list[str]
    role_levels: list[str]
    sen_levels: list[str]
    lang_levels: list[str]
    names: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.names = ([f"skill__{s}" for s in self.skills]
                      + [f"city_{v}" for v in self.city_levels]
                      + [f"role_{v}" for v in self.role_levels]
                      + [f"sen_{v}" for v in self.sen_levels]
                      + [f"lang_{v}" for v in self.lang_levels]
                      + ["remote"])

    @property
    def columns(self) -> list[str]:
        return [f"f_{i:03d}" for i in range(len(self.names))]

    def indicator_columns(self) -> list:
        """0/1 double columns, one per feature, in ``names`` order."""
        city = _bucket_city(self.top_cities)
        role = F.coalesce(F.col("role_family"), F.lit(OTHER))
        sen = F.coalesce(F.col("seniority"), F.lit(T.SENIORITY_UNKNOWN))
        lang = F.coalesce(F.col("language_gate"), F.lit("unclear"))
        exprs = ([F.array_contains("skills", s) for s in self.skills]
                 + [city == v for v in self.city_levels]
                 + [role == v for v in self.role_levels]
                 + [sen == v for v in self.sen_levels]
                 + [lang == v for v in self.lang_levels]
                 + [F.coalesce(F.col("remote"), F.lit(False))])
        return [F.coalesce(e, F.lit(False)).cast("double").alias(c)
                for e, c in zip(exprs, self.columns)]

    def featurize(self, df: DataFrame) -> DataFrame:
        return df.select("*", *self.indicator_columns())

    def packed(self, df: DataFrame, *keep: str) -> DataFrame:
        """``keep`` and the indicators of every row, eight to a number."""
        words = B.packed([c == 1.0 for c in self.indicator_columns()])
        return df.select(*keep, *[w.alias(f"w_{i:03d}") for i, w in enumerate(words)])

    def unpacked(self, pdf: pd.DataFrame) -> np.ndarray:
        """The matrix (row, feature) of rows from :meth:`packed`."""
        words = pdf[[f"w_{i:03d}" for i in range(-(-len(self.names) // B.WORD))]].to_numpy(np.uint8)
        bits = np.unpackbits(words, axis=1, bitorder="little")[:, :len(self.names)]
        return np.asfortranarray(bits, dtype=float)

    def names_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.names)), "feature_idx int, feature string")


def feature_spec(train: DataFrame) -> FeatureSpec:
    """Vocabularies and the levels seen in training (all bounded, see module doc)."""
    top = [r["city"] for r in city_vocab(train).collect()]
    skills = sorted(r["skill_name"] for r in skill_vocab(train).collect())
    lv = train.agg(
        F.collect_set(_bucket_city(top)).alias("c"),
        F.collect_set(F.coalesce("role_family", F.lit(OTHER))).alias("r"),
        F.collect_set(F.coalesce("seniority", F.lit(T.SENIORITY_UNKNOWN))).alias("s"),
        F.collect_set(F.coalesce("language_gate", F.lit("unclear"))).alias("l"),
    ).first()
    return FeatureSpec(skills, top, sorted(lv["c"] or []), sorted(lv["r"] or []),
                       sorted(lv["s"] or []), sorted(lv["l"] or []))


def features_long(train: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(slug, feature) for every feature equal to 1: the sparse form of the matrix."""
    f = spec.featurize(train)
    hits = F.array_compact(F.array(*[F.when(F.col(c) == 1.0, F.lit(n))
                                     for c, n in zip(spec.columns, spec.names)]))
    return (f.select("slug", F.explode_outer(hits).alias("feature"))
             .filter(F.col("feature").isNotNull()))


def min_training_rows(spec: FeatureSpec) -> int:
    return max(T.MIN_TRAINING_ROWS, len(spec.names) * T.MIN_ROWS_PER_FEATURE)


# -- H8 folds ----------------------------------------------------------------

def with_week_key(train: DataFrame) -> DataFrame:
    return train.withColumn("week_key", X.sunday_week_key(F.col("snapshot_date")))


def group_folds(train: DataFrame, n_splits_max: int = T.N_FOLDS) -> DataFrame:
    """GroupKFold table ``(week_key, n, fold)``.

    Groups are taken largest first (ties: larger key first) and each goes to
    the currently lightest fold (ties: lowest fold). The input to this
    sequential pass is one row per week, bounded by the calendar span.
    """
    spark = train.sparkSession
    sizes = (with_week_key(train).groupBy("week_key").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), F.col("week_key").desc()).collect())
    k = min(n_splits_max, len(sizes))
    totals = np.zeros(max(k, 1), dtype=np.int64)
    rows = []
    for r in sizes:
        fold = int(np.argmin(totals))
        totals[fold] += r["n"]
        rows.append((r["week_key"], int(r["n"]), fold))
    return spark.createDataFrame(rows, "week_key string, n bigint, fold int")


def repeated_folds(train: DataFrame, repeats: int = T.N_REPEATS, folds: int = T.N_FOLDS,
                   seed: int = T.CV_SEED) -> DataFrame:
    """Repeated K-fold ``(slug, repeat, fold)``: every slug once per repeat, folds equal but for one row.

    A repeat's permutation is the order by md5(slug|repeat|seed); its ranks are taken
    in parallel (``operators.ranking``) and dealt to the folds in turn.
    """
    draws = train.select("slug", F.explode(F.array(*[F.lit(i) for i in range(repeats)])).alias("repeat")).withColumn(
        "draw", F.md5(F.concat_ws("|", "slug", F.col("repeat").cast("string"), F.lit(str(seed)))))
    placed = ranked(draws, [F.col("draw").asc(), F.col("slug").asc()], ["repeat"])
    return placed.select("slug", "repeat", (F.col("_rank") % folds).cast("int").alias("fold"))


def assign_folds(train: DataFrame) -> tuple[DataFrame, str, int, list[tuple[int, int]]]:
    """Rows with ``(repeat, fold)``; returns (frame, label, count, splits).

    >= 3 snapshot weeks: grouped folds by week. Otherwise 5 x 5 repeated K-fold
    (:func:`repeated_folds`).
    """
    wk = with_week_key(train)
    n_groups = wk.select("week_key").distinct().count()
    if n_groups >= T.MIN_GROUPS_FOR_GROUP_KFOLD:
        folds = group_folds(train)
        # one row per week: a bounded table, broadcast to every task
        out = wk.join(F.broadcast(folds.select("week_key", "fold")), "week_key").withColumn(
            "repeat", F.lit(0))
        k = min(T.N_FOLDS, n_groups)
        return out, "n_folds", k, [(0, f) for f in range(k)]
    out = wk.join(repeated_folds(wk), "slug")
    return out, "n_repeats", T.N_REPEATS, [(r, f) for r in range(T.N_REPEATS)
                                             for f in range(T.N_FOLDS)]


# -- H10 model ---------------------------------------------------------------

@dataclass
class GBTParams:
    trees: int = T.GBT_TREES
    depth: int = T.GBT_DEPTH
    learning_rate: float = T.GBT_LEARNING_RATE
    min_child: int = T.GBT_MIN_CHILD
    subsample: float = T.GBT_SUBSAMPLE
    colsample: float = T.GBT_COLSAMPLE
    seed: int = T.GBT_SEED


def boost_params(p: GBTParams) -> B.BoostParams:
    return B.BoostParams(**asdict(p))


def _fit_frame(train: DataFrame, spec: FeatureSpec, *keep: str) -> DataFrame:
    """slug, label, the feature columns and the columns to ``keep``."""
    return spec.featurize(train.withColumn("label", F.log("salary"))).select("slug", *keep, "label", *spec.columns)


class BoostedTrees:
    """The fitted trees as a model of a table: ``transform`` adds ``prediction``."""

    def __init__(self, boosted: B.BoostedModel):
        self.boosted = boosted

    def transform(self, df: DataFrame) -> DataFrame:
        return self.boosted.predict(df, "prediction")


@dataclass
class SalaryModel:
    spec: FeatureSpec
    model: BoostedTrees
    path: str | None = None

    def score(self, fct: DataFrame) -> DataFrame:
        """H12 batch scoring: predicted annualised minimum salary in EUR."""
        return (self.model.transform(self.spec.featurize(fct))
                .select("slug", F.exp("prediction").alias("predicted_min_eur")))


def save_spec(spark: SparkSession, spec: FeatureSpec, path: str) -> None:
    """The feature layout next to the model (one small JSON row)."""
    import json

    body = json.dumps({k: getattr(spec, k) for k in
                       ("skills", "top_cities", "city_levels", "role_levels", "sen_levels",
                        "lang_levels")})
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/feature_spec")


def load_model(spark: SparkSession, path: str) -> SalaryModel:
    """A saved model (trees + feature layout) back for scoring/explaining."""
    import json

    spec = FeatureSpec(**json.loads(spark.read.text(f"{path}/feature_spec").first()["value"]))
    return SalaryModel(spec, BoostedTrees(B.load(spark, f"{path}/pipeline")), f"{path}/pipeline")


def train_model(train: DataFrame, p: GBTParams | None = None, spec: FeatureSpec | None = None,
                save: bool = True) -> SalaryModel | None:
    """H7 + H10: fit on all rows when there are enough of them, else ``None``."""
    p = p or GBTParams()
    spec = spec or feature_spec(train)
    data = _fit_frame(train, spec)
    if data.count() < min_training_rows(spec):
        return None
    model = BoostedTrees(B.fit(data, "slug", "label", spec.columns, boost_params(p)))
    if not save:
        return SalaryModel(spec, model, None)
    root = scratch_path(train.sparkSession, "salary-model")
    B.save(train.sparkSession, model.boosted, f"{root}/pipeline")
    save_spec(train.sparkSession, spec, root)
    return load_model(train.sparkSession, root)


# -- H9 cross-validation -----------------------------------------------------

def cv_predictions(train: DataFrame, p: GBTParams | None = None, spec: FeatureSpec | None = None):
    """(repeat, fold, label, prediction) of every row by the model of the other folds.

    The models of a repeat are trained side by side.
    """
    p = p or GBTParams()
    spec = spec or feature_spec(train)
    folded, label, count, splits = assign_folds(train)
    path = scratch_path(train.sparkSession, "cv-rows")
    _fit_frame(folded, spec, "repeat", "fold").write.parquet(path)
    data = train.sparkSession.read.parquet(path)
    preds = []
    for rep in sorted({r for r, _ in splits}):
        part = data.filter(F.col("repeat") == rep)
        folds = [f for r, f in splits if r == rep]
        for f, m in enumerate(B.fit_folds(part, "slug", "label", spec.columns, "fold", len(folds), boost_params(p))):
            preds.append(m.predict(part.filter(F.col("fold") == f), "prediction").select(
                F.lit(rep).alias("repeat"), F.lit(f).alias("fold"), "label", "prediction"))
    out = preds[0]
    for q in preds[1:]:
        out = out.unionByName(q)
    return out, label, count, data


def cv_metrics(train: DataFrame, p: GBTParams | None = None,
               spec: FeatureSpec | None = None) -> DataFrame:
    """Mean per-split MAE (log scale) and R^2 (R^2 over splits with > 1 row).

    Like training, CV runs only when the H7 gate passes; otherwise the result is
    empty (no model, no metrics).
    """
    spec = spec or feature_spec(train)
    if train.count() < min_training_rows(spec):
        return train.sparkSession.createDataFrame(
            [], "mae_log double, r2 double, n_folds int, n_splits long")
    preds, label, count, _ = cv_predictions(train, p, spec)
    res = split_metrics(preds).withColumn(label, F.lit(count))
    return res.select("mae_log", "r2", label, "n_splits")


def split_metrics(preds: DataFrame) -> DataFrame:
    """Means over the splits of their MAE and R^2, from (repeat, fold, label, prediction)."""
    err = F.col("label") - F.col("prediction")
    per = preds.groupBy("repeat", "fold").agg(
        F.avg(F.abs(err)).alias("mae"),
        F.count(F.lit(1)).alias("n"),
        F.sum(err * err).alias("sse"),
        F.sum("label").alias("sy"), F.sum(F.col("label") * F.col("label")).alias("syy"))
    sst = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    per = per.withColumn("r2", F.when(F.col("n") > 1, F.lit(1.0) - F.col("sse") / F.nullif(sst, F.lit(0.0))))
    return per.agg(F.avg("mae").alias("mae_log"), F.avg("r2").alias("r2"), F.count(F.lit(1)).alias("n_splits"))


# -- H11 SHAP ------------------------------------------------------------------

def tree_table(sm: SalaryModel) -> tuple[list[dict], list[float]]:
    """Nodes of every tree (<= trees x 15), behind one leaf of the mean label that the trees start from."""
    boosted = sm.model.boosted
    cover = float(boosted.trees[0].rows[0]) if boosted.trees else 0.0
    out = [{0: {"value": boosted.base, "cover": cover, "left": -1, "right": -1, "feature": -1, "split": [], "ncat": -1}}]
    for t in boosted.trees:
        nodes, live = {}, [0]
        for i in live:
            f = int(t.feature[i])
            nodes[i] = {"value": float(t.value[i]), "cover": float(t.rows[i]),
                        "left": 2 * i + 1 if f >= 0 else -1, "right": 2 * i + 2 if f >= 0 else -1, "feature": f,
                        "split": [float(boosted.edges[f][t.cut[i]])] if f >= 0 else [], "ncat": -1}
            if f >= 0:
                live += [2 * i + 1, 2 * i + 2]
        out.append(nodes)
    return out, [1.0] * len(out)


def _leaf_paths(tree: dict) -> list[tuple[float, list[tuple[int, int, bool, float]]]]:
    """(leaf value, [(node, feature, went_left, cover ratio), ...]) per leaf."""
    out = []

    def walk(nid, path):
        n = tree[nid]
        if n["left"] < 0:
            out.append((n["value"], path))
            return
        for child, left in ((n["left"], True), (n["right"], False)):
            ratio = tree[child]["cover"] / n["cover"] if n["cover"] > 0 else 0.0
            walk(child, path + [(nid, n["feature"], left, ratio)])

    root = min(tree)
    walk(root, [])
    return out


def _goes_left(x: np.ndarray, split: list, ncat: int) -> np.ndarray:
    if ncat is not None and ncat >= 0:
        return np.isin(x, np.asarray(split))
    return x <= split[0]


class _Decisions(dict):
    """Per (feature, split) of a tree's inner node, which rows of ``X`` go left: worked out once for all trees."""

    def __init__(self, X: np.ndarray):
        self.X = X

    def of(self, tree: dict) -> dict[int, np.ndarray]:
        """Per inner node of ``tree``, which rows go left there."""
        out = {}
        for i, n in tree.items():
            if n["left"] >= 0:
                key = (n["feature"], tuple(n["split"]), n["ncat"])
                if key not in self:
                    self[key] = _goes_left(self.X[:, n["feature"]], n["split"], n["ncat"])
                out[i] = self[key]
        return out


def _listed(left: dict[int, np.ndarray]) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """(every combination of decisions at a tree's inner nodes, each row's place among them)."""
    every = np.arange(1 << len(left))
    code = np.zeros(len(next(iter(left.values()), ())), np.uint16)
    for k, goes in enumerate(left.values()):
        code |= np.left_shift(goes, k, dtype=np.uint16)
    return {i: (every >> k & 1).astype(bool) for k, i in enumerate(left)}, code.astype(np.intp)


def _tree_shapley(left: dict[int, np.ndarray], n: int, tree: dict) -> tuple[dict[int, np.ndarray], float]:
    """(Shapley values by feature, base value) of one tree, from the decisions of ``n`` rows.

    For one leaf, the path-dependent value function factorises over the
    features on its path: v(S) = value * prod_{j in S} a_j(x) * prod_{j not in
    S} b_j, with a_j = 1 if x follows every split on j along the path, and b_j
    the product of the cover ratios of those splits. Features off the path are
    null players, so each leaf is a game of <= depth players whose Shapley
    values are summed in closed form.
    """
    phi: dict[int, np.ndarray] = {}
    base = 0.0
    for value, path in _leaf_paths(tree):
        a: dict[int, np.ndarray] = {}
        b: dict[int, float] = {}
        for node, f, went_left, ratio in path:
            a[f] = a.get(f, 1.0) * (left[node] if went_left else ~left[node])
            b[f] = b.get(f, 1.0) * ratio
        base += value * math.prod(b.values())
        d = len(a)
        for i in a:
            others = [j for j in a if j != i]
            contrib = np.zeros(n)
            for size in range(len(others) + 1):
                coef = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
                for S in combinations(others, size):
                    term = np.ones(n)
                    for j in others:
                        term = term * (a[j] if j in S else b[j])
                    contrib += coef * term
            phi[i] = phi.get(i, 0.0) + value * (a[i] - b[i]) * contrib
    return phi, base


# inner nodes of a tree whose combinations of decisions are listed
MOST_LISTED = 10


def shap_values(X: np.ndarray, trees: list[dict], weights: list[float],
                known: dict[int, tuple] | None = None) -> tuple[np.ndarray, float]:
    """Exact path-dependent Shapley values of a tree ensemble: (phi, base value).

    Sums over leaves and trees are exact Shapley values of the ensemble (additivity). A
    tree's values depend on a row through its decisions at the inner nodes only, so
    they are worked out for every combination of decisions and looked up by row; a
    tree of more than ``MOST_LISTED`` inner nodes is worked out by row. ``known`` holds these
    tables from one call to the next.
    """
    n, m = X.shape
    phi = np.zeros((m, n))
    base = 0.0
    known = {} if known is None else known
    decisions = _Decisions(X)
    for i, (tree, w) in enumerate(zip(trees, weights)):
        left = decisions.of(tree)
        listed = 0 < len(left) <= MOST_LISTED and (i in known or n > 1 << len(left))
        if listed:
            rows, code = _listed(left)
            if i not in known:
                known[i] = _tree_shapley(rows, 1 << len(left), tree)
        values, b = known[i] if listed else _tree_shapley(left, n, tree)
        base += w * b
        for f, v in values.items():
            phi[f] += (w * v).take(code, mode="wrap") if listed else w * v
    return phi.T, base


def attributions(sm: SalaryModel, rows: DataFrame) -> DataFrame:
    """(slug, feature, value): the Shapley value of every feature on every row."""
    trees, weights = tree_table(sm)
    spec, cols, names = sm.spec, sm.spec.columns, sm.spec.names

    def per_batch(batches):
        known: dict[int, tuple] = {}
        for pdf in batches:
            phi, _ = shap_values(spec.unpacked(pdf), trees, weights, known)
            yield pd.DataFrame({"slug": np.repeat(pdf["slug"].to_numpy(), len(cols)),
                                "feature": np.tile(np.asarray(names, dtype=object), len(pdf)),
                                "value": phi.ravel()})

    return spec.packed(rows, "slug").mapInPandas(
        per_batch, "slug string, feature string, value double")


def mean_abs_shap(sm: SalaryModel, train: DataFrame) -> DataFrame:
    """Mean |SHAP| per feature over the training rows, top 25."""
    trees, weights = tree_table(sm)
    spec, cols = sm.spec, sm.spec.columns

    def per_batch(batches):
        known: dict[int, tuple] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            phi, _ = shap_values(spec.unpacked(pdf), trees, weights, known)
            yield pd.DataFrame({"feature_idx": np.arange(len(cols), dtype=np.int32),
                                "abs_sum": np.abs(phi).sum(axis=0),
                                "n": np.full(len(cols), len(pdf), dtype=np.int64)})

    parts = spec.packed(train).mapInPandas(
        per_batch, "feature_idx int, abs_sum double, n long")
    agg = parts.groupBy("feature_idx").agg((F.sum("abs_sum") / F.sum("n")).alias("importance"))
    named = agg.join(F.broadcast(sm.spec.names_frame(train.sparkSession)), "feature_idx")
    return top_k(named.select("feature", "importance"), T.TOP_DRIVERS,
                 [F.col("importance").desc()], ["feature"])


def model_gate(train: DataFrame) -> DataFrame:
    """H7: rows, features, rows that training needs, and whether it runs (one row)."""
    spec = feature_spec(train)
    need = min_training_rows(spec)
    return train.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(spec.names)).cast("long").alias("n_features"),
        F.lit(need).cast("long").alias("min_rows"), (F.col("n_rows") >= need).alias("trains"))


def _tree_predictions(x: np.ndarray, trees: list[dict], weights: list[float]) -> np.ndarray:
    """The ensemble's prediction from the saved node table."""
    out = np.zeros(len(x))
    decisions = _Decisions(x)
    for tree, w in zip(trees, weights):
        left = decisions.of(tree)
        listed = 0 < len(left) <= MOST_LISTED
        rows, code = _listed(left) if listed else (left, None)
        value_of = np.zeros(1 << len(left) if listed else len(x))
        for value, path in _leaf_paths(tree):
            here = np.ones(len(value_of), bool)
            for node, _, went_left, _ in path:
                here &= rows[node] if went_left else ~rows[node]
            value_of[here] = w * value
        out += value_of.take(code, mode="wrap") if listed else value_of
    return out


def model_checks(sm: SalaryModel, train: DataFrame, tol: float = 1e-6) -> DataFrame:
    """H10-H12 held against each other on every training row (one row of counts).

    ``n_shap_off``: rows whose SHAP values and base do not add up to the prediction;
    ``n_trees_off``: rows whose prediction differs from the saved trees' own;
    ``n_scores_off``: rows whose score is not exp of the prediction.
    """
    trees, weights = tree_table(sm)
    spec = sm.spec
    words = spec.packed(train).columns
    scored = spec.packed(sm.model.transform(spec.featurize(train)), "slug", "prediction")
    scores = sm.score(train).withColumnRenamed("slug", "_slug")
    both = scored.join(scores, F.col("slug") == F.col("_slug")).select(*words, "prediction", "predicted_min_eur")

    def per_batch(batches):
        known: dict[int, tuple] = {}
        for pdf in batches:
            x, p = spec.unpacked(pdf), pdf["prediction"].to_numpy()
            phi, base = shap_values(x, trees, weights, known)
            score = pdf["predicted_min_eur"].to_numpy()
            yield pd.DataFrame({
                "n": [len(p)], "s": [int((np.abs(phi.sum(axis=1) + base - p) > tol).sum())],
                "t": [int((np.abs(_tree_predictions(x, trees, weights) - p) > tol).sum())],
                "e": [int((np.abs(score - np.exp(p)) > tol * score).sum())]})

    parts = both.mapInPandas(per_batch, "n long, s long, t long, e long")
    return parts.agg(F.sum("n").alias("n_rows"), F.sum("s").alias("n_shap_off"),
                     F.sum("t").alias("n_trees_off"), F.sum("e").alias("n_scores_off"))


def quality_report(sm: SalaryModel, train: DataFrame, p: GBTParams | None = None) -> DataFrame:
    """Cross-validation errors, fold count and the importance table in one (section, name, value)."""
    m = cv_metrics(train, p, sm.spec)
    label = m.columns[2]
    metrics = m.select(F.lit("metric").alias("section"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
        for c in ("mae_log", "r2", label)])).alias("e")).select("section", "e.*")
    drivers = mean_abs_shap(sm, train).select(
        F.lit("driver").alias("section"), F.col("feature").alias("name"), F.col("importance").alias("value"))
    return metrics.unionByName(drivers)
