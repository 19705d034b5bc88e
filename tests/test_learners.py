"""Shapley values against brute force, parameter mapping, search draws."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodemark.operators import encode as E
from lodemark.operators import learners as L
from lodemark.operators import explain
from lodemark.operators.explain import paths_of, shapley_values


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(600).selectExpr(
        "id", "cast(id % 13 as double) A", "cast(id % 7 as double) B", "cast(id % 5 as double) C",
        "cast(id % 13 > 6 and id % 7 < 4 or id % 5 = 0 as int) Y", "cast(id % 3 as int) M").persist()


CONTRACT = E.Contract((E.Feature("A", "A", E.NUM), E.Feature("B", "G", E.CAT_OHE), E.Feature("C", "G", E.CAT_OHE)))


def brute_force(x, by_length, features: int):
    def expected(known):
        total = 0.0
        for paths in by_length:
            for k, value in enumerate(paths.value):
                weight = 1.0
                for f, low, high, kept in zip(paths.features[k], paths.low[k], paths.high[k], paths.kept[k]):
                    weight *= float((low == -math.inf or x[f] > low) and x[f] <= high) if f in known else kept
                total += weight * value[0]
        return total

    phi = np.zeros(features)
    for f in range(features):
        others = [g for g in range(features) if g != f]
        for size in range(features):
            for subset in itertools.combinations(others, size):
                w = math.factorial(size) * math.factorial(features - size - 1) / math.factorial(features)
                phi[f] += w * (expected({*subset, f}) - expected(set(subset)))
    return phi


def test_tree_shapley_values_match_brute_force(rows):
    model = L.fit(rows, "Y", CONTRACT, "xgboost", {"n_estimators": 4, "max_depth": 4}, 1, "regression", 600)
    leaves = L.leaves(model, "regression")
    paths = paths_of(leaves.table.toArrow())
    x = rows.limit(40).select("A", "B", "C").toPandas().to_numpy()
    got = shapley_values(x, paths)
    for i in range(len(x)):
        assert got[i] == pytest.approx(brute_force(x[i], paths, 3), abs=1e-9)
    said = [r["prediction"] for r in model.transform(rows.limit(40)).select("prediction").collect()]
    assert got.sum(axis=1) + leaves.base()[0] == pytest.approx(said, abs=1e-9)


def test_blocks_of_rows_and_leaves_add_up_to_the_whole(rows, monkeypatch):
    """A forest and a booster of three classes, cut into many blocks, explain every row as they do in one."""
    for algorithm, params in (("random_forest", {"n_estimators": 6, "max_depth": 4}), ("xgboost", {"n_estimators": 4, "max_depth": 3})):
        model = L.fit(rows, "M", CONTRACT, algorithm, params, 1, "multiclass", 600)
        scored = L.score(model, rows, "multiclass").persist()
        whole, sources = L.contributions(model, scored, CONTRACT, {}, "multiclass")
        monkeypatch.setattr(explain, "LEAVES_AT_ONCE", 5)
        monkeypatch.setattr(explain, "FEATURES_AT_ONCE", 60)
        assert max(L.leaves(model, "multiclass").blocks) > 2
        cut, _ = L.contributions(model, scored, CONTRACT, {}, "multiclass")
        monkeypatch.undo()
        want = {r["id"]: r["PHI"] for r in whole.select("id", "PHI").collect()}
        got = {r["id"]: r["PHI"] for r in cut.select("id", "PHI").collect()}
        assert sources == ["A", "G"] and len(want) == 600 and got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want) and any(v != [0.0, 0.0] for v in want.values())


def test_rows_without_a_class_and_empty_tables_are_explained(rows):
    """A row without a predicted class has zeros; a table without rows stays empty and keeps its columns."""
    model = L.fit(rows, "M", CONTRACT, "xgboost", {"n_estimators": 2, "max_depth": 2}, 1, "multiclass", 600)
    scored = L.score(model, rows.limit(20), "multiclass").withColumn("YHAT", F.when(F.col("id") > 9, F.col("YHAT")))
    explained, _ = L.contributions(model, scored, CONTRACT, {}, "multiclass")
    assert explained.where("id <= 9 AND PHI = array(0d, 0d)").count() == 10 and explained.count() == 20
    empty, _ = L.contributions(model, scored.where("false"), CONTRACT, {}, "multiclass")
    assert empty.columns == [*scored.columns, "PHI"] and empty.isEmpty()


def test_linear_contributions_explain_the_margin(rows):
    model = L.fit(rows, "Y", CONTRACT, "logistic_regression", {"C": 1.0, "max_iter": 50}, 1, "binary", 600)
    means = L.training_means(rows, CONTRACT)
    scored = L.score(model, rows, "binary")
    scored, sources = L.contributions(model, scored, CONTRACT, means, "binary")
    assert sources == ["A", "G"]
    w, b = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    base = b + sum(c * means[n] for c, n in zip(w, "ABC"))
    off = F.abs(F.aggregate("PHI", F.lit(0.0), lambda x, y: x + y) + base - F.log(F.col("SCORE") / (1 - F.col("SCORE"))))
    assert scored.agg(F.max(off)).first()[0] < 1e-9


def test_multiclass_explains_the_predicted_class(rows):
    for algorithm, params in (("xgboost", {"n_estimators": 2, "max_depth": 2}), ("logistic_regression", {"max_iter": 10})):
        model = L.fit(rows, "M", CONTRACT, algorithm, params, 1, "multiclass", 600)
        scored = L.score(model, rows, "multiclass")
        causes = L.causes(model, scored, CONTRACT, L.training_means(rows, CONTRACT), "multiclass", 2)
        got = causes.select("SCORE", "YHAT", F.col("PROBABLE_CAUSES").alias("c")).collect()
        assert all(1 / 3 - 1e-9 <= r["SCORE"] <= 1 and r["YHAT"] in (0, 1, 2) for r in got)
        assert any(r["c"] for r in got)


def test_parameter_names_map_to_spark():
    booster = L.build_estimator("lightgbm", {"num_leaves": 31, "min_child_samples": 25, "subsample": 0.7, "colsample_bytree": 0.5,
                                             "learning_rate": 0.03, "n_estimators": 12, "reg_lambda": 3.0, "reg_alpha": 0.1}, 5, "binary", 10)
    assert (booster.depth, booster.min_rows, booster.subsample, booster.features) == (5, 25, 0.7, "0.5")
    assert (booster.learning_rate, booster.rounds, booster.reg_lambda, booster.reg_alpha, booster.metric) == (0.03, 12, 3.0, 0.1, None)
    assert L.build_estimator("xgboost", {}, 5, "binary", 10).metric == "aucpr"
    forest = L.build_estimator("random_forest", {"n_estimators": 9, "max_features": "log2", "min_samples_leaf": 5}, 5, "regression", 10)
    assert (forest.getNumTrees(), forest.getFeatureSubsetStrategy(), forest.getMinInstancesPerNode()) == (9, "log2", 5)
    linear = L.build_estimator("logistic_regression", {"C": 0.5, "max_iter": 30}, 5, "binary", 100)
    assert linear.getRegParam() == pytest.approx(0.02) and linear.getElasticNetParam() == 0.0
    with pytest.raises(ValueError):
        L.build_estimator("svm", {}, 1, "binary", 1)


def test_trial_draws_repeat_and_weight_only_binary():
    space = L.SEARCH_SPACE["xgboost"]
    a = L.trial_params(space, 20, 42, "binary", 9.0)
    assert a == L.trial_params(space, 20, 42, "binary", 9.0)
    assert {p["scale_pos_weight"] for p in a} <= {1.0, 3.0, 9.0}
    assert all("scale_pos_weight" not in p for p in L.trial_params(space, 5, 42, "regression", 9.0))
    assert all(p[k] in space[k] for p in a for k in space if k != "use_scale_pos_weight")


def test_balanced_weights_and_early_stopping(rows):
    weights = L.balanced_weights(rows, "Y")
    counts = {r["Y"]: r["count"] for r in rows.groupBy("Y").count().collect()}
    assert weights == {float(y): pytest.approx(600 / (2 * n)) for y, n in counts.items()}
    model = L.fit(rows, "Y", CONTRACT, "xgboost", {"n_estimators": 15, "max_depth": 2}, 1, "binary", 400, F.col("id") >= 400)
    assert 1 <= L.rounds_used(model) <= 15


@pytest.mark.parametrize("algorithm,task,params", [("xgboost", "multiclass", {"n_estimators": 3, "max_depth": 3}),
                                                   ("random_forest", "multiclass", {"n_estimators": 4, "max_depth": 4}),
                                                   ("lightgbm", "regression", {"n_estimators": 3, "num_leaves": 15})])
def test_rows_stream_past_few_leaves(rows, monkeypatch, algorithm, task, params):
    """Without an exchange or a join, every row is told what blocks of rows and leaves tell; a row without a class has zeros."""
    model = L.fit(rows, "M", CONTRACT, algorithm, params, 1, task, 600)
    scored = L.score(model, rows, task).withColumn("YHAT", F.when(F.col("id") % 50 > 0, F.col("YHAT")))
    streamed, _ = L.contributions(model, scored, CONTRACT, {}, task)
    plan = streamed._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "CoGroup" not in plan and streamed.columns == [*scored.columns, "PHI"]
    monkeypatch.setattr(explain, "FEW_LEAVES", 0)
    blocks, _ = L.contributions(model, scored, CONTRACT, {}, task)
    want = {r["id"]: r["PHI"] for r in blocks.select("id", "PHI").collect()}
    got = {r["id"]: r["PHI"] for r in streamed.select("id", "PHI").collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_tabled_leaves_say_what_single_rows_say():
    """Leaves in tables of any number of comparisons, down to none, against the sums row by row; NaN goes right."""
    draw = np.random.default_rng(5)
    n, d = 30, 3
    features = np.sort(np.array([draw.choice(6, d, replace=False) for _ in range(n)]), axis=1)
    edge = draw.normal(size=(n, d)).round(1)
    low = np.where(draw.random((n, d)) < 0.5, -math.inf, edge)
    high = np.where((draw.random((n, d)) < 0.5) & (low > -math.inf), math.inf, edge + 0.3)
    paths = [explain.Paths(features, low, high, draw.random((n, d)) * 0.8 + 0.1, draw.normal(size=(n, 2)))]
    x = draw.normal(size=(400, 6)).round(1)
    x[3, 2] = math.nan
    pick = draw.integers(0, 2, 400)
    for p in (None, pick):
        want = explain.Prepared.of(paths, 0).explain(x, p)
        for most in (3, 6, 10):
            prepared = explain.Prepared.of(paths, most)
            assert prepared.tables and np.allclose(prepared.explain(x, p), want, atol=1e-12)
        assert np.allclose(shapley_values(x, paths, p), want, atol=1e-12)
