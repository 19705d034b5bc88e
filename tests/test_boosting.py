"""Boosting: leaf values against SQL sums, going on against one fit, the stop against the recorded losses, joint classes."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lodemark.operators import boosting
from lodemark.operators import encode as E
from lodemark.operators import learners as L
from lodemark.operators.boosting import FEATURES, LABEL, MARGINS, VALIDATES, WEIGHT, Booster, BoosterSpec, _derivatives, _loss, best_round, leaf_value, probabilities

CONTRACT = E.Contract(tuple(E.Feature(c, c, E.NUM) for c in "ABC"))


@pytest.fixture(scope="module")
def rows(spark):
    noisy = spark.range(1200).withColumn("U", F.abs(F.xxhash64("id")) % 1000)
    return noisy.selectExpr(
        "id", "cast(id % 13 as double) A", "cast(id % 7 as double) B", "cast(id % 5 as double) C",
        "cast((id % 13 > 6 and id % 7 < 4) <> (U < 120) as int) Y", "cast(if(U < 200, U % 3, id % 13 div 5) as int) M",
        "id % 13 * 2.0 - id % 7 + U / 1000 R", "id % 4 = 0 HELD").persist()


def booster_data(rows, label):
    return VectorAssembler(inputCols=["A", "B", "C"], outputCol=FEATURES).transform(rows).select(
        FEATURES, F.col(label).cast("double").alias(LABEL), F.col("HELD").alias(VALIDATES), (1 + F.col("C") / 10).alias(WEIGHT))


def test_leaf_values_are_newton_steps_with_penalties(rows):
    spec = BoosterSpec(rounds=1, depth=2, reg_lambda=3.0, reg_alpha=2.0, learning_rate=0.5)
    booster = Booster(booster_data(rows, "Y"), "binary", 2, spec)
    base = booster.base[0]
    booster.grow(1)
    tree = booster.trees[0][0]
    tree.setPredictionCol("_P")
    rows_with_leaf = tree.transform(booster.rows.where(f"NOT {VALIDATES}"))
    p = 1 / (1 + math.exp(-base))
    twin = rows_with_leaf.selectExpr("_L0", f"({p} - {LABEL}) * {WEIGHT} g", f"{p * (1 - p)} * {WEIGHT} h").groupBy("_L0").agg(
        F.expr("-sign(sum(g)) * greatest(abs(sum(g)) - 2.0, 0) / (sum(h) + 3.0) v")).collect()
    assert len(twin) >= 3
    for r in twin:
        assert booster.values[0][0][int(r["_L0"])] == pytest.approx(r["v"], abs=1e-9)
    assert leaf_value(1.5, 4.0, spec) == 0.0 and leaf_value(-12.0, 2.0, spec) == 2.0


def test_going_on_equals_one_fit_and_the_models_say_the_margins(rows):
    data = booster_data(rows, "M")
    spec = BoosterSpec(rounds=6, depth=2, reg_lambda=1.0, subsample=1.0, seed=3)
    once = Booster(data, "multiclass", 3, spec)
    once.grow(6)
    first = Booster(data, "multiclass", 3, spec)
    first.grow(3)
    second = Booster(data, "multiclass", 3, spec, start=first.models())
    second.grow(3)
    assert second.rounds == 6 and second.losses == pytest.approx(once.losses[3:], rel=1e-6)
    for k, model in enumerate(second.models()):
        assert model.getNumTrees == 7
        off = F.abs(F.col(model.getPredictionCol()) - F.col("_MARGINS")[k])
        assert model.transform(second.rows).agg(F.max(off)).first()[0] < 1e-9
    shorter = once.models(2)
    assert [m.getNumTrees for m in shorter] == [3, 3, 3]


@pytest.mark.parametrize("task,label", [("binary", "Y"), ("multiclass", "M"), ("regression", "R")])
def test_the_stop_follows_the_losses_for_every_task(rows, task, label):
    spec = BoosterSpec(rounds=30, depth=3, learning_rate=0.9)
    booster = Booster(booster_data(rows, label), task, 3, spec)
    best = booster.grow_with_patience(4)
    assert best == best_round(booster.losses, 4)[0] and booster.losses[best - 1] == min(booster.losses[:best + 4])
    assert booster.rounds == len(booster.losses) <= 30
    if task != "regression":
        assert booster.rounds < 30  # noise cannot be learned, so it stops


def test_average_precision_as_the_measure(rows):
    booster = Booster(booster_data(rows, "Y"), "binary", 2, BoosterSpec(rounds=3, depth=3, metric="aucpr"))
    booster.grow(3)
    assert all(-1 <= v < -0.3 for v in booster.losses) and len(booster.losses) == 3


def test_joint_classes_beat_one_against_the_rest(rows):
    """Log-loss of three joint margins against three binary boosters whose chances are scaled to one."""
    data = booster_data(rows, "M").drop(VALIDATES)
    spec = BoosterSpec(rounds=4, depth=3, learning_rate=0.9)
    joint = Booster(data, "multiclass", 3, spec)
    joint.grow(4)
    chances = data.withColumn("ID", F.monotonically_increasing_id())
    for k in range(3):
        one = Booster(data.withColumn(LABEL, (F.col(LABEL) == k).cast("double")), "binary", 2, spec)
        one.grow(4)
        chances = one.models()[0].setPredictionCol(f"P{k}").transform(chances).withColumn(f"P{k}", 1 / (1 + F.exp(-F.col(f"P{k}"))))
    own = F.element_at(F.array("P0", "P1", "P2"), F.col(LABEL).cast("int") + 1)
    rest = chances.agg(F.avg(-F.log(own / (F.col("P0") + F.col("P1") + F.col("P2"))))).first()[0]
    assert joint.rows.agg(F.avg(_loss(F.col(MARGINS), "multiclass"))).first()[0] < rest


def test_a_pipeline_goes_on_and_is_saved(rows, tmp_path):
    params = {"n_estimators": 3, "max_depth": 2, "eval_metric": "logloss", "scale_pos_weight": 2.0}
    model = L.fit(rows, "Y", CONTRACT, "xgboost", params, 1, "binary", 1200)
    more = L.more_rounds(model, rows, "Y", "xgboost", {**params, "n_estimators": 5}, 1, "binary")
    assert (L.rounds_used(model), L.rounds_used(more)) == (3, 5)
    whole = L.fit(rows, "Y", CONTRACT, "xgboost", {**params, "n_estimators": 5}, 1, "binary", 1200)
    more.write().save(f"{tmp_path}/m")
    back = type(more).load(f"{tmp_path}/m")
    scores = [{r["id"]: r["SCORE"] for r in L.score(m, rows, "binary").select("id", "SCORE").collect()} for m in (whole, back)]
    assert all(scores[0][k] == pytest.approx(scores[1][k], rel=1e-9) for k in scores[0])


def test_hostile_rows(spark):
    data = spark.createDataFrame([(1.0, 1.0, 1.0, 0)] * 6, "A double, B double, C double, Y int")
    model = L.fit(data, "Y", CONTRACT, "lightgbm", {"n_estimators": 2}, 1, "binary", 6)
    assert all(0 < r["SCORE"] < 0.01 for r in L.score(model, data, "binary").collect())
    same = L.fit(data, "Y", CONTRACT, "xgboost", {"n_estimators": 2}, 1, "multiclass", 6)
    assert {(r["YHAT"], r["SCORE"]) for r in L.score(same, data, "multiclass").collect()} == {(0, 1.0)}


def test_class_chances_are_computed_once_a_row(spark):
    """An exponential inside a lambda of another would be computed for every pair of classes, and again by every derivative."""
    margins = [[1.0, 2.0, -800.0], [0.5], [700.0, 700.0, 699.0, -5.0]]
    found = spark.createDataFrame([(m,) for m in margins], "_MARGINS array<double>").select(probabilities(F.col(MARGINS), "multiclass").alias("P"))
    for m, r in zip(margins, found.collect()):
        weights = [math.exp(v - max(m)) for v in m]
        assert r["P"] == pytest.approx([w / sum(weights) for w in weights], rel=1e-12)
    plan = str(probabilities(F.col(MARGINS), "multiclass")).lower()
    assert plan.count("exp(") == 1 and plan.count("array_max(") == 1
    assert not any("exp(" in str(d).lower() for k in range(3) for d in _derivatives("multiclass", k, 3))


def blocks_of(booster):
    """Margins of the blocks, by bins and label."""
    out = {}
    for block in boosting._blocks(booster.blocks.toArrow().combine_chunks().to_batches()[0], booster.classes):
        for i in range(len(block.label)):
            out.setdefault((tuple(block.bins[:, i].tolist()), block.label[i], block.held), []).append(block.margins[:, i])
    return out


@pytest.mark.parametrize("task,label,spec", [
    ("binary", "Y", BoosterSpec(depth=3, reg_lambda=1.0)), ("multiclass", "M", BoosterSpec(depth=2, subsample=0.7, features="0.7")),
    ("regression", "R", BoosterSpec(depth=7, min_rows=3, reg_alpha=0.1))])
def test_blocks_hold_the_margins_that_the_models_say(rows, task, label, spec):
    """Over rows of every kind, rows that neither fit nor validate left out."""
    data = booster_data(rows, label)
    neither = data.limit(5).withColumn(VALIDATES, F.lit(None).cast("boolean"))
    booster = Booster(data.unionByName(neither), task, 3, spec)
    booster.grow(7)
    kept = blocks_of(booster)
    assert sum(map(len, kept.values())) == 1200
    want = sorted(tuple(round(v, 9) for v in r[MARGINS]) for r in booster.rows.where(f"{VALIDATES} IS NOT NULL").select(MARGINS).collect())
    assert sorted(tuple(round(v, 9) for v in m.tolist()) for each in kept.values() for m in each) == want


def test_a_level_is_one_pass(rows, monkeypatch):
    """A round of depth d with three classes reads the rows d times, not once per class and step."""
    booster = Booster(booster_data(rows, "M"), "multiclass", 3, BoosterSpec(depth=3))
    passes = []
    monkeypatch.setattr(booster, "_sums", lambda *a, own=booster._sums: passes.append(len(a[2])) or own(*a))
    booster.grow(2)
    assert len(passes) <= 6 and passes[0] == 3


def test_cuts_bins_and_splits_against_plain_sums():
    draw = np.random.default_rng(1)
    values = np.round(draw.normal(size=5000), 2)
    cuts = boosting.cuts_of(values, np.ones(5000))
    assert 20 < len(cuts) < boosting.MAX_BINS and (np.diff(cuts) > 0).all()
    bins = boosting.bin_of(np.append(values, np.nan), cuts)
    assert all((values[bins[:-1] <= j] <= cuts[j]).all() and (values[bins[:-1] > j] > cuts[j]).all() for j in range(len(cuts))) and bins[-1] == len(cuts)
    assert boosting.cuts_of(np.array([1.0, 1.0, np.nan]), np.ones(3)).size == 0 and boosting.cuts_of(np.array([3.0, 1.0]), np.ones(2)).tolist() == [2.0]
    assert boosting.bin_of(np.array([1.0, 2.0, 3.0, np.nan]), np.array([2.0])).tolist() == [0, 0, 1, 1]
    g, h = draw.normal(size=5000), draw.random(5000)
    sums = np.array([[np.bincount(bins[:-1], v, 32)] for v in (g, h, np.ones(5000))])
    f, j, gain, left, right = boosting.best_split(sums, np.array([len(cuts) + 1]), 5, None)
    step, best = -g / h, -1
    for c in range(len(cuts)):
        side = bins[:-1] <= c
        around = lambda m: (h[m] * (step[m] - (h[m] * step[m]).sum() / h[m].sum()) ** 2).sum()
        if min(side.sum(), (~side).sum()) >= 5:
            best = max(best, (around(side | True) - around(side) - around(~side)) / h.sum())
    assert gain == pytest.approx(best, rel=1e-9) and left[2] + right[2] == 5000


def test_rows_to_fit_on_are_complete(rows):
    """As Spark's own trees do, a fit refuses features, labels and weights that are no numbers; rows that validate may hold them."""
    data = booster_data(rows, "R")
    for name, value in ((LABEL, math.nan), (WEIGHT, -1.0)):
        with pytest.raises(Exception, match="must be finite"):
            Booster(data.withColumn(name, F.when(~F.col(VALIDATES), value).otherwise(F.col(name))), "regression", 1, BoosterSpec())
    spoilt = VectorAssembler(inputCols=["A", "X"], outputCol=FEATURES, handleInvalid="keep")
    wide = lambda held: spoilt.transform(rows.withColumn("X", F.when(F.col("HELD") == held, math.nan).otherwise(F.col("B")))).select(
        FEATURES, F.col("R").alias(LABEL), F.col("HELD").alias(VALIDATES))
    with pytest.raises(Exception, match="must be finite"):
        Booster(wide(False), "regression", 1, BoosterSpec())
    booster = Booster(wide(True), "regression", 1, BoosterSpec(depth=2))
    booster.grow(1)
    assert math.isfinite(booster.losses[0])
