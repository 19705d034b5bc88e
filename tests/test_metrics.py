import math

import pytest
from pyspark.sql import functions as F

from lodemark.operators import metrics as M
from lodemark.operators import monitoring as W
from lodemark.operators.outcomes import OutcomeRule, synthetic_outcomes


def test_average_precision_is_step_wise(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (2, 0.8, 0), (3, 0.8, 1), (4, 0.3, 0), (5, 0.1, 1)], "id int, s double, y int")
    m = M.ranking_metrics(df, "y", "s").first()
    assert m["pr_auc"] == pytest.approx(0.7556, abs=1e-4) and m["roc_auc"] == pytest.approx(0.5833, abs=1e-4)


def test_single_class_gives_zero_precision_and_no_auc(spark):
    df = spark.createDataFrame([(0.9, 0), (0.1, 0)], "s double, y int")
    m = M.ranking_metrics(df, "y", "s").first()
    assert m["pr_auc"] == 0.0 and m["roc_auc"] is None
    c = M.confusion_metrics(df.withColumn("yhat", F.lit(0)), "y", "yhat").first()
    assert (c["accuracy"], c["precision"], c["recall"], c["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_macro_metrics_count_classes_seen_only_as_predictions(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "c")], "y string, p string")
    m = M.macro_metrics(df, "y", "p").first()
    assert m["f1_macro"] == pytest.approx((2 / 3 + 0 + 0) / 3) and m["recall_macro"] == pytest.approx(0.5 / 3)


def table(spark, **columns):
    names = list(columns)
    rows = [(m, *[float(columns[n][i]) for n in names]) for i, m in enumerate(("old", "new"))]
    return spark.createDataFrame(rows, "model string, " + ", ".join(f"{n} double" for n in names))


def test_promotion_gate_is_strict(spark):
    gate = lambda recall, pr: M.promotion_gate(table(spark, pr_auc=(0.5, pr), roc_auc=(0.5, 0.5), recall_at_decile=(0.4, recall)),
                                               "old", "new", "binary", 25.0, 10.0).first()["promote"]
    assert gate(0.6, 0.5) and not gate(0.5, 0.5) and not gate(0.6, 0.3)
    zero = M.promotion_gate(table(spark, rmse=(0.0, 0.0), r2=(1.0, 1.0)), "old", "new", "regression", 5.0, 10.0).first()
    assert not zero["promote"] and zero["rmse_delta_pct"] == 0.0


def test_gates_name_the_first_reason(spark):
    few = spark.createDataFrame([(1,), (0,)], "y int")
    reason = lambda *a: M.retrain_gates(*a).first()["SKIP_REASON"]
    assert reason(few, few, "y", "binary", 3, 1) == "too few labeled rows to compare on"
    assert reason(few, few, "y", "binary", 2, 2) == "too few positives to compare on"
    assert reason(few.where("y = 1"), few, "y", "multiclass", 1, 0) == "all comparison rows are of one class"
    assert reason(few, few.where("y > 1"), "y", "regression", 1, 0) == "nothing is left to fit a challenger"
    assert reason(few, few, "y", "binary", 2, 1) is None


def test_drift_bins_include_their_upper_edge(spark):
    base = spark.createDataFrame([(float(i),) for i in range(1, 101)], "PREDICTED_PROBABILITY double")
    reference = W.baseline_bins(base, "PREDICTED_PROBABILITY")
    assert reference.edges == tuple(float(10 * i) for i in range(1, 10)) and set(reference.shares) == {0.1}
    same = base.selectExpr("*", "timestamp_ntz'2024-01-01 05:00:00' SCORED_AT", "'V' MODEL_VERSION", "1 PREDICTION", "cast(null as bigint) ACTUAL_LABEL")
    report = W.drift_windows(same, reference, "binary").first()
    assert report["N"] == 100 and report["PSI"] == pytest.approx(0.0, abs=1e-12) and report["ACCURACY"] is None
    moved = W.drift_windows(same.where("PREDICTED_PROBABILITY <= 10"), reference, "binary").first()
    assert moved["PSI"] > 5 and math.isfinite(moved["PSI"])


def test_schema_and_feature_parity(spark):
    a, b = spark.createDataFrame([], "K int, X int, y int"), spark.createDataFrame([], "k int, Y int, Z int")
    assert [tuple(r) for r in W.schema_parity(a, b).collect()] == [("X", "left only"), ("Z", "right only")]
    assert W.feature_parity(["K", "F1", "F9", "SCORED_AT"], ["K"], ["F1", "F2"]) == {"extra": ["F9"], "missing": ["F2"]}


def test_simulated_outcomes_of_one_entity(spark):
    feed = spark.createDataFrame([(1, 1, 3.0)], "k int, t int, v double")
    row = synthetic_outcomes(feed, "k", "t", [], OutcomeRule({"v": 1.0}, {"v > 2": 0.5})).first()
    assert row["OUTCOME"] == 1


def test_simulated_outcomes_match_the_window_form(spark):
    feed = spark.range(2000).selectExpr("id k", "1 t", "cast(id % 17 as double) v", "cast(hash(id) % 100 as double) w")
    got = synthetic_outcomes(feed, "k", "t", [], OutcomeRule({"v": 1.0, "w": 0.5}, {"w < 0": 0.35}, rate=0.01), rows_per_slice=150)
    got.createOrReplaceTempView("simulated")
    flags = spark.sql("select OUTCOME, percent_rank() over (order by SYNTHETIC_SCORE desc) < 0.01 f from simulated")
    assert flags.where("OUTCOME = 1").count() == 20 and flags.where("(OUTCOME = 1) <> f").count() <= 1  # score is rounded here
