"""Evaluation as aggregations over a scored table, and the promotion gate.

Ranking metrics fold the rows to one per distinct score first, then use running totals; ties therefore count as one
step, exactly as in the textbook definitions of average precision and ROC AUC.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodemark.functions.columns import at_least, col
from lodemark.operators.ranking import SLICE_ROWS, running_totals, top_decile
from lodemark.settings import BINARY, MULTICLASS, REGRESSION

TINY = 1e-9


def _ratio(top: Column, bottom: Column) -> Column:
    """Zero where the denominator is zero."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def regression_metrics(scored: DataFrame, y: str, yhat: str) -> DataFrame:
    """rmse, mae, r2 in one aggregate; the spread comes from Spark's own centred variance, not from raw squares."""
    error = col(yhat) - col(y)
    return scored.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(col(y)))).alias("r2"))


def confusion_metrics(scored: DataFrame, y: str, yhat: str) -> DataFrame:
    """Accuracy, precision, recall and f1 of class 1."""
    counts = scored.agg(
        F.count("*").alias("n"),
        F.count_if(col(y) == col(yhat)).alias("hit"),
        F.count_if((col(y) == 1) & (col(yhat) == 1)).alias("tp"),
        F.count_if(col(yhat) == 1).alias("flagged"),
        F.count_if(col(y) == 1).alias("positive"))
    rates = counts.select(_ratio(F.col("hit"), F.col("n")).alias("accuracy"),
                          _ratio(F.col("tp"), F.col("flagged")).alias("precision"),
                          _ratio(F.col("tp"), F.col("positive")).alias("recall"))
    return rates.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def class_report(scored: DataFrame, y: str, yhat: str) -> DataFrame:
    """Precision, recall, f1 and support per class seen in either column, from the table of (actual, predicted) counts."""
    pairs = scored.groupBy(col(y).alias("y"), col(yhat).alias("yhat")).agg(F.count("*").alias("n"))
    sides = pairs.select("n", F.explode(F.array(
        F.struct(F.col("y").alias("CLASS"), F.lit(1).alias("actual"), F.lit(0).alias("guess")),
        F.struct(F.col("yhat").alias("CLASS"), F.lit(0).alias("actual"), F.lit(1).alias("guess")))).alias("side"),
        (F.col("y") == F.col("yhat")).alias("hit"))
    per_class = sides.groupBy(F.col("side.CLASS").alias("CLASS")).agg(
        F.sum(F.col("n") * F.col("side.actual")).alias("SUPPORT"),
        F.sum(F.col("n") * F.col("side.guess")).alias("GUESSED"),
        F.sum(F.when(F.col("hit"), F.col("n") * F.col("side.actual")).otherwise(0)).alias("HIT"))
    rates = per_class.select("CLASS", _ratio(F.col("HIT"), F.col("GUESSED")).alias("PRECISION"),
                             _ratio(F.col("HIT"), F.col("SUPPORT")).alias("RECALL"), "SUPPORT")
    return rates.select("CLASS", "PRECISION", "RECALL", _f1(F.col("PRECISION"), F.col("RECALL")).alias("F1"), "SUPPORT")


def macro_metrics(scored: DataFrame, y: str, yhat: str) -> DataFrame:
    report = class_report(scored, y, yhat)
    return report.agg(F.avg("F1").alias("f1_macro"), F.avg("PRECISION").alias("precision_macro"),
                      F.avg("RECALL").alias("recall_macro"))


def ranking_metrics(scored: DataFrame, y: str, score: str, rows_per_slice: int = SLICE_ROWS) -> DataFrame:
    """pr_auc (step-wise average precision) and roc_auc (Mann–Whitney, a tie counts half)."""
    positive, negative = col(y).cast("bigint"), (1 - col(y)).cast("bigint")
    steps = running_totals(scored, score, {"POS": F.sum(positive), "NEG": F.sum(negative)}, descending=True,
                           rows_per_slice=rows_per_slice)
    sums = steps.agg(
        F.sum("POS").alias("p"), F.sum("NEG").alias("n"),
        F.sum(F.col("POS") * (F.col("RUN_POS") / (F.col("RUN_POS") + F.col("RUN_NEG")))).alias("precisions"),
        F.sum(F.col("POS") * (F.col("RUN_NEG") - 0.5 * F.col("NEG"))).alias("lost"))
    return sums.select(_ratio(F.col("precisions"), F.col("p")).alias("pr_auc"),
                       (1 - F.try_divide(F.col("lost"), F.col("p").cast("double") * F.col("n"))).alias("roc_auc"))


def decile_metrics(scored: DataFrame, y: str, score: str, keys: Sequence[str]) -> DataFrame:
    """Recall and lift in the best-scored tenth."""
    best = top_decile(scored, score, keys).agg(F.sum(col(y)).alias("hits"), F.avg(col(y)).alias("rate"))
    whole = scored.agg(F.sum(col(y)).alias("all_hits"), F.avg(col(y)).alias("all_rate"))
    return beside(whole, best).select(
        (F.col("hits") / F.greatest(F.col("all_hits"), F.lit(1))).cast("double").alias("recall_at_decile"),
        (F.col("rate") / F.greatest(F.col("all_rate"), F.lit(TINY))).alias("lift_at_decile"))


def decile_precision(scored: DataFrame, y: str, yhat: str, confidence: str, keys: Sequence[str]) -> DataFrame:
    """Of the most confident tenth, the share predicted right."""
    best = top_decile(scored, confidence, keys)
    return best.agg(F.avg((col(y) == col(yhat)).cast("double")).alias("precision_at_decile"))


def score_metrics(scored: DataFrame, y: str, yhat: str, score: str | None, keys: Sequence[str], task: str) -> DataFrame:
    """The task's metric set, one row, for given scores and hard predictions."""
    if task == REGRESSION:
        return regression_metrics(scored, y, yhat)
    if task == MULTICLASS:
        accuracy = scored.agg(F.avg((col(y) == col(yhat)).cast("double")).alias("accuracy"))
        return beside(accuracy, macro_metrics(scored, y, yhat), decile_precision(scored, y, yhat, score, keys))
    return beside(ranking_metrics(scored, y, score), confusion_metrics(scored, y, yhat),
                   decile_metrics(scored, y, score, keys))


def threshold_metrics(scored: DataFrame, y: str, score: str, threshold: float, keys: Sequence[str]) -> DataFrame:
    """Binary metric set where the hard prediction is score ≥ threshold, with the base rate and the threshold."""
    flagged = scored.withColumn("_YHAT", at_least(col(score), threshold))
    base = scored.agg(F.avg(col(y)).alias("base_rate"), F.lit(float(threshold)).alias("threshold"))
    return beside(score_metrics(flagged, y, "_YHAT", score, keys, BINARY), base)


def beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row tables side by side, each as one scalar subquery of a struct."""
    out = first
    for i, o in enumerate(others):
        out = out.withColumn(f"_S{i}", o.select(F.struct(*o.columns)).scalar())
    return out.select(*first.columns, *[F.col(f"_S{i}").getField(c).alias(c) for i, o in enumerate(others) for c in o.columns])


def compare_models(metrics: dict[str, DataFrame]) -> DataFrame:
    """One row per model version."""
    rows = [m.select(F.lit(name).alias("model"), "*") for name, m in metrics.items()]
    table = rows[0]
    for r in rows[1:]:
        table = table.unionByName(r)
    return table


def promotion_gate(comparison: DataFrame, champion: str, challenger: str, task: str,
                   min_lift_pct: float, max_drop_pct: float) -> DataFrame:
    """One row: promote and the deltas. Both the primary lift and the guardrail are strict."""
    names = [c for c in comparison.columns if c != "model"]
    sides = comparison.agg(*[
        F.max(F.when(F.col("model") == who, F.col(n))).alias(f"{side}_{n}")
        for side, who in (("old", champion), ("new", challenger)) for n in names])
    old, new = (lambda n: F.col(f"old_{n}")), (lambda n: F.col(f"new_{n}"))
    gain_pct = lambda n: (new(n) - old(n)) / F.greatest(old(n), F.lit(TINY)) * 100

    if task == REGRESSION:
        lift = (old("rmse") - new("rmse")) / F.greatest(old("rmse"), F.lit(TINY)) * 100
        drop = new("r2") - old("r2")
        deltas = {"rmse_delta_pct": lift, "r2_delta": drop}
        promote = (lift > min_lift_pct) & (drop > -(max_drop_pct / 100))
    elif task == MULTICLASS:
        deltas = {"f1_macro_delta_pct": gain_pct("f1_macro"),
                  "precision_at_decile_delta_pct": gain_pct("precision_at_decile")}
        promote = (gain_pct("f1_macro") > min_lift_pct) & (gain_pct("precision_at_decile") > -max_drop_pct)
    else:
        deltas = {"pr_auc_delta_pct": gain_pct("pr_auc"), "recall_at_decile_delta_pct": gain_pct("recall_at_decile"),
                  "roc_auc_delta": new("roc_auc") - old("roc_auc")}
        promote = (gain_pct("recall_at_decile") > min_lift_pct) & (gain_pct("pr_auc") > -max_drop_pct)
    return sides.select(F.coalesce(promote, F.lit(False)).alias("promote"), *[d.alias(n) for n, d in deltas.items()])


def retrain_gates(holdout: DataFrame, train: DataFrame, target: str, task: str,
                  min_rows: int, min_positives: int) -> DataFrame:
    """Counts and the first reason to skip a retrain, NULL when there is none."""
    counts = holdout.agg(
        F.count("*").alias("HOLDOUT_ROWS"),
        F.count_if(col(target) == 1).alias("HOLDOUT_POSITIVES"),
        F.count_distinct(col(target)).alias("HOLDOUT_CLASSES"))
    counts = beside(counts, train.agg(F.count("*").alias("TRAIN_ROWS")))
    reason = F.when(F.col("HOLDOUT_ROWS") < min_rows, "too few labeled rows to compare on")
    if task == BINARY:
        reason = reason.when(F.col("HOLDOUT_POSITIVES") < min_positives, "too few positives to compare on")
    if task == MULTICLASS:
        reason = reason.when(F.col("HOLDOUT_CLASSES") < 2, "all comparison rows are of one class")
    reason = reason.when(F.col("TRAIN_ROWS") == 0, "nothing is left to fit a challenger")
    return counts.withColumn("SKIP_REASON", reason)


def metric_values(metrics: DataFrame) -> dict[str, float | None]:
    """A one-row metric table as plain numbers."""
    row = metrics.first().asDict()
    return {k: None if v is None else float(v) for k, v in row.items()}


def metrics_frame(spark: SparkSession, values: dict[str, dict[str, float]]) -> DataFrame:
    """Metric values back as a comparison table, one row per model."""
    names = list(next(iter(values.values())))
    rows = [(model, *[None if v.get(n) is None else float(v[n]) for n in names]) for model, v in values.items()]
    return spark.createDataFrame(rows, "model string, " + ", ".join(f"`{n}` double" for n in names))
