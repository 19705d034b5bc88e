"""Champion against challenger on labeled production rows; the challenger is registered only when it wins."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodemark.functions.columns import col, cohort_of
from lodemark.operators import encode as E
from lodemark.operators import learners
from lodemark.operators.labels import PRODUCTION, champion_comparison, labeled_scores, retrain_base
from lodemark.operators.metrics import metrics_frame, promotion_gate, retrain_gates
from lodemark.operators.ranking import newest_fraction
from lodemark.operators.splits import search_fit_rows, without
from lodemark.operators.targets import class_code, prepare_target
from lodemark.plans.labeling import backfill_labels
from lodemark.plans.shared import as_time, bands, evaluate, predicted, time_column
from lodemark.plans.training import baseline_rows, refuse_gaps
from lodemark.settings import BINARY, REGRESSION, score_column
from lodemark.sources.scans import shared_folder, staged
from lodemark.sources.store import Store

PROCEDURE = "RETRAIN"


@dataclass(frozen=True)
class Retraining:
    status: str            # PROMOTED, HELD or SKIPPED
    champion: str
    challenger: str
    detail: str
    comparison: DataFrame | None = None
    decision: dict | None = None


def retrain(store: Store, history: DataFrame, feed: DataFrame, now: datetime | str, new_version: str,
            champion: str | None = None, outcomes: DataFrame | None = None, cohort: Column | None = None) -> Retraining:
    """Labels what can be labeled, trains a challenger on history plus older labeled production rows, compares both on the
    newest ones, and registers the challenger when the promotion gate opens. `cohort` is the value of the timestamp column
    for production rows; by default the YYYYMM of SCORED_AT. A failure is logged as FAILED and raised."""
    shared_folder(store.spark)
    try:
        return _retrain(store, history, feed, now, new_version, champion, outcomes, cohort)
    except Exception as e:
        store.log(PROCEDURE, 0, "FAILED", str(e), as_time(now))
        raise


def _retrain(store: Store, history: DataFrame, feed: DataFrame, now: datetime | str, new_version: str,
             champion: str | None, outcomes: DataFrame | None, cohort: Column | None) -> Retraining:
    use_case = store.use_case
    data, task, rules = use_case.data, use_case.task, use_case.retrain
    run = store.past_run(champion)
    if run is None:
        raise ValueError("no earlier run found; train a first version")
    old = run.version
    if run.task != task:
        raise ValueError(f"use case is {task}, but champion {old} was trained as {run.task}")
    if new_version.upper() == old.upper():
        raise ValueError(f"the challenger needs another name than the champion {old}")
    store.refuse_existing(new_version)
    if outcomes is not None:
        backfill_labels(store, outcomes, now)

    monitor = store.monitor().where(F.col("RUN_ID") != "seed")
    keys, ts, target = list(data.keys), data.timestamp, data.target
    base = staged(retrain_base(history, feed, monitor, keys, ts, target, data.features, task,
                               cohort if cohort is not None else cohort_of(F.col("SCORED_AT")), data.watermark))
    base, labels = prepare_target(base, target, task, known=run.extra.get("class_labels"))
    champion_rows = labeled_scores(monitor, keys, task, old)
    compared = staged(champion_comparison(base, champion_rows, keys))
    held = staged(newest_fraction(compared, "CHAMPION_SCORED_AT", rules.holdout_fraction, keys, use_case.split.seed))
    rest = without(base, held.select(*keys, F.lit(PRODUCTION).alias("ROW_SOURCE")), [*keys, "ROW_SOURCE"])
    reason = retrain_gates(held, rest, target, task, rules.min_holdout_rows, rules.min_holdout_positives).first()["SKIP_REASON"]
    if reason:
        return _outcome(store, "SKIPPED", old, new_version, reason, now)

    algorithm, extra = run.algorithm, run.extra
    contract = E.fit_contract(rest, data)
    carried = list(dict.fromkeys([*keys, ts, target]))
    fills = {c: v for c, v in extra.get("impute_values", {}).items() if c in contract.encoded}
    encoded = staged(E.encode(rest, contract, carried, fills))
    # gaps the champion never saw are filled with the mean of the training rows
    fills = {**fills, **E.fit_imputation(encoded, contract.encoded)}
    train_rows = staged(E.impute(encoded, fills))
    refuse_gaps(train_rows, contract)
    champion_columns = [c for c in held.columns if c.startswith("CHAMPION_")]
    test_rows = E.encode(held, contract, [*carried, *champion_columns], fills)

    params, rounds = extra["best_params"], extra.get("n_estimators")
    if rules.rerun_hpo:
        fits = search_fit_rows(train_rows, ts, use_case.split.hpo_validation_fraction, keys)
        found = learners.search(train_rows, ~fits, target, contract, use_case)
        params, rounds = found.params, found.rounds
    model = learners.fit_final(train_rows, target, contract, use_case, params, rounds, algorithm)
    scored = staged(learners.score(model, test_rows, task))
    cut = bands(scored, use_case)
    final = predicted(scored, task, cut["high"])

    predicted_before = F.col("CHAMPION_PREDICTION")
    theirs = final.withColumns({
        "SCORE": F.col(f"CHAMPION_{score_column(task)}").cast("double"),
        "YHAT": class_code(predicted_before, labels) if labels else predicted_before.cast("double" if task == REGRESSION else "int")})
    metrics = {old: evaluate(theirs, target, use_case, keys), new_version: evaluate(final, target, use_case, keys)}
    comparison = metrics_frame(store.spark, metrics)
    decision = promotion_gate(comparison, old, new_version, task, rules.min_primary_lift_pct,
                              rules.max_guardrail_drop_pct).first().asDict()
    detail = ", ".join(f"{k}={v:+.4f}" for k, v in decision.items() if k != "promote" and v is not None)
    if not decision["promote"]:
        return _outcome(store, "HELD", old, new_version, detail, now, comparison, decision)

    logged = dict(metrics[new_version])
    if task == BINARY:
        logged.update(base_rate=final.agg(F.avg(col(target))).first()[0], threshold=cut["high"])
    logged.update({f"{k}_prev": v for k, v in metrics[old].items()}, **decision)
    means = learners.training_means(train_rows, contract)
    counts = (train_rows.count(), final.count())
    store.save_model(model, new_version)
    store.save_contract(contract, new_version, time_column(now))
    store.save_baseline(baseline_rows(final, model, contract, means, use_case, cut, new_version, ts, now, new_version, labels), new_version)
    store.log_run(new_version, algorithm, logged, {
        "best_params": params, "n_estimators": rounds, "impute_values": fills, "feature_means": means,
        "risk_cut_high": cut["high"], "risk_cut_medium": cut["medium"], "class_labels": labels, "retrained_from": old,
        "train_rows": counts[0], "comparison_rows": counts[1], "synthetic_labels": rules.synthetic_labels}, as_time(now))
    return _outcome(store, "PROMOTED", old, new_version, detail, now, comparison, decision)


def _outcome(store: Store, status, old, new, detail, now, comparison=None, decision=None) -> Retraining:
    tag = " [synthetic labels]" if store.use_case.retrain.synthetic_labels else ""
    store.log(PROCEDURE, 0, status, f"{old} -> {new}: {detail}{tag}", as_time(now))
    return Retraining(status, old, new, detail, comparison, decision)
