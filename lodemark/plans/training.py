"""First model version: split, encode, impute, search, fit, evaluate, explain, register, baseline, monitor seed."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodemark.functions.columns import col
from lodemark.operators import encode as E
from lodemark.operators import learners
from lodemark.operators.explain import feature_importance
from lodemark.operators.monitoring import training_summary
from lodemark.operators.splits import search_fit_rows, split_data
from lodemark.operators.targets import label_text, naive_baseline, prepare_target
from lodemark.plans.shared import as_time, bands, cohort_times, evaluate, feed_row_id, monitor_columns, predicted, time_column
from lodemark.settings import BINARY, LABEL_TYPE, MULTICLASS
from lodemark.sources.scans import shared_folder, staged
from lodemark.sources.store import Store


@dataclass(frozen=True)
class Training:
    version: str
    strategy: str
    split_point: object
    metrics: dict
    params: dict
    trials: DataFrame
    importance: DataFrame
    summary: DataFrame
    naive: float | None


def train(store: Store, source: DataFrame, version: str, now: datetime | str) -> Training:
    use_case = store.use_case
    data, task, spec = use_case.data, use_case.task, use_case.split
    store.refuse_existing(version)
    shared_folder(store.spark)
    E.require_columns(source, (*data.keys, data.timestamp, data.target, *data.features), "training source")

    # the source is read once: target, split, vocabulary and both sides pass over what the job needs of it
    needed = {c.upper() for c in (*data.keys, data.timestamp, data.target, *data.features)}
    source = staged(source.select(*[col(c) for c in source.columns if c.upper() in needed]))
    rows, labels = prepare_target(source, data.target, task)
    split = split_data(rows, data.timestamp, data.keys, spec)
    contract = E.fit_contract(split.train, data)
    carried = list(dict.fromkeys([*data.keys, data.timestamp, data.target]))
    encoded = staged(E.encode(split.train, contract, carried))
    fills = E.fit_imputation(encoded, contract.encoded, data.median_impute)
    train_rows = staged(E.impute(encoded, fills))
    test_rows = staged(E.encode(split.test, contract, carried, fills))
    refuse_gaps(train_rows, contract)

    fits = search_fit_rows(train_rows, data.timestamp, spec.hpo_validation_fraction, data.keys)
    found = learners.search(train_rows, ~fits, data.target, contract, use_case)
    naive = naive_baseline(train_rows.where(~fits), data.target, task).first()[0]
    model = learners.fit_final(train_rows, data.target, contract, use_case, found.params, found.rounds)

    scored = staged(learners.score(model, test_rows, task))
    cut = bands(scored, use_case)
    final = predicted(scored, task, cut["high"])
    metrics = evaluate(final, data.target, use_case, data.keys)
    if task == BINARY:
        metrics.update(base_rate=final.agg(F.avg(col(data.target))).first()[0], threshold=cut["high"])

    means = learners.training_means(train_rows, contract)
    explained = learners.score(model, train_rows.select(*[col(c) for c in contract.encoded]), task)
    with_phi, sources = learners.contributions(model, explained, contract, means, task)
    explained = staged(with_phi.select("PHI"))
    by_source = {s: F.get("PHI", F.lit(i)) for i, s in enumerate(sources)}
    importance = staged(feature_importance(explained, by_source, use_case.scoring.top_features))

    store.save_model(model, version)
    store.save_contract(contract, version, time_column(now))
    store.log_run(version, use_case.model.algorithm, metrics, {
        "best_params": found.params, "n_estimators": found.rounds, "impute_values": fills, "feature_means": means,
        "risk_cut_high": cut["high"], "risk_cut_medium": cut["medium"], "capacity_threshold": cut["capacity"],
        "class_labels": labels, "split_strategy": split.strategy, "split_point": split.point}, as_time(now))

    baseline = baseline_rows(final, model, contract, means, use_case, cut, version, data.timestamp, now, "baseline", labels)
    store.save_baseline(baseline, version)
    store.seed_monitor(baseline, as_time(now), time_column(now))
    return Training(version, split.strategy, split.point, metrics, found.params, found.trials, importance,
                    training_summary(store.baseline(version), task), naive)


def baseline_rows(scored, model, contract, means, use_case, cut, version, ts, now, tag, labels=None) -> DataFrame:
    """Scored test rows with their labels, written once: the baseline drift is measured against."""
    keys = use_case.data.keys
    at = cohort_times(scored, ts, now)
    target = col(use_case.data.target)
    target = label_text(target, labels) if use_case.task == MULTICLASS else target.cast(LABEL_TYPE[use_case.task])
    identified = scored.withColumns({"_AT": at, "_LABEL_OUT": target, "FEED_ROW_ID": feed_row_id([*keys, ts], tag)})
    rows = monitor_columns(identified, model, contract, means, use_case, cut["high"], cut["medium"], version, F.col("_AT"),
                           [*keys, "FEED_ROW_ID", "_LABEL_OUT"], labels)
    return staged(rows.withColumnRenamed("_LABEL_OUT", "ACTUAL_LABEL"))


def refuse_gaps(rows: DataFrame, contract: E.Contract):
    """Training rows must be complete after imputation."""
    left = rows.agg(*[F.count_if(col(c).isNull()).alias(c) for c in contract.encoded]).first().asDict()
    bad = [c for c, n in left.items() if n]
    if bad:
        raise ValueError(f"NULLs remain after imputation in {bad}")
