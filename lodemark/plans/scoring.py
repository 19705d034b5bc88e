"""One incremental scoring run, safe to repeat and safe beside another one."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodemark.functions.columns import col
from lodemark.operators import learners
from lodemark.operators.encode import Contract, scoring_input
from lodemark.operators.joins import latest_per_key
from lodemark.plans.shared import as_time, feed_row_id, monitor_columns, predicted, time_column
from lodemark.settings import BINARY, REGRESSION, score_column
from lodemark.sources.scans import incremental_rows, shared_folder
from lodemark.sources.store import Store

PROCEDURE = "SCORE_BATCH"


@dataclass(frozen=True)
class Deployment:
    """A model version with all that scoring needs, read once."""

    version: str
    model: PipelineModel
    contract: Contract
    threshold: float | None
    high: float | None
    medium: float | None
    fills: dict
    means: dict
    labels: list[str] | None = None


def deploy(store: Store, version: str | None = None) -> Deployment:
    """Loads a version (the newest run by default) and checks it fits the use case.

    Its features may differ from those of earlier runs: every run keeps its schema and the monitor is read by all of them.
    """
    run = store.past_run(version)
    if run is None:
        raise ValueError(f"no run found for version {version}; train it first")
    if run.task != store.use_case.task:
        raise ValueError(f"use case is {store.use_case.task}, but {run.version} was trained as {run.task}")
    version, extra = run.version, run.extra
    contract = store.contract(version)
    high = extra.get("risk_cut_high")
    threshold = run.metrics.get("threshold", high) if store.use_case.task == BINARY else None
    return Deployment(version, store.load_model(version), contract, threshold, high, extra.get("risk_cut_medium"),
                      extra.get("impute_values", {}), extra.get("feature_means", {}), extra.get("class_labels"))


def score_batch(store: Store, feed: DataFrame, now: datetime | str, version: str | None = None) -> str:
    """Scores feed rows after the watermark and up to midnight; returns and logs OK or SKIPPED, logs FAILED and raises.

    Of several runs that start from one watermark, whatever their days, the first to commit stands; the others are SKIPPED,
    and nobody sees what they wrote until `Store.drop_uncommitted` removes it.
    """
    shared_folder(store.spark)
    try:
        target = deploy(store, version)
        data, turn = store.use_case.data, store.turn()
        watermark, resets = turn
        rows = scoring_input(feed, target.contract, data, target.fills)
        start = None if watermark is None else time_column(watermark)
        batch = incremental_rows(rows, data.watermark, start, time_column(now))
        batch = batch.withColumn("FEED_ROW_ID", feed_row_id(data.feed_row))
        if resets:
            batch = unscored(store, batch, target.version, start)
        run_id = f"run-{watermark or 'first'}-{as_time(now):%Y-%m-%d}-{resets}-{uuid.uuid4().hex[:12]}".replace(" ", "T").replace(":", "")
        return write_run(store, target, batch, run_id, now, turn)
    except Exception as e:
        store.log(PROCEDURE, 0, "FAILED", str(e), as_time(now))
        raise


def unscored(store: Store, batch: DataFrame, version: str, start) -> DataFrame:
    """After a watermark reset: without the rows the monitor still holds a score of this version for."""
    held = store.scores().where(F.col("MODEL_VERSION") == version)
    if start is not None:
        held = held.where(col(store.use_case.data.watermark) > start)
    return batch.join(held.select("FEED_ROW_ID"), "FEED_ROW_ID", "left_anti")


def write_run(store: Store, target: Deployment, batch: DataFrame, run_id: str, now: datetime | str,
              turn: tuple[datetime | None, int] | None = None) -> str:
    """Scores and writes the run's partitions, then commits them with one row: readers see all of it or nothing. With a `turn`,
    only where no other run has taken it."""
    if batch.isEmpty():
        store.log(PROCEDURE, 0, "SKIPPED", "no new rows to score", as_time(now))
        return "SKIPPED: 0 new rows"
    use_case = store.use_case
    scored = predicted(learners.score(target.model, batch, use_case.task), use_case.task, target.threshold)
    rows = monitor_columns(scored, target.model, target.contract, target.means, use_case, target.high, target.medium,
                           target.version, time_column(now), ["FEED_ROW_ID", *use_case.data.carried], target.labels)
    n, newest = store.write_scores(rows, run_id, use_case.data.watermark)
    if use_case.scoring.business_columns:
        store.add_business(business_rows(store.run_scores(run_id), use_case, now), run_id)
    if turn is None:
        store.commit(run_id, newest, as_time(now))
    elif not store.commit_once(run_id, turn, newest, as_time(now)):
        store.log(PROCEDURE, 0, "SKIPPED", "another run scored these rows first", as_time(now))
        return "SKIPPED: another run scored these rows first"
    store.log(PROCEDURE, n, "OK", f"scored {n} rows", as_time(now))
    return f"OK: {n} rows scored"


def business_rows(scores: DataFrame, use_case, now) -> DataFrame:
    """The run's newest row per business key under business names, with the score columns and a stamp."""
    names = use_case.scoring.business_columns
    key = next(iter(names))
    newest = latest_per_key(scores, [key], use_case.data.watermark, ["FEED_ROW_ID"])
    shown = [score_column(use_case.task), *([] if use_case.task == REGRESSION else ["RISK_BAND"]), "PREDICTION", "PROBABLE_CAUSES"]
    return newest.select(*[col(c).alias(out) for c, out in names.items()], *shown, time_column(now).alias("SYS_UPD_DT"))


def roll_back(store: Store, version: str, to: datetime | str, now: datetime | str) -> int:
    """Undoes a deployment: its unlabeled rows leave the monitor and the watermark goes back. Returns the rows removed."""
    removed = store.roll_back(version)
    store.reset_watermark(as_time(to), as_time(now))
    return removed
