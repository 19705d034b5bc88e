"""Outcomes that arrive later: source checks, the label join, and the retraining dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodemark.functions.columns import col, label_as
from lodemark.operators.encode import require_columns
from lodemark.operators.joins import asof_for_unique, latest_per_key, salted_join
from lodemark.operators.metrics import beside
from lodemark.settings import MULTICLASS, score_column

HISTORY, PRODUCTION = "HISTORY", "PRODUCTION"


def duplicate_keys(outcomes: DataFrame, key: str, label: str) -> DataFrame:
    """Rows beyond one per key, among rows that carry an outcome."""
    return outcomes.where(col(label).isNotNull()).agg(
        (F.count("*") - F.count_distinct(col(key))).alias("N_DUPLICATE"))


def refuse_ambiguous(outcomes: DataFrame, key: str, label: str, ts: str | None):
    """Without a timestamp that lets the latest row win, every key may have one outcome only."""
    if ts is None:
        extra = duplicate_keys(outcomes, key, label).first()[0]
        if extra:
            raise ValueError(f"{extra} outcome row(s) repeat a {key}: keep one row per {key}, or set outcome_ts to take the newest")


def known_outcomes(outcomes: DataFrame, key: str, label: str, task: str, ts: str | None = None) -> DataFrame:
    """(key, GT_LABEL): one non-NULL outcome per key, cast for the task."""
    rows = outcomes.where(col(label).isNotNull())
    if ts is not None:
        rows = latest_per_key(rows, [key], ts, [label])
    return rows.select(col(key), label_as(task, col(label)).alias("GT_LABEL"))


def label_updates(monitor: DataFrame, outcomes: DataFrame, key: str, label: str, task: str, now: Column,
                  ts: str | None = None, respect_maturity: bool = True) -> DataFrame:
    """Monitor rows that are still unlabeled, mature, and have an outcome, with that outcome as GT_LABEL."""
    waiting = monitor.where("ACTUAL_LABEL IS NULL")
    if respect_maturity:
        waiting = waiting.where(F.col("LABEL_MATURE_AT") <= now)
    return salted_join(waiting, known_outcomes(outcomes, key, label, task, ts), [key])


def label_counts(monitor: DataFrame) -> DataFrame:
    return monitor.agg(F.count("*").alias("TOTAL_ROWS"),
                       F.count_if(F.col("ACTUAL_LABEL").isNotNull()).alias("LABELED"),
                       F.count_if(F.col("ACTUAL_LABEL").isNull()).alias("WAITING"))


def labelable(monitor: DataFrame, outcomes: DataFrame, key: str, label: str) -> DataFrame:
    """Rows, rows still waiting, and waiting rows the source can label now."""
    known = outcomes.where(col(label).isNotNull()).select(col(key)).distinct().withColumn("KNOWN", F.lit(True))
    matched = salted_join(monitor.select(col(key), "ACTUAL_LABEL"), known, [key], "left")
    pending = F.col("ACTUAL_LABEL").isNull()
    return matched.agg(F.count("*").alias("MONITOR_ROWS"), F.count_if(pending).alias("MONITOR_PENDING"),
                       F.count_if(pending & F.col("KNOWN").isNotNull()).alias("LABELABLE_NOW"))


def outcome_profile(outcomes: DataFrame, monitor: DataFrame, key: str, label: str, ts: str | None = None) -> DataFrame:
    """One row about the source and what it could label; refuses missing columns and ambiguous keys."""
    require_columns(outcomes, [key, label, *([ts] if ts else [])], "outcome source")
    refuse_ambiguous(outcomes, key, label, ts)
    source = outcomes.agg(F.count("*").alias("SOURCE_ROWS"), F.count_distinct(col(key)).alias("DISTINCT_KEYS"),
                          F.count_if(col(label).isNull()).alias("NULL_OUTCOMES"))
    return beside(source, labelable(monitor, outcomes, key, label))


def labeled_scores(monitor: DataFrame, keys: Sequence[str], task: str, version: str | None = None) -> DataFrame:
    """Scored rows that now have an outcome, latest score per key, optionally of one model version."""
    rows = monitor.where("ACTUAL_LABEL IS NOT NULL")
    if version:
        rows = rows.where(F.col("MODEL_VERSION") == version)
    score = score_column(task)
    rows = rows.select(*[col(k) for k in keys], score, "PREDICTION", "ACTUAL_LABEL", "SCORED_AT")
    return latest_per_key(rows, keys, "SCORED_AT", [score])


def retrain_base(history: DataFrame, feed: DataFrame, monitor: DataFrame, keys: Sequence[str], ts: str, target: str,
                 features: Sequence[str], task: str, cohort: Column, watermark: str | None,
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """Original training rows plus production rows with a real outcome.

    A production row is the newest feed record of a key at or before the moment it was scored. The monitor is cut to
    its latest labeled score per key before the join, so the join never fans out. `cohort` is the value of the
    timestamp column for production rows, over SCORED_AT and the feed columns.
    """
    columns = list(dict.fromkeys([*keys, ts, target, *features]))
    labeled = latest_per_key(
        monitor.where("ACTUAL_LABEL IS NOT NULL").select(*[col(k) for k in keys], "ACTUAL_LABEL", "SCORED_AT"),
        keys, "SCORED_AT", ["ACTUAL_LABEL"])
    wanted = dict.fromkeys([*keys, *features, *([watermark] if watermark else []), *tiebreak])
    rows = feed.select(*[col(c) for c in wanted])
    if watermark:
        rows = asof_for_unique(labeled, rows, keys, "SCORED_AT", watermark, tiebreak)
    else:
        rows = salted_join(rows, labeled, keys)
    computed = {ts: cohort, target: label_as(task, F.col("ACTUAL_LABEL"))}
    production = rows.select(*[computed.get(c, col(c)).alias(c) for c in columns],
                             F.lit(PRODUCTION).alias("ROW_SOURCE"), "SCORED_AT")
    past = history.select(*[(col(c).cast("string") if c == target and task == MULTICLASS else col(c)).alias(c)
                            for c in columns],
                          F.lit(HISTORY).alias("ROW_SOURCE"), F.lit(None).cast("timestamp_ntz").alias("SCORED_AT"))
    return past.unionByName(production)


def rows_by_source(base: DataFrame) -> DataFrame:
    return base.groupBy("ROW_SOURCE").agg(F.count("*").alias("N"))


def champion_comparison(base: DataFrame, champion: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Production rows next to the champion's score of the same keys, renamed CHAMPION_*."""
    renamed = champion.withColumnsRenamed({c: f"CHAMPION_{c}" for c in champion.columns if c not in keys})
    return salted_join(base.where(F.col("ROW_SOURCE") == PRODUCTION), renamed, keys)
