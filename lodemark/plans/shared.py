"""Steps that training, scoring and retraining have in common."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodemark.functions.columns import at_least, col, cohort_start, digest, matures_at, risk_band
from lodemark.operators import learners
from lodemark.operators.encode import Contract
from lodemark.operators.metrics import metric_values, score_metrics
from lodemark.operators.ranking import cutoffs
from lodemark.operators.targets import label_text
from lodemark.settings import BINARY, MULTICLASS, REGRESSION, UseCase, score_column


def as_time(now: datetime | str) -> datetime:
    return datetime.fromisoformat(now) if isinstance(now, str) else now


def time_column(now: datetime | str) -> Column:
    return F.lit(as_time(now).isoformat(sep=" ")).cast("timestamp_ntz")


def feed_row_id(columns: Sequence[str], seed: str | None = None) -> Column:
    return digest(*[col(c) for c in columns], seed=seed)


def bands(scored: DataFrame, use_case: UseCase) -> dict[str, float | None]:
    """Cutoffs of HIGH and MEDIUM and the daily capacity threshold; none for regression."""
    if use_case.task == REGRESSION:
        return {"high": None, "medium": None, "capacity": None}
    s = use_case.scoring
    return cutoffs(scored, "SCORE", {"high": s.n_high, "medium": s.n_medium, "capacity": s.daily_capacity})


def predicted(scored: DataFrame, task: str, high: float | None) -> DataFrame:
    """YHAT as it is stored: a binary flag comes from the threshold, which is the HIGH cutoff."""
    return scored.withColumn("YHAT", at_least(F.col("SCORE"), high)) if task == BINARY else scored


def evaluate(scored: DataFrame, target: str, use_case: UseCase, keys: Sequence[str]) -> dict[str, float | None]:
    """Metric set of rows with SCORE and the final YHAT."""
    score = None if use_case.task == REGRESSION else "SCORE"
    return metric_values(score_metrics(scored, target, "YHAT", score, keys, use_case.task))


def monitor_columns(scored: DataFrame, model: PipelineModel, contract: Contract, means: dict[str, float], use_case: UseCase,
                    high: float | None, medium: float | None, version: str, scored_at: Column, carried: Sequence[str],
                    labels: list[str] | None = None) -> DataFrame:
    """Scored rows in the monitor's column contract: keys, features, score, prediction, band, causes, dates, version.

    A class is stored as its label, never as its code: codes belong to a version, labels to the outcome.
    """
    task = use_case.task
    if task == MULTICLASS:
        prediction = label_text(F.col("YHAT"), labels)
    else:
        prediction = F.col("YHAT").cast("double" if task == REGRESSION else "int")
    band = F.lit(None).cast("string") if task == REGRESSION else risk_band(F.col("SCORE"), high, medium)
    explained = learners.causes(model, scored, contract, means, task, use_case.scoring.causes_per_row)
    return explained.select(
        *[col(c) for c in carried], *[col(c) for c in contract.encoded], F.col("SCORE").alias(score_column(task)),
        prediction.alias("PREDICTION"), band.alias("RISK_BAND"), "PROBABLE_CAUSES",
        scored_at.alias("SCORED_AT"), matures_at(scored_at, use_case.scoring.horizon_days).alias("LABEL_MATURE_AT"),
        F.lit(version).alias("MODEL_VERSION"))


def cohort_times(rows: DataFrame, ts: str, now: datetime | str) -> Column:
    """When a training row counts as scored: the start of its YYYYMM cohort, or now when no value is one."""
    at = cohort_start(col(ts))
    readable = rows.agg(F.count(at)).first()[0]
    return at if readable else time_column(now)
