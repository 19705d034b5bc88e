"""Reports over the monitor table and drift against the baseline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodemark.functions.columns import col
from lodemark.operators.ranking import order_statistics
from lodemark.settings import MULTICLASS, REGRESSION, score_column
from lodemark.sources.scans import staged

SHARE_FLOOR = 1e-6  # keeps the logarithm finite when a bin is empty on one side


def scoring_summary(monitor: DataFrame, task: str, days: int = 10) -> DataFrame:
    """Per scoring day and model version, newest first."""
    day = F.to_date("SCORED_AT").alias("DT")
    high = F.count_if(F.col("RISK_BAND") == "HIGH").alias("N_HIGH")
    tail = [F.count("PROBABLE_CAUSES").alias("N_WITH_CAUSES"), F.count("ACTUAL_LABEL").alias("N_ACTUAL")]
    score = F.col(score_column(task))
    if task == REGRESSION:
        shown = [F.round(F.avg(score), 4).alias("AVG_PRED"), F.round(F.min(score), 4).alias("MIN_PRED"),
                 F.round(F.max(score), 4).alias("MAX_PRED")]
    elif task == MULTICLASS:
        shown = [F.round(F.avg(score), 4).alias("AVG_CONFIDENCE"),
                 F.count_distinct("PREDICTION").alias("N_CLASSES_PREDICTED"), high]
    else:
        shown = [F.round(F.avg(score), 4).alias("AVG_PROB"), F.sum("PREDICTION").alias("N_FLAGGED"), high]
    grouped = monitor.groupBy(day, "MODEL_VERSION").agg(F.count("*").alias("N"), *shown, *tail)
    return grouped.orderBy(F.desc("DT"), "MODEL_VERSION").limit(days)


def training_summary(baseline: DataFrame, task: str) -> DataFrame:
    shown = (F.avg("PREDICTION").alias("AVG_PREDICTED_VALUE") if task == REGRESSION
             else F.count_if(F.col("RISK_BAND") == "HIGH").alias("N_HIGH"))
    return baseline.groupBy(F.to_date("SCORED_AT").alias("DT")).agg(F.count("*").alias("N"), shown)


def latest_batch(monitor: DataFrame) -> DataFrame:
    """Rows of the newest scoring run: the newest timestamp is a scalar subquery, so no join."""
    return monitor.where(F.col("SCORED_AT") == monitor.agg(F.max("SCORED_AT").alias("at")).scalar())


def score_drift(baseline: DataFrame, monitor: DataFrame, task: str) -> DataFrame:
    """Mean score and rows, baseline against the latest batch."""
    score = score_column(task)
    side = lambda name, rows: rows.agg(F.round(F.avg(score), 4).alias("AVG_SCORE"), F.count("*").alias("N")).select(
        F.lit(name).alias("SRC"), "AVG_SCORE", "N")
    return side("baseline", baseline).unionByName(side("latest batch", latest_batch(monitor)))


def prediction_mix(baseline: DataFrame, monitor: DataFrame) -> DataFrame:
    """Rows per predicted class, baseline against the latest batch."""
    side = lambda name, rows: rows.groupBy("PREDICTION").agg(F.count("*").alias("N")).select(
        F.lit(name).alias("SRC"), "PREDICTION", "N")
    return side("baseline", baseline).unionByName(side("latest batch", latest_batch(monitor)))


@dataclass(frozen=True)
class Reference:
    """Score bins of the baseline: inner edges (a bin includes its upper edge) and the share of rows in each bin."""

    edges: tuple[float, ...]
    shares: tuple[float, ...]


def baseline_bins(baseline: DataFrame, score: str, bins: int = 10) -> Reference:
    """Exact quantiles of the baseline as edges; equal ones collapse. The scores are written once, as several passes read them."""
    baseline = staged(baseline.select(score))
    found = order_statistics(baseline, [(score, lambda n, i=i: max(-(-i * n // bins), 1)) for i in range(1, bins)])
    edges = tuple(sorted({f.value for f in found if f is not None}))
    counts = baseline.agg(F.count(col(score)).alias("n"), *_bin_counts(score, edges)).first()
    total = max(counts["n"], 1)
    return Reference(edges, tuple(counts[f"BIN_{b}"] / total for b in range(len(edges) + 1)))


def _bin_counts(score: str, edges: Sequence[float]) -> list[Column]:
    lows, highs = [None, *edges], [*edges, None]
    out = []
    for b, (low, high) in enumerate(zip(lows, highs)):
        inside = col(score).isNotNull()
        if low is not None:
            inside = inside & (col(score) > F.lit(low))
        if high is not None:
            inside = inside & (col(score) <= F.lit(high))
        out.append(F.count_if(inside).alias(f"BIN_{b}"))
    return out


def drift_aggregates(reference: Reference, task: str) -> list[Column]:
    """What is kept per window: all of it combines on the map side, in batch and in a stream."""
    score = score_column(task)
    labeled = F.col("ACTUAL_LABEL").isNotNull()
    if task == REGRESSION:
        quality = F.avg(F.when(labeled, F.abs(F.col(score) - F.col("ACTUAL_LABEL")))).alias("MEAN_ABS_ERROR")
    else:
        quality = F.avg(F.when(labeled, (F.col("PREDICTION") == F.col("ACTUAL_LABEL")).cast("double"))).alias("ACCURACY")
    return [F.count("*").alias("N"), F.avg(score).alias("MEAN_SCORE"), F.stddev_samp(score).alias("STD_SCORE"),
            F.count_if(labeled).alias("N_LABELED"), quality, *_bin_counts(score, reference.edges)]


def stability_index(reference: Reference) -> Column:
    """Population stability index of a window's bin counts against the baseline's shares."""
    total = F.lit(0)
    for b in range(len(reference.shares)):
        total = total + F.col(f"BIN_{b}")
    psi = F.lit(0.0)
    for b, share in enumerate(reference.shares):
        was = F.lit(max(share, SHARE_FLOOR))
        now = F.greatest(F.try_divide(F.col(f"BIN_{b}"), total), F.lit(SHARE_FLOOR))
        psi = psi + (now - was) * F.log(now / was)
    return psi


def drift_windows(monitor: DataFrame, reference: Reference, task: str, duration: str = "1 day",
                  ts: str = "SCORED_AT") -> DataFrame:
    """Per tumbling window and model version: rows, mean and spread of the score, PSI, and accuracy where labels are in
    (mean absolute error for regression). Works on a table and on a stream with a watermark."""
    grouped = monitor.groupBy(F.window(ts, duration).alias("w"), "MODEL_VERSION").agg(*drift_aggregates(reference, task))
    bins = [f"BIN_{b}" for b in range(len(reference.shares))]
    return grouped.select(F.col("w.start").alias("WINDOW_START"), *[c for c in grouped.columns if c not in ("w", *bins)],
                          stability_index(reference).alias("PSI"))


def schema_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns found on one side only, as (COLUMN_NAME, SIDE)."""
    a, b = {c.upper() for c in left.columns}, {c.upper() for c in right.columns}
    rows = [(c, "left only") for c in sorted(a - b)] + [(c, "right only") for c in sorted(b - a)]
    return left.sparkSession.createDataFrame(rows, "COLUMN_NAME string, SIDE string")


def feature_parity(columns: Sequence[str], keys: Sequence[str], encoded: Sequence[str]) -> dict[str, list[str]]:
    """Feature columns of a monitor table that the contract does not know, and the other way round."""
    known = {c.upper() for c in (*keys, *MONITOR_FIXED)}
    have = [c for c in columns if c.upper() not in known]
    return {"extra": [c for c in have if c not in encoded], "missing": [c for c in encoded if c not in have]}


# Monitor columns that are not features.
MONITOR_FIXED = (
    "PREDICTED_PROBABILITY", "PREDICTED_VALUE", "PREDICTION", "RISK_BAND", "PROBABLE_CAUSES",
    "ACTUAL_LABEL", "SCORED_AT", "LABEL_MATURE_AT", "MODEL_VERSION",
    "RUN_ID", "FEED_ROW_ID", "USE_CASE_NAME",
)
