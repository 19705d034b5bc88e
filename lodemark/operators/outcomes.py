"""Simulated outcomes: a weighted ranking of a few features plus repeatable noise, the best share flagged."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodemark.functions.columns import col, stable_bucket
from lodemark.operators.joins import latest_per_key
from lodemark.operators.ranking import SLICE_ROWS, order_statistics, percent_ranks
from lodemark.sources.scans import staged

NOISE_STEPS = 100_000


@dataclass(frozen=True)
class OutcomeRule:
    """`ranked`: weight of each column's percent rank. `flags`: weight of a 0/1 SQL condition. `noise`: its weight."""

    ranked: dict[str, float]
    flags: dict[str, float]
    noise: float = 1.20
    rate: float = 0.0018


def synthetic_outcomes(feed: DataFrame, key: str, ts: str, tiebreak: list[str], rule: OutcomeRule,
                       flag: str = "OUTCOME", score: str = "SYNTHETIC_SCORE",
                       rows_per_slice: int = SLICE_ROWS) -> DataFrame:
    """(key, flag, score) for every key of the feed.

    The flag marks rows whose descending percent rank is below `rate`, which is a threshold on the score: the row with
    `rate * (n − 1)` better rows ahead of it.
    """
    latest = latest_per_key(feed, [key], ts, tiebreak)
    inputs = staged(latest.select(
        col(key),
        *[F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(f"V_{c}") for c in rule.ranked],
        *[F.when(F.expr(condition), 1).otherwise(0).alias(f"F_{i}") for i, condition in enumerate(rule.flags)]))
    ranked = percent_ranks(inputs, {f"R_{c}": f"V_{c}" for c in rule.ranked}, rows_per_slice=rows_per_slice)
    total = F.lit(0.0)
    for c, weight in rule.ranked.items():
        total = total + F.lit(weight) * col(f"R_{c}")
    for i, weight in enumerate(rule.flags.values()):
        total = total + F.lit(weight) * F.col(f"F_{i}")
    total = total + F.lit(rule.noise) * (stable_bucket(col(key), NOISE_STEPS) / F.lit(float(NOISE_STEPS)))
    scored = staged(ranked.select(col(key), total.alias("_S")))

    ahead = lambda n: 1 if n == 1 else math.ceil(rule.rate * (n - 1))
    negated = scored.select((-F.col("_S")).alias("s"))
    found = order_statistics(negated, [("s", lambda n: max(ahead(n), 1))], written=True)[0]
    cut = F.lit(None) if found is None or ahead(found.rows) == 0 else F.lit(-found.value)
    return scored.select(col(key), F.when(F.col("_S") >= cut, 1).otherwise(0).alias(flag), F.round("_S", 4).alias(score))
