"""Train/test and search fit/validation splits; every split is a filter."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodemark.functions.columns import as_ordinal, col
from lodemark.operators.joins import salted_join
from lodemark.operators.ranking import leading_filter, leading_rows, order_statistics, running_totals, seeded
from lodemark.settings import SplitSpec


@dataclass(frozen=True)
class Split:
    train: DataFrame
    test: DataFrame
    point: object          # first value of the timestamp column that belongs to the test side
    strategy: str          # what was used in the end


def cohort_shares(df: DataFrame, ts: str) -> DataFrame:
    """Rows per cohort and the running share of all rows, in cohort order."""
    counts = running_totals(df, ts, {"N": F.count("*")})
    total = df.agg(F.count(col(ts)).alias("n")).scalar()
    return counts.select(col(ts), "N", (F.col("RUN_N") / total).alias("CUM_SHARE"))


def split_data(df: DataFrame, ts: str, keys: Sequence[str], spec: SplitSpec) -> Split:
    """Temporal: the cohort where the running share reaches 1 − test_fraction and all later ones are the test side.

    When that leaves a side empty, or on request: a random split by the distinct ids of the last key column.
    """
    point, strategy = None, spec.strategy
    if strategy == "temporal":
        cut = temporal_cut(df, ts, spec.test_fraction)
        if cut is not None:
            ordinal = as_ordinal(df, ts)
            edge = df.agg(F.min(F.when(ordinal >= F.lit(cut), col(ts))).alias("point"),
                          F.count_if(ordinal < F.lit(cut)).alias("before")).first()
            point = edge["point"]
            if edge["before"] > 0:
                return Split(df.where(ordinal < F.lit(cut)), df.where(ordinal >= F.lit(cut)), point, "temporal")
        strategy = "random"
    train, test = split_by_id(df, keys[-1], spec.test_fraction, spec.seed)
    return Split(train, test, point, strategy)


def temporal_cut(df: DataFrame, ts: str, test_fraction: float) -> float | None:
    """Ordinal of the first cohort whose running share of rows is at least 1 − test_fraction."""
    share = 1 - test_fraction

    def rank(n: int) -> int:
        k = min(max(math.ceil(share * n), 1), n)
        while k > 1 and (k - 1) / n >= share:
            k -= 1
        while k < n and k / n < share:
            k += 1
        return k

    found = order_statistics(df.select(as_ordinal(df, ts).alias("o")), [("o", rank)])[0]
    return None if found is None else found.value


def sampled_ids(df: DataFrame, id_column: str, fraction: float, seed: int) -> DataFrame:
    """A seeded random share of the distinct ids (at least one)."""
    ids = df.select(col(id_column)).where(col(id_column).isNotNull()).distinct()
    return leading_rows(ids, seeded([id_column], seed), lambda n: max(int(n * fraction), 1))


def split_by_id(df: DataFrame, id_column: str, fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) with no id on both sides. The cut is a threshold on a hash of the id: a filter on the rows."""
    ids = df.select(col(id_column)).where(col(id_column).isNotNull()).distinct()
    test = leading_filter(ids, seeded([id_column], seed), lambda n: max(int(n * fraction), 1))
    test = test & col(id_column).isNotNull()
    return df.where(~test), df.where(test)


def search_fit_rows(train: DataFrame, ts: str, fraction: float, keys: Sequence[str]) -> Column:
    """True for rows the hyperparameter search fits on; the rest validate.

    With several cohorts the newest `fraction` of the cohorts validates. With a single one, a seeded share of the
    rows does. A fraction of 0 leaves every row on the fit side.
    """
    if fraction <= 0:
        return F.lit(True)
    ordinal = as_ordinal(train, ts)
    cohorts = train.select(ordinal.alias("o")).distinct()
    n = cohorts.limit(2).count()
    if n > 1:
        cut = order_statistics(cohorts, [("o", lambda n: max(int(n * (1 - fraction)), 1) + 1)])[0]
        return ordinal < F.lit(cut.value)
    return leading_filter(train, seeded(keys, 0), lambda n: int(n * (1 - fraction)))


def without(df: DataFrame, held_out: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not in `held_out`."""
    return salted_join(df, held_out.select(*[col(k) for k in keys]).distinct(), keys, "left_anti")
