"""Target preparation and the profiles printed about it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodemark.functions.columns import col, numeric_column
from lodemark.settings import BINARY, REGRESSION

MAX_CLASSES = 1000


def prepare_target(df: DataFrame, target: str, task: str, drop_null: bool = False,
                   known: list[str] | None = None) -> tuple[DataFrame, list[str] | None]:
    """(rows with a numeric target, label list or None).

    `known` are the labels of an earlier version: they keep their codes, and labels that are new follow them.

    Regression: double, and anything unreadable is an error. Classes: a target that is numeric (or all readable as
    numbers) is used as it is; otherwise codes follow the sorted labels. A NULL class becomes 0 unless dropped.
    """
    if drop_null:
        df = df.where(col(target).isNotNull())
    number = numeric_column(df, target)
    if task == REGRESSION:
        if df.agg(F.count_if(number.isNull())).first()[0]:
            raise ValueError(f'non-numeric or missing values in regression target "{target}"')
        return df.withColumn(target, number), None
    if known:
        labels = [*known, *[x for x in class_labels(df, target) if x not in set(known)]]
        return df.withColumn(target, class_code(col(target), labels)), labels
    if not isinstance(df.schema[target].dataType, T.NumericType):
        seen = df.agg(F.count(number).alias("numbers"), F.count(col(target)).alias("values")).first()
        if seen["numbers"] != seen["values"]:
            labels = class_labels(df, target)
            return df.withColumn(target, class_code(col(target), labels)), labels
    return df.withColumn(target, F.coalesce(number.cast("int"), F.lit(0))), None


def class_labels(df: DataFrame, target: str) -> list[str]:
    rows = df.select(col(target).cast("string").alias("v")).where("v IS NOT NULL").distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f'"{target}" has more than {MAX_CLASSES} classes')
    return sorted(r["v"] for r in rows)


def class_code(value: Column, labels: list[str]) -> Column:
    """Position in the sorted labels; NULL is class 0. The label list is small, so this is a lookup in the projection."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), value.cast("string"))
    return F.coalesce((position - 1).cast("int"), F.lit(0))


def label_text(code: Column, labels: list[str] | None) -> Column:
    """The label a class code stands for; without a label list the code is the label."""
    return F.get(F.array(*[F.lit(x) for x in labels]), code.cast("int")) if labels else code.cast("int").cast("string")


def target_profile(df: DataFrame, target: str, task: str) -> DataFrame:
    """Regression: rows, mean, std. Binary: rows, base rate and the 1:N imbalance."""
    if task == REGRESSION:
        return df.agg(F.count("*").alias("N_ROWS"), F.avg(col(target)).alias("TARGET_MEAN"),
                      F.stddev_samp(col(target)).alias("TARGET_STD"))
    rates = df.agg(F.count("*").alias("N_ROWS"), F.avg(col(target)).alias("BASE_RATE"))
    return rates.withColumn("IMBALANCE", (1 - F.col("BASE_RATE")) / F.greatest(F.col("BASE_RATE"), F.lit(1e-9)))


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(col(target).alias("CLASS")).agg(F.count("*").alias("N"))


def naive_baseline(df: DataFrame, target: str, task: str) -> DataFrame:
    """What guessing achieves: positive rate, share of the largest class, or the target's spread."""
    if task == BINARY:
        return df.agg(F.avg(col(target)).alias("BASELINE"))
    if task == REGRESSION:
        return df.agg(F.stddev_samp(col(target)).alias("BASELINE"))
    counts = class_distribution(df, target)
    return counts.agg((F.max("N") / F.sum("N")).alias("BASELINE"))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Positive-class weights a search may try: 1, sqrt(neg/pos), neg/pos."""
    ratio = F.count_if(col(target) == 0) / F.greatest(F.count_if(col(target) == 1), F.lit(1))
    return df.agg(ratio.cast("double").alias("RATIO")).select(
        F.lit(1.0).alias("WEIGHT_NONE"), F.sqrt("RATIO").alias("WEIGHT_SQRT"), F.col("RATIO").alias("WEIGHT_FULL"))


def balanced_weights(df: DataFrame, target: str) -> dict[float, float]:
    """Weight per class so that every class counts the same: rows / (classes * rows of the class). Too many are refused."""
    counts = class_distribution(df, target).limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f'"{target}" has more than {MAX_CLASSES} classes')
    total = sum(r["N"] for r in counts)
    return {float(r["CLASS"]): total / (len(counts) * r["N"]) for r in counts}
