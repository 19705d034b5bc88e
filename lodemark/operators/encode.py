"""Feature encoding driven by a frozen contract: vocabulary, one-hot, imputation, scoring input."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodemark.functions.columns import col, normalize_category, numeric_column
from lodemark.operators.ranking import order_statistics
from lodemark.settings import DataSpec
from lodemark.sources.scans import staged

CAT_OHE, NUM = "CAT_OHE", "NUM"
MAX_ENCODED = 10_000  # encoded columns beyond this cannot be one Spark row; refuse instead of dropping any


@dataclass(frozen=True)
class Feature:
    encoded: str
    source: str
    role: str

    @property
    def value(self) -> str:
        return self.encoded[len(self.source) + 1:]


@dataclass(frozen=True)
class Contract:
    """The encoded columns a model version expects, in order."""

    features: tuple[Feature, ...]

    @property
    def encoded(self) -> list[str]:
        return [f.encoded for f in self.features]

    @property
    def sources(self) -> dict[str, str]:
        return {f.encoded: f.source for f in self.features}

    def to_frame(self, spark: SparkSession, use_case: str, version: str, created_at: Column) -> DataFrame:
        rows = [(i, f.encoded, f.source, f.role) for i, f in enumerate(self.features)]
        frame = spark.createDataFrame(rows, "ORDER_IDX int, ENCODED_NAME string, SOURCE_NAME string, FEATURE_ROLE string")
        return frame.select(F.lit(use_case).alias("USE_CASE_NAME"), F.lit(version).alias("MODEL_VERSION"),
                            "ORDER_IDX", "ENCODED_NAME", "SOURCE_NAME", "FEATURE_ROLE",
                            created_at.cast("timestamp_ntz").alias("CREATED_AT"))

    @staticmethod
    def from_frame(frame: DataFrame) -> Contract:
        rows = frame.orderBy("ORDER_IDX").collect()  # fit_contract bounds it
        return Contract(tuple(Feature(r["ENCODED_NAME"], r["SOURCE_NAME"], r["FEATURE_ROLE"]) for r in rows))


def require_columns(df: DataFrame, needed: Iterable[str], what: str = "source"):
    """Lists every missing column at once, before any job runs."""
    have = {c.upper() for c in df.columns}
    missing = [c for c in dict.fromkeys(needed) if c.upper() not in have]
    if missing:
        raise ValueError(f"{what} is missing column(s) {missing}; it has {df.columns}")


def vocabulary(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Distinct (SOURCE_NAME, VALUE) of the normalised categories: one pass, combined before the shuffle."""
    tidy = df.select(*[normalize_category(col(c)).alias(c) for c in categorical])
    return tidy.unpivot([], list(categorical), "SOURCE_NAME", "VALUE").distinct()


def fit_contract(df: DataFrame, data: DataSpec) -> Contract:
    """Numeric columns as they are, then one column per category value in sorted order."""
    features = [Feature(c, c, NUM) for c in data.numeric]
    if data.categorical:
        seen = vocabulary(df, data.categorical).limit(MAX_ENCODED + 1).collect()
        if len(seen) > MAX_ENCODED:
            raise ValueError(f"more than {MAX_ENCODED} category values; group rare values before encoding")
        for c in data.categorical:
            values = sorted(r["VALUE"] for r in seen if r["SOURCE_NAME"] == c)
            features += [Feature(f"{c}_{v}", c, CAT_OHE) for v in values]
    if len(features) > MAX_ENCODED:
        raise ValueError(f"more than {MAX_ENCODED} encoded columns; group rare values before encoding")
    return Contract(tuple(features))


def source_name(encoded: Column, categorical: Sequence[str]) -> Column:
    """Source column of an encoded name: the longest categorical that equals or prefixes it, else the name itself."""
    by_length = sorted(categorical, key=len, reverse=True)
    matches = [F.when((encoded == F.lit(c)) | encoded.startswith(c + "_"), F.lit(c)) for c in by_length]
    return F.coalesce(*matches, encoded)


def encode(df: DataFrame, contract: Contract, carried: Sequence[str] = (), impute: dict[str, float] | None = None
           ) -> DataFrame:
    """Carried columns plus exactly the contract's columns as doubles, in one projection.

    An unseen category gives all zeros. A contract column whose source is absent is 0.0. Numerics are coerced;
    those with an imputation value have their gaps filled with it.
    """
    impute = impute or {}
    present = {c.upper() for c in df.columns}
    # normalise each category once per row, not once per encoded column
    used = [s for s in dict.fromkeys(f.source for f in contract.features if f.role == CAT_OHE) if s.upper() in present]
    staged = df.select("*", *[normalize_category(col(c)).alias(f"N_{c}") for c in used]) if used else df

    def encoded(f: Feature) -> Column:
        if f.source.upper() not in present:
            return F.lit(0.0)
        if f.role == CAT_OHE:
            return (col(f"N_{f.source}") == F.lit(f.value)).cast("double")
        value = numeric_column(df, f.source)
        return F.coalesce(value, F.lit(float(impute[f.encoded]))) if f.encoded in impute else value

    return staged.select(*[col(c) for c in carried], *[encoded(f).alias(f.encoded) for f in contract.features])


def scoring_input(feed: DataFrame, contract: Contract, data: DataSpec, impute: dict[str, float]) -> DataFrame:
    """The feed turned into exactly what the model expects, next to the carried columns; lazy, like a view."""
    require_columns(feed, (*data.carried, *data.features), "production feed")
    refuse_duplicates((*data.carried, *contract.encoded))
    refuse_duplicates((*data.carried, *[f"N_{c}" for c in data.categorical], *data.numeric))
    return encode(feed, contract, data.carried, impute)


def refuse_duplicates(names: Iterable[str]):
    seen, twice = set(), set()
    for n in names:
        (twice if n.upper() in seen else seen).add(n.upper())
    if twice:
        raise ValueError(f"the scoring input would have duplicate column(s) {sorted(twice)}")


def fit_imputation(df: DataFrame, columns: Sequence[str], median: Iterable[str] = ()) -> dict[str, float]:
    """Fill values for the columns that have gaps: exact interpolated median where asked, mean otherwise.

    A column without gaps gets none; an all-NULL column gets 0.0. The columns are written once; one aggregate gives counts and
    means, and the medians of all columns are order statistics found together, so nothing is sorted or held in one task.
    """
    median = set(median)
    if not columns:
        return {}
    df = staged(df.select(*[col(c) for c in dict.fromkeys(columns)]))
    stats = df.agg(F.count("*").alias("_ROWS"), *[
        F.struct(F.count(col(c)).alias("n"), F.avg(col(c)).alias("mean")).alias(c) for c in columns]).first()
    gaps = [c for c in columns if stats[c]["n"] < stats["_ROWS"]]
    fills = {c: float(stats[c]["mean"] or 0.0) for c in gaps}
    middle = [c for c in gaps if c in median and stats[c]["n"] > 0]
    found = order_statistics(df, [pair for c in middle for pair in ((c, lambda n: (n + 1) // 2), (c, lambda n: n // 2 + 1))], written=True)
    for i, c in enumerate(middle):
        fills[c] = (found[2 * i].value + found[2 * i + 1].value) / 2
    return fills


def impute(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    return df.fillna(fills) if fills else df


def feature_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each row's feature columns as (keys, NAME, VALUE) rows, without the NULL values."""
    return df.unpivot(list(keys), list(columns), "NAME", "VALUE").where("VALUE IS NOT NULL")


def null_feature_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """How many rows reach the model with a NULL feature, by feature: gaps the training data never had."""
    counts = df.agg(*[F.count_if(col(c).isNull()).alias(c) for c in contract.encoded])
    return counts.unpivot([], contract.encoded, "NAME", "N_NULL").where("N_NULL > 0")
