"""Column expressions: all JVM-side built-ins, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodemark.settings import LABEL_TYPE

MISSING = "MISSING"


def col(name: str) -> Column:
    """A column by its literal name; names may hold any character."""
    return F.col(f"`{name}`")


def normalize_category(value: Column) -> Column:
    """Upper-case text with every run of other characters folded to one underscore; blank or NULL is a category."""
    folded = F.regexp_replace(F.upper(F.trim(value.cast("string"))), "[^A-Z0-9]+", "_")
    bare = F.trim(folded, F.lit("_"))
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit(MISSING))


def to_number(value: Column, from_text: bool = True) -> Column:
    """Double, with unreadable text and NaN as NULL. Java also reads `1d` and `1f` as numbers; those are text here."""
    number = value.try_cast("double")
    readable = ~F.isnan(number)
    if from_text:
        readable = readable & ~value.cast("string").rlike(r"[0-9.][dDfF]\s*$")
    return F.when(readable, number)


def numeric_column(df: DataFrame, name: str) -> Column:
    return to_number(col(name), isinstance(df.schema[name].dataType, T.StringType))


def without_nan(number: Column) -> Column:
    """NaN counts as NULL wherever values are ranked."""
    return F.when(~F.isnan(number), number)


def as_ordinals(df: DataFrame, name: str) -> list[Column]:
    """Doubles that together sort like the column. A BIGINT needs two, as one double holds only 53 bits of it."""
    if isinstance(df.schema[name].dataType, T.LongType):
        c = col(name)
        return [F.shiftright(c, 31).cast("double"), c.bitwiseAND(F.lit(2**31 - 1)).cast("double")]
    return [as_ordinal(df, name)]


def as_ordinal(df: DataFrame, name: str) -> Column:
    """A double that sorts like the column: numbers as they are, dates as days, timestamps as microseconds; NaN is NULL.

    TIMESTAMP_NTZ is read field by field: going through TIMESTAMP would let the session time zone reorder
    values around a clock change.
    """
    dtype, c = df.schema[name].dataType, col(name)
    if isinstance(dtype, T.TimestampNTZType):
        seconds = F.hour(c) * 3600 + F.minute(c) * 60
        micros = (F.extract(F.lit("SECOND"), c) * 1000000).cast("bigint")
        return (F.unix_date(F.to_date(c)).cast("bigint") * 86400000000
                + seconds.cast("bigint") * 1000000 + micros).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return without_nan(c.cast("double"))
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    raise TypeError(f"{name}: {dtype.simpleString()} has no numeric order; order by a number, date or timestamp")


def digest(*values, seed=None) -> Column:
    """MD5 of the values and the seed, each written after its length in characters and NULL as a mark of its own, so that
    two different lists of values never give the same text."""
    parts = [F.lit(str(seed))] if seed is not None else []
    texts = [*parts, *[v.cast("string") for v in values]]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts]).cast("binary"))


def shuffled_order(values: Sequence[Column], seed) -> tuple[Column, Column]:
    """A seeded, repeatable random order: two 52-bit halves of a digest, each exact as a double. Different values, NULL and
    empty text among them, give different digests: several are written with their lengths, one alone follows the seed."""
    if len(values) > 1:
        text = digest(*values, seed=seed)
    else:
        text = F.md5(F.concat_ws("|", F.lit(str(seed)), *[v.cast("string") for v in values]).cast("binary"))
    half = lambda start: F.conv(F.substring(text, start, 13), 16, 10).cast("double")
    return half(1), half(14)


def stable_bucket(key: Column, n: int) -> Column:
    """Bucket 0..n-1 from the first 32 bits of a digest; the same in every engine that has md5."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint"),
                  F.lit(n).cast("bigint"))


def at_least(score: Column, cut: Column | float) -> Column:
    return F.when(score >= _lit(cut), 1).otherwise(0)


def risk_band(score: Column, high: Column | float, medium: Column | float) -> Column:
    return (F.when(score >= _lit(high), "HIGH")
            .when(score >= _lit(medium), "MEDIUM").otherwise("LOW"))


def best_class(probabilities: Column, labels: Sequence[str]) -> tuple[Column, Column]:
    """(confidence, label) of an array of class probabilities; the first class wins a tie."""
    best = F.array_max(probabilities)
    names = F.array(*[F.lit(str(x)) for x in labels])
    return best, F.element_at(names, F.array_position(probabilities, best).cast("int"))


def label_as(task: str, value: Column) -> Column:
    return value.try_cast(LABEL_TYPE[task])


def cohort_of(ts: Column) -> Column:
    """Integer YYYYMM of a timestamp."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def cohort_start(cohort: Column) -> Column:
    """First moment of a YYYYMM cohort, NULL when the value is not one."""
    text = cohort.cast("string")
    return F.try_to_timestamp(F.concat(text, F.lit("01")), F.lit("yyyyMMdd")).cast("timestamp_ntz")


def matures_at(ts: Column, horizon_days: int) -> Column:
    return ts + F.make_interval(days=F.lit(int(horizon_days)))


def midnight(now: Column) -> Column:
    return F.date_trunc("day", now).cast("timestamp_ntz")


def linear_margin(weights: dict[str, float], intercept: float) -> Column:
    margin = F.lit(float(intercept))
    for name, weight in weights.items():
        margin = margin + col(name) * F.lit(float(weight))
    return margin


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def ranked_causes(contributions: dict[str, Column], top: int) -> Column:
    """Names of the `top` largest positive contributions, joined by ' | '; NULL when there is none.

    Sorted per row on an array, so no shuffle. Equal contributions fall back to the name.
    """
    entries = F.array(*[
        F.struct((-value).alias("key"), F.lit(name).alias("name")) for name, value in contributions.items()
    ])
    return causes_from(F.filter(entries, lambda e: e["key"] < 0), top)


def causes_from(entries: Column, top: int) -> Column:
    """`entries`: array of (key = negated contribution, name), positive contributions only."""
    names = F.transform(F.slice(F.array_sort(entries), 1, top), lambda e: e["name"])
    return F.when(F.size(entries) > 0, F.array_join(names, " | "))


def json_number(text: Column, field: str) -> Column:
    """A field of a JSON text as double; NULL for broken JSON, a missing field or a non-number."""
    return F.try_variant_get(F.try_parse_json(text), f"$.{field}", "double")


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
