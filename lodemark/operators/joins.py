"""Equi joins that stay balanced when one key holds a large share of the rows, and the as-of joins."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodemark.functions.columns import as_ordinal, col

HOT_ROWS = 1_000_000    # rows from which a single key is worth splitting
ROWS_PER_SALT = 500_000
SKETCH_KEYS, SKETCH_SIZE = 10_000, 100_000   # of the key sketch: every key with more than 1/SKETCH_KEYS of the rows is in it
NULL_SALTS = 10_000     # rows with a NULL key match nothing and are spread this far


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest by `ts`, then by the tie-break columns, all descending.

    Spark keeps only the first row per key and map task before it shuffles (WindowGroupLimit), so a hot key costs
    one row per task.
    """
    order = [col(ts).desc_nulls_last(), *[col(t).desc_nulls_last() for t in tiebreak]]
    newest = F.row_number().over(Window.partitionBy(*[col(k) for k in keys]).orderBy(*order))
    return df.withColumn("_RN", newest).where("_RN = 1").drop("_RN")


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[col(k) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> dict[int, int]:
    """Salts of the keys with more than `hot_rows` rows, by the key's hash.

    A sketch of bounded size per task counts the keys while the key columns are read; no row is shuffled. It may miss only
    keys with less than one SKETCH_KEYS-th of all rows, so the largest unsplit key shrinks with the cluster's share of work.
    """
    hashed = df.select(key_hash(keys).alias("_H"))
    found = hashed.agg(F.expr(f"approx_top_k(_H, {SKETCH_KEYS}, {SKETCH_SIZE})").alias("top")).first()["top"] or []
    per_salt = min(hot_rows, ROWS_PER_SALT)
    return {r["item"]: max(math.ceil(r["count"] / per_salt), 2) for r in found if r["count"] > hot_rows}


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Equi join of many rows with a side that holds one row per key.

    When the left has hot keys, their rows are spread over salts and the single right row is copied to each salt; rows
    with a NULL key cannot match and are spread as well. Without hot keys this is the plain join. Column names other
    than the keys must differ.
    """
    keys = list(keys)
    hot = hot_keys(left, keys, hot_rows)
    if not hot:
        return left.join(right, keys, how)
    right = right.select(*[col(k).cast(left.schema[k].dataType).alias(k) if k in keys else col(k) for k in right.columns])
    salts = F.broadcast(left.sparkSession.createDataFrame(list(hot.items()), "_H bigint, _SALTS int"))   # at most SKETCH_KEYS rows
    spread = F.pmod(F.xxhash64(*[col(c) for c in left.columns], F.spark_partition_id()), F.lit(1 << 31))
    ways = F.when(_any_null(keys), F.lit(NULL_SALTS)).otherwise(F.coalesce(F.col("_SALTS"), F.lit(1)))
    salted_left = (left.withColumn("_H", key_hash(keys)).join(salts, "_H", "left")
                   .withColumn("_SALT", F.pmod(spread, ways).cast("int")).drop("_SALTS", "_H"))
    salted_right = (right.withColumn("_H", key_hash(keys)).join(salts, "_H", "left")
                    .withColumn("_SALT", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_SALTS"), F.lit(1)) - 1)))
                    .drop("_SALTS", "_H"))
    return salted_left.join(salted_right, [*keys, "_SALT"], how).drop("_SALT")


def asof_for_unique(spine: DataFrame, feed: DataFrame, keys: Sequence[str], spine_ts: str, feed_ts: str,
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """For a spine of one row per key: the newest feed row at or before its timestamp. Keys without one are dropped."""
    dated = salted_join(feed, spine, keys).where(col(feed_ts) <= col(spine_ts))
    return latest_per_key(dated, keys, feed_ts, tiebreak)


def asof_lookup(spine: DataFrame, features: DataFrame, keys: Sequence[str], spine_ts: str, feature_ts: str,
                tiebreak: Sequence[str] = (), rows_per_slice: int | None = None) -> DataFrame:
    """Adds to every spine row the newest feature row of its keys at or before `spine_ts` (NULLs where there is none).

    Both sides are merged into one timeline and the last feature seen is carried forward, so no pair is ever built.
    The timeline is cut at fixed times: a hot key becomes many (key, slice) groups, and what a slice inherits from the
    earlier ones is a single row.
    """
    from lodemark.operators.ranking import SLICE_ROWS, quantile_edges, sliced

    keys = list(keys)
    values = [c for c in features.columns if c not in keys]
    payload = F.struct(*[col(c) for c in values])
    versions = latest_per_key(features, [*keys, feature_ts], feature_ts, tiebreak)
    dated = versions.select(*keys, as_ordinal(features, feature_ts).alias("_AT"), F.lit(0).alias("_KIND"),
                            payload.alias("_ROW"))
    points = spine.select(*keys, as_ordinal(spine, spine_ts).alias("_AT")).distinct()
    timeline = dated.unionByName(points.withColumn("_KIND", F.lit(1)), allowMissingColumns=True)

    _, edges = quantile_edges(timeline, "_AT", rows_per_slice or SLICE_ROWS)
    timeline = sliced(timeline, "_AT", edges, "_SLICE")
    seen = (Window.partitionBy(*keys, "_SLICE").orderBy("_AT", "_KIND")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = timeline.withColumn("_ROW", F.last("_ROW", ignorenulls=True).over(seen)).where("_KIND = 1")
    if edges:
        earlier = Window.partitionBy(*keys).orderBy("_SLICE").rowsBetween(Window.unboundedPreceding, -1)
        closing = (timeline.groupBy(*keys, "_SLICE")
                   .agg(F.max_by("_ROW", F.when(F.col("_ROW").isNotNull(), F.col("_AT"))).alias("_END"))
                   .select(*keys, "_SLICE", F.last("_END", ignorenulls=True).over(earlier).alias("_BEFORE")))
        filled = (filled.join(closing, [*keys, "_SLICE"], "left")
                  .withColumn("_ROW", F.coalesce("_ROW", "_BEFORE")))
    answers = filled.select(*keys, "_AT", "_ROW")
    stamped = spine.withColumn("_AT", as_ordinal(spine, spine_ts))
    joined = salted_join(stamped, answers, [*keys, "_AT"], "left")
    return joined.select(*[col(c) for c in spine.columns], *[F.col("_ROW").getField(v).alias(v) for v in values])


def _any_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | col(k).isNull()
    return out
