"""What the operators share: whole rows kept beside their keys, word and shingle rules, gapless ranks over many tasks."""

from __future__ import annotations

import os
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
MAX_BUCKETS = 65_536
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(columns: Sequence[str]) -> Column:
    """Input columns as one struct, so that no name among them can clash with a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")


def unpacked(df: DataFrame, columns: Sequence[str], **outputs: Column) -> DataFrame:
    """The packed columns and the outputs; an input column with the name of an output gives way to it."""
    taken = {c.lower() for c in outputs}
    kept = [F.col(f"row.`{c}`").alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in outputs.items()])


def hex_share(text: Column, first: int = 1) -> Column:
    """Eight hex digits of an MD5 as a number in [0, 1)."""
    return F.conv(F.substring(text, first, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def gapless_rank(df: DataFrame, group: Sequence[str], share: str, order: Sequence[str], rows: int, bucket_rows: int = 2_000,
                 counted: DataFrame | None = None) -> DataFrame:
    """Adds `rank`, from 1 without gaps within each group, by the column `share` in [0, 1) and then `order`.

    Rows are cut into buckets of `share`; a bucket's rows are ranked together and start after the rows of the buckets
    before it, whose counts are summed on the map side. A group of any size is therefore ranked by many tasks. `counted` may
    be a cheaper table with the same rows, from which the counts are taken.
    """
    buckets = max(1, min(MAX_BUCKETS, -(-rows // bucket_rows)))
    bucket = F.least(F.floor(F.col(share) * buckets), F.lit(buckets - 1)).alias("bucket")
    keys = [*group, "bucket"]
    counts = (counted if counted is not None else df).groupBy(*group, bucket).count()
    before = Window.partitionBy(*[F.col(g) for g in group]).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy(*keys).orderBy(share, *order)
    ranked = df.withColumn("bucket", bucket).join(starts, keys)
    return ranked.withColumn("rank", F.row_number().over(within) + F.col("before")).drop("bucket", "before")


def words(text: str) -> list[bytes]:
    """Maximal runs of characters other than the space and U+0009 to U+000D, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def lowered(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER)


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct runs of `size` words as sorted 64-bit hashes; all words as one run if there are fewer; empty without words.

    A-Z is lower-cased. Each word's hash comes from Python's string hash, which Spark's workers seed alike, so equal words
    have equal hashes in every task; a run's hash depends on the order of its words.
    """
    if not text:
        return np.empty(0, np.int64)
    found = lowered(text).split()
    if not found:
        return np.empty(0, np.int64)
    if "PYTHONHASHSEED" not in os.environ:
        raise RuntimeError("PYTHONHASHSEED must be set alike for all Python workers, as Spark does")
    codes = np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64)
    run = min(size, len(found))
    out = np.full(len(found) - run + 1, len(found) if len(found) < size else 0, np.uint64)
    for k in range(run):
        out = (out ^ codes[k:len(codes) - run + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique((out ^ (out >> np.uint64(32))).view(np.int64))
