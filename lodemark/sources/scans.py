"""Table scans. Filters and projections put on the result reach the parquet reader."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodemark.functions.columns import col, midnight

BEGINNING = "1900-01-01 00:00:00"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def load_source(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A parquet table with upper-case column names, optionally only some of them."""
    df = spark.read.parquet(path)
    df = df.toDF(*[c.upper() for c in df.columns])
    return df.select(*[col(c.upper()) for c in columns]) if columns else df


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """The same for a catalog table."""
    df = spark.table(name)
    return df.toDF(*[c.upper() for c in df.columns])


def incremental_rows(feed: DataFrame, ts: str, watermark: Column | str | None, now: Column) -> DataFrame:
    """Feed rows after the watermark and up to today's midnight inclusive; from the beginning without a watermark."""
    start = F.lit(BEGINNING).cast("timestamp_ntz") if watermark is None else watermark
    start = start if isinstance(start, Column) else F.lit(start).cast("timestamp_ntz")
    return feed.where((col(ts) > start) & (col(ts) <= midnight(now)))


def batch_bounds(batch: DataFrame, ts: str) -> DataFrame:
    """Rows of a batch and the watermark it advances to."""
    return batch.agg(F.count("*").alias("N_ROWS"), F.max(col(ts)).alias("NEW_WATERMARK"))


def late_rows(feed: DataFrame, scored: DataFrame, ts: str, watermark: Column | str, row_id: list[str]) -> DataFrame:
    """Feed rows at or before the watermark that were never scored: they arrived too late for their batch."""
    start = watermark if isinstance(watermark, Column) else F.lit(watermark).cast("timestamp_ntz")
    return feed.where(col(ts) <= start).join(scored.select(*[col(c) for c in row_id]), row_id, "left_anti")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or a checkpoint folder set on the context.

    Without either, a local session (one machine, as in tests) gets a temporary folder of its own; a cluster session is
    refused, because its executors could not read back what one of them wrote to a local disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lodemark-"))
    return context.getCheckpointDir()


_changing = threading.Lock()
_changed: dict[tuple[str, str], tuple[int, str]] = {}   # per session and setting: who needs it changed, and its value from before


@contextmanager
def changed_setting(spark: SparkSession, name: str, value: str):
    """A setting of the session for the time of a query. Threads may work side by side: the first one in changes the setting, the
    last one out puts back what it found."""
    key = spark._jsparkSession.sessionUUID(), name
    with _changing:
        users, before = _changed.get(key) or (0, spark.conf.get(name))
        _changed[key] = users + 1, before
        spark.conf.set(name, value)
    try:
        yield
    finally:
        with _changing:
            users, before = _changed[key]
            if users > 1:
                _changed[key] = users - 1, before
            else:
                del _changed[key]
                spark.conf.set(name, before)


class Scratch:
    """Intermediate tables in the shared folder. drop() removes one early; the rest goes when the driver's JVM ends.

    A written table needs none of the shuffle files it was made from, so those are removed as soon as the write is done.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_folder(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self._path(self.root, lambda fs, path: fs.deleteOnExit(path))

    def _path(self, name: str, act):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        return act(path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path)

    def write(self, df: DataFrame, **options) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex}"
        with changed_setting(self.spark, CLEANUP, "true"):  # shuffle files go after the query
            df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self._path(table._scratch_path, lambda fs, path: fs.delete(path, True))


def staged(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read back: reused by several jobs, and safe when executors go."""
    return Scratch(df.sparkSession).write(df)
