"""Structured Streaming forms of scoring, of labeling and of the drift monitor.

Watermarks need a TIMESTAMP, so a TIMESTAMP_NTZ is read as one in UTC, whatever the session's time zone.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodemark.functions.columns import col
from lodemark.operators.encode import scoring_input
from lodemark.operators.monitoring import Reference, drift_windows
from lodemark.plans.scoring import deploy, write_run
from lodemark.plans.shared import feed_row_id
from lodemark.sources.scans import staged
from lodemark.sources.store import Store


def in_utc(ts: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), col(ts)).cast("timestamp")


def score_stream(store: Store, feed: DataFrame, now: datetime | str, checkpoint: str, version: str | None = None,
                 query_name: str = "scoring", lateness: str | None = None) -> StreamingQuery:
    """Scores a streaming feed as micro-batches into the same tables as `score_batch`, then stops.

    The checkpoint takes the place of the watermark: a row is scored once, when its file arrives, whatever its timestamp;
    so nothing is late and there is no midnight cut. A micro-batch writes a run named by its number, so a replayed one
    overwrites itself.

    With a `lateness`, a row that is delivered in several files is scored once: row ids are remembered until no row of their
    time is taken any more. Rows older than the newest of earlier micro-batches less the `lateness`, and rows without a
    timestamp, are not scored; `record_late` finds them.
    """
    target = deploy(store, version)
    data = store.use_case.data
    rows = scoring_input(feed, target.contract, data, target.fills).withColumn("FEED_ROW_ID", feed_row_id(data.feed_row))
    if lateness is not None:
        timed = rows.where(col(data.watermark).isNotNull()).withColumn("_AT", in_utc(data.watermark)).withWatermark("_AT", lateness)
        rows = timed.dropDuplicatesWithinWatermark(["FEED_ROW_ID"]).drop("_AT")

    def write(batch: DataFrame, number: int):
        if lateness is not None:
            batch = staged(batch)  # several jobs read it, and the state is to move on once
        write_run(store, target, batch, f"stream-{query_name}-{number:012d}", now)

    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .queryName(query_name).trigger(availableNow=True).start())


def record_late(store: Store, delivered: DataFrame, name: str) -> int:
    """Adds the delivered feed rows (a table, not a stream) that no committed run has scored to the side table of late rows,
    each row id once, and returns how many are new there. Call it while no stream is at work on these rows.

    A row id that is scored or recorded already is passed over, so repeated calls add nothing; `name` names the call's
    partition, and a call repeated after a crash overwrites its own.
    """
    ids = delivered.withColumn("FEED_ROW_ID", feed_row_id(store.use_case.data.feed_row))
    recorded = store.late_rows().where(F.col("LATE_RUN") != name).select("FEED_ROW_ID")
    fresh = ids.join(store.scored_ids().unionByName(recorded), "FEED_ROW_ID", "left_anti")
    return store.write_late(staged(fresh.dropDuplicates(["FEED_ROW_ID"])), name)


def labeled_stream(scores: DataFrame, outcomes: DataFrame, keys: Sequence[str], label: str, outcome_ts: str, wait: str,
                   lateness: str = "1 day") -> DataFrame:
    """Streamed scores with the outcome that follows within `wait` of their scoring as ACTUAL_LABEL, NULL where none comes.

    A stream-stream left outer join: a score is held until its outcome comes or the watermark of both streams has passed its
    wait. An outcome delivered again unchanged counts once; of different outcomes of one score within the wait each gives a
    row. Rows with a NULL key never find an outcome.
    """
    held = scores.drop("ACTUAL_LABEL").withColumn("SCORED_AT", in_utc("SCORED_AT")).withWatermark("SCORED_AT", lateness)
    names = [f"_K{i}" for i in range(len(keys))]
    known = (outcomes.select(*[col(k).alias(n) for k, n in zip(keys, names)], col(label).alias("ACTUAL_LABEL"), in_utc(outcome_ts).alias("_OUTCOME_AT"))
             .withWatermark("_OUTCOME_AT", lateness).dropDuplicatesWithinWatermark([*names, "ACTUAL_LABEL", "_OUTCOME_AT"]))
    match = F.col("_OUTCOME_AT").between(F.col("SCORED_AT"), F.col("SCORED_AT") + F.expr(f"INTERVAL {wait}"))
    for k, n in zip(keys, names):
        match = match & (col(k) == F.col(n))
    return held.join(known, match, "left_outer").drop(*names, "_OUTCOME_AT")


def drift_stream(scores: DataFrame, reference: Reference, task: str, out: str, checkpoint: str, duration: str = "1 day",
                 lateness: str = "1 day", available_now: bool = True, every: str = "1 minute") -> StreamingQuery:
    """Appends a drift report per closed window and model version.

    Windows are reported as TIMESTAMP_NTZ again. Rows later than `lateness` come too late for their closed window: Spark drops
    them and counts them in the query's progress (numRowsDroppedByWatermark).
    """
    stamped = scores.withColumn("SCORED_AT", in_utc("SCORED_AT")).withWatermark("SCORED_AT", lateness)
    if "ACTUAL_LABEL" not in stamped.columns:
        stamped = stamped.withColumn("ACTUAL_LABEL", F.lit(None).cast("double"))
    return _report(stamped, reference, task, out, checkpoint, duration, available_now, every)


def accuracy_stream(scores: DataFrame, outcomes: DataFrame, keys: Sequence[str], label: str, outcome_ts: str, wait: str,
                    reference: Reference, task: str, out: str, checkpoint: str, duration: str = "1 day", lateness: str = "1 day",
                    available_now: bool = True, every: str = "1 minute") -> StreamingQuery:
    """The drift report with labels that arrive as a stream of their own, see `labeled_stream`. A window is closed, and
    reported, once the watermark has passed its end by `wait`: no outcome can change its accuracy any more."""
    joined = labeled_stream(scores, outcomes, keys, label, outcome_ts, wait, lateness)
    return _report(joined, reference, task, out, checkpoint, duration, available_now, every)


def _report(rows: DataFrame, reference: Reference, task: str, out: str, checkpoint: str, duration: str, available_now: bool,
            every: str) -> StreamingQuery:
    report = drift_windows(rows, reference, task, duration)
    report = report.withColumn("WINDOW_START", F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("WINDOW_START").cast("timestamp_ntz")))
    writer = report.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()
