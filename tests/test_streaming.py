"""The stream writes what the batch job writes, once per row, and only new files on a restart."""

from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from lodemark.operators.learners import assembler
from lodemark.operators.monitoring import baseline_bins, drift_windows
from lodemark.plans.scoring import score_batch
from lodemark.sources import fixtures as X
from lodemark.sources.scans import shared_folder, staged
from lodemark.sources.store import Store
from lodemark.streaming.feeds import drift_stream, labeled_stream, record_late, score_stream


@pytest.fixture(scope="module")
def model(spark, data):
    shared_folder(spark)
    rows = staged(X.scored(spark, data).select(*X.CONTRACT.encoded, F.col("Y_BIN").cast("double").alias("label")))
    stage = assembler(X.CONTRACT)
    return PipelineModel([stage, LogisticRegression(featuresCol="_FEATURES", maxIter=5).fit(stage.transform(rows))])


def deployed(spark, model, root) -> Store:
    from datetime import datetime
    use_case = replace(X.USE_CASE, data=replace(X.DATA, categorical=("PRIORITY",), numeric=("TOTAL_PRICE", "ACCT_BAL", "N_LINES"), passthrough=()))
    store = Store(spark, str(root), use_case)
    store.save_model(model, "V1")
    store.save_contract(X.CONTRACT, "V1", F.lit("2000-01-01"))
    store.log_run("V1", "logistic_regression", {"threshold": 0.3}, {
        "risk_cut_high": 0.3, "risk_cut_medium": 0.2, "impute_values": X.IMPUTE,
        "feature_means": dict.fromkeys(X.CONTRACT.encoded, 0.0)}, datetime(2000, 1, 1))
    return store


def test_stream_equals_batch(spark, data, model, tmp_path):
    feed = staged(X.feed(spark, data))
    batch, stream = deployed(spark, model, tmp_path / "batch"), deployed(spark, model, tmp_path / "stream")
    now = "2031-01-01 00:00:00"
    assert score_batch(batch, feed, now) == f"OK: {feed.count()} rows scored"

    files, checkpoint = str(tmp_path / "files"), str(tmp_path / "checkpoint")
    feed.where("COHORT < 200007").write.parquet(files)
    source = lambda: spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(files)
    score_stream(stream, source(), now, checkpoint).awaitTermination()
    feed.where("COHORT >= 200007").write.mode("append").parquet(files)
    for _ in range(2):  # the second start finds nothing new
        score_stream(stream, source(), now, checkpoint).awaitTermination()

    shown = ["FEED_ROW_ID", "ROW_ID", "PREDICTED_PROBABILITY", "PREDICTION", "RISK_BAND", "PROBABLE_CAUSES", "LABEL_MATURE_AT"]
    a, b = batch.monitor().select(shown), stream.monitor().select(shown)
    assert a.count() == b.count() and a.exceptAll(b).isEmpty()
    assert stream.commits().where("KIND = 'SCORE'").count() >= 2


def test_drift_stream_reports_closed_windows(spark, tmp_path):
    scores = spark.range(400).selectExpr(
        "cast(id % 100 as double) / 100 PREDICTED_PROBABILITY", "int(id % 2) PREDICTION", "bigint(id % 3 = 0) ACTUAL_LABEL",
        "timestamp_ntz'2024-01-01 08:00:00' + make_dt_interval(int(id / 50)) SCORED_AT", "'V1' MODEL_VERSION")
    scores.write.parquet(str(tmp_path / "scores"))
    reference = baseline_bins(scores, "PREDICTED_PROBABILITY")
    stream = spark.readStream.schema(scores.schema).parquet(str(tmp_path / "scores"))
    drift_stream(stream, reference, "binary", str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 6  # eight days, the last two within the allowed lateness
    table = drift_windows(scores, reference, "binary").select(F.round("PSI", 9).alias("p"), "N", "N_LABELED")
    assert got.select(F.round("PSI", 9).alias("p"), "N", "N_LABELED").exceptAll(table).isEmpty()


def test_repeated_and_late_deliveries(spark, data, model, tmp_path):
    """A row in two files is scored once; rows far behind, and rows without a timestamp, are recorded once as late."""
    store, files = deployed(spark, model, tmp_path / "store"), str(tmp_path / "files")
    feed = staged(X.feed(spark, data))
    assert store.late_rows().count() == 0 and store.scored_ids().count() == 0

    def deliver(rows):
        rows.write.mode("append").parquet(files)
        stream = spark.readStream.schema(feed.schema).parquet(files)
        score_stream(store, stream, "2031-01-01 00:00:00", str(tmp_path / "check"), lateness="30 days").awaitTermination()

    untimed = feed.where("COHORT = 200005").limit(3).withColumn("RECORD_TS", F.lit(None).cast("timestamp_ntz"))
    deliver(feed.where("COHORT BETWEEN 200007 AND 200009").unionByName(untimed))
    deliver(feed.where("COHORT BETWEEN 200009 AND 200010"))
    deliver(feed.where("COHORT = 200001"))
    expected = feed.where("COHORT BETWEEN 200007 AND 200010")
    assert sorted(r[0] for r in store.monitor().select("ROW_ID").collect()) == sorted(r[0] for r in expected.select("ROW_ID").collect())

    delivered = spark.read.schema(feed.schema).parquet(files)
    late = feed.where("COHORT = 200001").count() + 3
    assert [record_late(store, delivered, n) for n in ("a", "a", "b")] == [late, late, 0]
    assert store.late_rows().count() == late and store.late_rows().where("RECORD_TS IS NULL").count() == 3
    assert store.late_rows().select(feed.columns).exceptAll(delivered).isEmpty()


def test_streamed_labels_wait_for_their_outcome(spark, tmp_path):
    """In time, at the end of the wait, too late, before scoring, repeated, without a key, none at all."""
    at = "timestamp_ntz'2024-01-01 00:00:00'"
    scores = spark.sql("SELECT * FROM VALUES (1L), (2L), (3L), (4L), (5L), (NULL), (6L), (99L) t(K)").selectExpr(
        "K", f"{at} + make_dt_interval(if(K = 99, 60, 0)) SCORED_AT", "'V1' MODEL_VERSION")
    outcomes = spark.sql("SELECT * FROM VALUES (1L, 3), (2L, 10), (3L, 11), (4L, -1), (5L, 2), (5L, 2), (NULL, 2), (99L, 65) t(K, DAYS)").selectExpr(
        "K", "bigint(1) Y", f"{at} + make_dt_interval(DAYS) OUTCOME_AT")
    for name, rows in (("scores", scores), ("outcomes", outcomes)):
        rows.write.parquet(str(tmp_path / name))
    read = lambda name, rows: spark.readStream.schema(rows.schema).parquet(str(tmp_path / name))
    joined = labeled_stream(read("scores", scores), read("outcomes", outcomes), ["K"], "Y", "OUTCOME_AT", "10 days")
    (joined.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check"))
     .trigger(availableNow=True).start().awaitTermination())
    got = sorted(((r["K"] or 0, r["ACTUAL_LABEL"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)
    assert got == [(0, None), (1, 1), (2, 1), (3, None), (4, None), (5, 1), (6, None), (99, 1)]
