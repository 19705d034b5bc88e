"""The four jobs on one store, in the order they run in production."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodemark.operators.encode import Contract, Feature
from lodemark.plans.labeling import backfill_labels
from lodemark.plans.retraining import retrain
from lodemark.plans.scoring import roll_back, score_batch
from lodemark.plans.training import train
from lodemark.settings import ModelSpec, RetrainSpec, ScoringSpec
from lodemark.sources import fixtures as X
from lodemark.sources.scans import shared_folder, staged
from lodemark.sources.store import Store, upsert

MODEL = ModelSpec(algorithm="logistic_regression", trials=1, fixed_params={"max_iter": 15}, search_space={"C": [0.3]})


@pytest.fixture(scope="module")
def world(spark, data, tmp_path_factory):
    shared_folder(spark)
    use_case = replace(X.USE_CASE, model=MODEL, scoring=ScoringSpec(n_high=50, n_medium=100, business_columns={"ENTITY_ID": "CUSTOMER"}),
                       retrain=RetrainSpec(min_holdout_rows=10_000))
    store = Store(spark, str(tmp_path_factory.mktemp("store")), use_case)
    history, feed = staged(X.history(spark, data)), staged(X.feed(spark, data))
    trained = train(store, history, "V1", "2000-01-02 01:00:00")
    return store, history, feed, trained


def test_life_cycle(spark, data, world):
    store, history, feed, trained = world
    assert trained.strategy == "temporal" and 0 <= trained.metrics["pr_auc"] <= 1
    seeded = store.monitor().count()
    assert seeded == store.baseline("V1").count() and store.monitor().where("ACTUAL_LABEL IS NULL").isEmpty()
    with pytest.raises(ValueError, match="already registered"):
        train(store, history, "v1", "2000-01-02 01:00:00")

    # midnight is inclusive, the run is incremental, an empty batch is skipped
    until = lambda t: feed.where(F.col("RECORD_TS") <= F.lit(t).cast("timestamp_ntz")).count()
    assert score_batch(store, feed, "2000-06-01 05:00:00") == f"OK: {until('2000-06-01')} rows scored"
    assert score_batch(store, feed, "2000-06-01 09:00:00").startswith("SKIPPED")
    assert score_batch(store, feed, "2001-01-01 05:00:00") == f"OK: {until('2001-01-01') - until('2000-06-01')} rows scored"
    monitor = store.monitor().where("RUN_ID <> 'seed'")
    assert monitor.count() == until("2001-01-01") and monitor.select("FEED_ROW_ID").distinct().count() == monitor.count()
    high = store.past_run("V1").extra["risk_cut_high"]
    assert monitor.where((F.col("PREDICTED_PROBABILITY") >= high) != (F.col("RISK_BAND") == "HIGH")).isEmpty()
    assert monitor.where("PREDICTION <> int(RISK_BAND = 'HIGH')").isEmpty()
    assert store.business("CUSTOMER").count() == monitor.select("ENTITY_ID").distinct().count()

    # a late row is never scored by the batch job
    late = feed.limit(1).withColumns({"ROW_ID": F.lit(-1).cast("long"), "RECORD_TS": F.lit("2000-01-15").cast("timestamp_ntz")})
    assert score_batch(store, feed.unionByName(late), "2001-01-01 09:00:00").startswith("SKIPPED")

    # labels: only mature rows, and a repeat labels nothing
    outcomes = staged(X.outcomes(spark, data))
    first = backfill_labels(store, outcomes, "2000-09-15 00:00:00")
    assert 0 < first["newly_labeled"] <= until("2000-06-01")
    assert backfill_labels(store, outcomes, "2000-09-15 00:00:00")["newly_labeled"] == 0
    assert store.monitor().where("LABEL_MATURE_AT > timestamp_ntz'2000-09-15 00:00:00' AND ACTUAL_LABEL IS NOT NULL").isEmpty()
    with pytest.raises(ValueError, match="repeat a ENTITY_ID"):
        backfill_labels(store, outcomes.unionByName(outcomes), "2000-09-15 00:00:00")
    assert store.log_rows(20).where("STATUS = 'FAILED' AND MESSAGE LIKE '%repeat%'").count() == 1

    # too little data to decide: skipped, logged, nothing registered
    done = retrain(store, history, feed, "2001-04-15 00:00:00", "V2", outcomes=outcomes)
    assert done.status == "SKIPPED" and not store.has_model("V2")

    # roll back: unlabeled rows leave, labeled rows stay, and only the former are scored again
    before = store.monitor().where("RUN_ID <> 'seed'")
    labeled, unlabeled = before.where("ACTUAL_LABEL IS NOT NULL").count(), before.where("ACTUAL_LABEL IS NULL").count()
    assert roll_back(store, "V1", "1999-12-31 00:00:00", "2001-05-01 00:00:00") == unlabeled
    assert store.monitor().where("RUN_ID <> 'seed'").count() == labeled
    again = score_batch(store, feed, "2001-05-02 00:00:00")
    assert again == f"OK: {until('2001-05-02') - labeled} rows scored"
    assert store.monitor().where("RUN_ID <> 'seed'").count() == until("2001-05-02")


def test_uncommitted_run_is_invisible(spark, world):
    store, _, _, _ = world
    before = store.scores().count()
    extra = store.run_scores("seed").drop("USE_CASE_NAME", "RUN_ID")
    store.write_scores(extra, "run-crashed", None)
    assert store.scores().count() == before


def test_failed_run_is_logged_and_raised(spark, world):
    store, _, feed, _ = world
    with pytest.raises(ValueError, match="missing column"):
        score_batch(store, feed.drop("SEGMENT"), "2031-01-01 00:00:00")
    assert store.log_rows(1).first()["STATUS"] == "FAILED"


def test_changed_vocabulary_goes_on_scoring(spark, world):
    store, _, feed, _ = world
    before, run = store.monitor().count(), store.past_run("V1")
    store.save_contract(Contract((*store.contract("V1").features, Feature("SEGMENT_NEW", "SEGMENT", "CAT_OHE"))), "V9", F.lit("2001-01-01"))
    store.save_model(store.load_model("V1"), "V9")
    store.log_run("V9", run.algorithm, run.metrics, run.extra, datetime(1990, 1, 1))
    assert score_batch(store, feed, "2031-01-01 00:00:00", version="V9").startswith("OK")
    batch = store.newest_batch()
    assert batch.where("SEGMENT_NEW = 0.0 AND MODEL_VERSION = 'V9'").count() == batch.count() > 0
    assert store.monitor().where("SEGMENT_NEW IS NULL").count() == before
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(USE_CASE_NAME") >= 1 and "RUN_ID" in plan.split("PartitionFilters")[1][:300]


def test_upsert_keeps_unmapped_columns(spark):
    target = spark.createDataFrame([(1, "n1", 0.1), (2, "n2", 0.2)], "k int, name string, s double").withColumn("SYS_UPD_DT", F.lit(None).cast("timestamp_ntz"))
    source = spark.createDataFrame([(2, None), (3, 0.9)], "k int, s double")
    got = {r["k"]: (r["name"], r["s"], r["SYS_UPD_DT"] is not None) for r in upsert(target, source, ["k"], F.lit("2001-01-01").cast("timestamp_ntz")).collect()}
    assert got == {1: ("n1", 0.1, False), 2: ("n2", None, True), 3: (None, 0.9, True)}
