"""Two writers at once, commits left half done, runs that lost their turn, and session settings under parallel staging."""

from dataclasses import replace
from datetime import datetime
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from lodemark.plans.scoring import score_batch
from lodemark.plans.training import train
from lodemark.settings import ModelSpec, ScoringSpec
from lodemark.sources import fixtures as X
from lodemark.sources.scans import CLEANUP, shared_folder, staged
from lodemark.sources.store import Store, create_once

MODEL = ModelSpec(algorithm="logistic_regression", trials=1, fixed_params={"max_iter": 10}, search_space={"C": [0.3]})
AT, LATER = datetime(2000, 6, 1, 5), datetime(2000, 5, 31)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), X.USE_CASE)


def test_a_file_is_created_once_and_whole(spark, tmp_path):
    texts = [str(i) * 1000 for i in range(8)]
    with ThreadPool(8) as pool:
        won = pool.map(lambda t: create_once(spark, str(tmp_path / "claims" / "one"), t), texts)
    assert sum(won) == 1
    assert (tmp_path / "claims" / "one").read_text() == texts[won.index(True)]
    assert [f.name for f in (tmp_path / "claims").iterdir() if not f.name.startswith(".")] == ["one"]


def test_one_of_many_commits_takes_the_turn(store):
    turn = store.turn()
    assert turn == (None, 0)
    with ThreadPool(4) as pool:
        won = pool.map(lambda i: store.commit_once(f"run-{i}", turn, LATER, AT), range(4))
    assert sum(won) == 1 and store.commits().count() == 1
    assert store.turn() == (LATER, 0)
    assert not store.commit_once("run-late", turn, AT, AT)
    store.reset_watermark(datetime(2000, 1, 1), datetime(2000, 6, 2))
    assert store.turn() == (datetime(2000, 1, 1), 1)


def test_a_claim_without_its_commit_row_is_completed(store, monkeypatch):
    def dies(*_):
        raise RuntimeError("executor and driver gone")

    turn = store.turn()
    with monkeypatch.context() as m:
        m.setattr(Store, "commit", dies)
        with pytest.raises(RuntimeError, match="gone"):
            store.commit_once("run-1", turn, LATER, AT)
    assert store.commits().isEmpty()
    assert store.turn() == (LATER, 0)
    row = store.commits().first()
    assert (row["RUN_ID"], row["LAST_RECORD_TS"], row["UPDATED_AT"], row["KIND"]) == ("run-1", LATER, AT, "SCORE")
    assert store.turn() == (LATER, 0) and store.commits().count() == 1


def test_two_runs_of_different_days_at_once_score_every_row_once(spark, data, store):
    shared_folder(spark)
    store.use_case = replace(X.USE_CASE, model=MODEL, scoring=ScoringSpec(n_high=50, n_medium=100, business_columns={"ENTITY_ID": "CUSTOMER"}))
    feed = staged(X.feed(spark, data))
    train(store, staged(X.history(spark, data)), "V1", "2000-01-02 01:00:00")
    days = ("2000-06-01 05:00:00", "2000-06-02 05:00:00")
    with ThreadPool(2) as pool:
        said = pool.map(lambda now: score_batch(Store(spark, store.root, store.use_case), feed, now), days)
    for now in days:
        score_batch(store, feed, now)   # whoever won, the last day is reached
    assert any(s.startswith("OK") for s in said)
    scored = store.monitor().where("RUN_ID <> 'seed'")
    want = feed.where(F.col("RECORD_TS") <= F.lit("2000-06-02").cast("timestamp_ntz")).count()
    assert scored.count() == want == scored.select("FEED_ROW_ID").distinct().count()
    lost = store.drop_uncommitted()
    assert len(lost) == sum("another run" in s for s in said) and store.monitor().where("RUN_ID <> 'seed'").count() == want
    messages = [r["MESSAGE"] for r in store.log_rows(10).collect()]
    assert len(messages) == 4 and messages.count("another run scored these rows first") == len(lost)
    store.write_scores(store.run_scores("seed").drop("USE_CASE_NAME", "RUN_ID"), "run-crashed", None)
    assert store.drop_uncommitted() == ["run-crashed"] and store.run_scores("run-crashed").isEmpty()
    assert store.monitor().where("RUN_ID <> 'seed'").count() == want


def test_parallel_staging_leaves_the_session_as_it_was(spark):
    shared_folder(spark)
    before = spark.conf.get(CLEANUP)
    with ThreadPool(4) as pool:
        pool.map(lambda i: staged(spark.range(i)).count(), range(16))
    assert spark.conf.get(CLEANUP) == before
