"""Learners, explanations of trees, and the four jobs end to end. Fitted values are not in SQL; counts and invariants are."""

from __future__ import annotations

import math
import uuid
from dataclasses import replace
from multiprocessing.pool import ThreadPool

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodemark.catalog import query
from lodemark.catalog.tables import new_store
from lodemark.functions.columns import col
from lodemark.operators import encode as E
from lodemark.operators import learners as L
from lodemark.operators.boosting import FEATURES as VECTOR, LABEL, VALIDATES, Booster, BoosterSpec
from lodemark.operators.explain import causes_of_array
from lodemark.operators.metrics import ranking_metrics, regression_metrics
from lodemark.operators.splits import search_fit_rows
from lodemark.operators.targets import prepare_target
from lodemark.plans.labeling import backfill_labels
from lodemark.plans.retraining import retrain
from lodemark.plans.scoring import score_batch
from lodemark.plans.training import train
from lodemark.settings import ModelSpec, RetrainSpec, ScoringSpec
from lodemark.sources import fixtures as X
from lodemark.sources.fixtures import BASE_SQL, FEED_SQL, OUTCOMES_SQL, with_sql
from lodemark.sources.scans import shared_folder, staged
from lodemark.sources.store import Store
from lodemark.streaming.feeds import record_late, score_stream

SMALL_SPACE = {"max_depth": [2, 3], "learning_rate": [0.1, 0.3], "use_scale_pos_weight": True}
SMALL = ModelSpec(algorithm="xgboost", trials=2, fixed_params={"n_estimators": 3}, search_space=SMALL_SPACE)
TARGETS = {"binary": "Y_BIN", "multiclass": "Y_MULTI", "regression": "Y_REG"}
FEATURES = replace(X.DATA, categorical=("PRIORITY", "SEGMENT"), numeric=("ACCT_BAL", "N_LINES", "QTY"), median_impute=())


def encoded(spark, d, task: str, rows=None):
    """(encoded rows with a numeric target, contract) of the whole base table."""
    shared_folder(spark)
    source, _ = prepare_target(X.base(spark, d) if rows is None else rows, TARGETS[task], task)
    contract = E.fit_contract(source, FEATURES)
    fills = {"N_LINES": 0.0, "QTY": 0.0}
    return staged(E.encode(source, contract, ["ROW_ID", "COHORT", TARGETS[task]], fills)), contract


def fitted(spark, d, algorithm: str, task: str, params: dict):
    rows, contract = encoded(spark, d, task)
    model = L.fit(rows, TARGETS[task], contract, algorithm, params, 7, task, rows.count())
    return rows, contract, model


def better_than_naive(rows, model, scored, target: str, task: str) -> bool:
    """Whether the scores tell more than a constant would: less error, an area of 0.6, or likelier classes than by their shares."""
    if task == "regression":
        spread = scored.agg(F.stddev_pop(target)).first()[0]
        return regression_metrics(scored, target, "YHAT").first()["rmse"] < spread
    if task == "binary":
        return ranking_metrics(scored, target, "SCORE").first()["roc_auc"] > 0.6
    chances, _ = L.class_probabilities(model)
    own = F.element_at(chances, col(target).cast("int") + 1)
    n = rows.count()
    shares = [r["count"] / n for r in rows.groupBy(col(target)).count().collect()]
    return model.transform(rows).agg(F.avg(F.log(own))).first()[0] > sum(s * math.log(s) for s in shares)


def score_ranges(algorithm: str, task: str, params: dict):
    """Scores of every row by a model of this kind; how many rows, how many scores outside what the task allows, and whether
    they beat a constant."""
    def run(spark, d):
        rows, _, model = fitted(spark, d, algorithm, task, params)
        scored = staged(L.score(model, rows, task))
        allowed = F.col("SCORE").isNotNull() if task == "regression" else F.col("SCORE").between(0.0, 1.0)
        better = better_than_naive(rows, model, scored, TARGETS[task], task)
        return scored.agg(F.count("*").alias("N"), F.count_if(~allowed | F.col("SCORE").isNull()).alias("N_BAD"), F.lit(better).alias("BETTER"))
    return run


GOOD_SCORES = with_sql(BASE_SQL, select="SELECT count(*) AS N, CAST(0 AS BIGINT) AS N_BAD, true AS BETTER FROM base")
EVERY_ROW = with_sql(BASE_SQL, select="SELECT count(*) AS N, CAST(0 AS BIGINT) AS N_BAD FROM base")
BOOST, FOREST, LINEAR = {"n_estimators": 3, "max_depth": 3}, {"n_estimators": 4, "max_depth": 4}, {"C": 0.3, "max_iter": 30}
KINDS = {
    "boosted_scores_binary": ("xgboost", "binary", {**BOOST, "scale_pos_weight": 2.0}),
    "boosted_scores_multiclass": ("xgboost", "multiclass", BOOST),
    "boosted_scores_regression": ("lightgbm", "regression", {"n_estimators": 3, "num_leaves": 7}),
    "forest_scores_binary": ("random_forest", "binary", FOREST),
    "forest_scores_multiclass": ("random_forest", "multiclass", FOREST),
    "forest_scores_regression": ("random_forest", "regression", FOREST),
    "logistic_scores_binary": ("logistic_regression", "binary", {**LINEAR, "class_weight": "balanced"}),
    "logistic_scores_multiclass": ("logistic_regression", "multiclass", LINEAR),
    "linear_scores_regression": ("logistic_regression", "regression", LINEAR),
}
for _name, _kind in KINDS.items():
    query(_name, GOOD_SCORES)(score_ranges(*_kind))


def unexplained(model, explained, base: list[float], task: str):
    """Whether a row's contributions and the base value fail to add up to what the model said of it."""
    total = F.aggregate("PHI", F.lit(0.0), lambda a, b: a + b)
    if task == "multiclass":
        total = total + F.get(F.array(*[F.lit(float(v)) for v in base]), F.col("YHAT"))
    else:
        total = total + F.lit(float(base[-1]))
    # a booster's probability is the logistic of its margin
    said = F.log(F.col("SCORE") / (1 - F.col("SCORE"))) if L.is_booster(model) and task == "binary" else F.col("SCORE")
    off = F.abs(total - said) > 1e-6 * F.greatest(F.abs(said), F.lit(1.0))
    return off | off.isNull()


def additivity(algorithm: str, task: str, params: dict):
    """Every row's contributions must add up, with the base value, to what the model said."""
    def run(spark, d):
        rows, contract, model = fitted(spark, d, algorithm, task, params)
        explained, _ = L.contributions(model, L.score(model, rows, task), contract, {}, task)
        off = unexplained(model, explained, L.leaves(model, task).base(), task)
        return explained.agg(F.count("*").alias("N"), F.count_if(off).alias("N_BAD"))
    return run


query("tree_contributions_boosted", EVERY_ROW)(additivity("xgboost", "binary", BOOST))
query("tree_contributions_forest", EVERY_ROW)(additivity("random_forest", "multiclass", FOREST))
query("tree_contributions_regression", EVERY_ROW)(additivity("xgboost", "regression", BOOST))


@query("tree_causes", with_sql(BASE_SQL, select="SELECT ROW_ID, true AS ADDS_UP, true AS IN_ORDER, true AS ALL_NAMED FROM base"))
def tree_causes(spark, d):
    """Causes of every row by a booster: its contributions add up to its score; the causes are its largest positive ones, falling,
    and fewer than three only where fewer are positive."""
    rows, contract, model = fitted(spark, d, "xgboost", "binary", BOOST)
    explained, sources = L.contributions(model, L.score(model, rows, "binary"), contract, {}, "binary")
    off = unexplained(model, explained, L.leaves(model, "binary").base(), "binary")
    told = explained.select("ROW_ID", "PHI", off.alias("OFF"), causes_of_array(F.col("PHI"), sources, 3).alias("PROBABLE_CAUSES"))
    names = F.array(*[F.lit(s) for s in sources])
    named = F.filter(F.split(F.coalesce("PROBABLE_CAUSES", F.lit("")), r" \| "), lambda c: c != "")
    weights = F.transform(named, lambda c: F.get("PHI", F.array_position(names, c).cast("int") - 1))
    positive = F.filter("PHI", lambda v: v > 0)
    largest = F.slice(F.reverse(F.array_sort(positive)), 1, 3)
    return told.select("ROW_ID", (~F.col("OFF")).alias("ADDS_UP"), (weights == largest).alias("IN_ORDER"),
                       (F.size(named) == F.least(F.size(positive), F.lit(3))).alias("ALL_NAMED"))


@query("search_trials", "SELECT RANK, true AS IN_ORDER, true AS IN_RANGE, true AS IN_SPACE FROM (VALUES (1), (2)) v(RANK)")
def search_trials(spark, d):
    """Random search on the early cohorts, judged on the late ones: as many trials as asked for, the best validation score
    first, average precisions, and parameters of the space only."""
    rows, contract = encoded(spark, d, "binary")
    use_case = replace(X.USE_CASE, model=SMALL)
    fits = search_fit_rows(rows, "COHORT", 0.2, ["ROW_ID"])
    trials = L.search(rows, ~fits, "Y_BIN", contract, use_case).trials
    by_rank = Window.orderBy(F.desc("VAL_SCORE"), "TRIAL")  # one row per trial
    placed = trials.withColumn("AT", F.monotonically_increasing_id()).withColumn("RANK", F.row_number().over(by_rank))
    drawn = F.from_json("PARAMS_JSON", "max_depth int, learning_rate double, scale_pos_weight double")
    known = drawn["max_depth"].isin(SMALL_SPACE["max_depth"]) & drawn["learning_rate"].isin(SMALL_SPACE["learning_rate"]) & (drawn["scale_pos_weight"] >= 1)
    order = F.coalesce(F.col("AT") > F.lag("AT").over(Window.orderBy("RANK")), F.lit(True))
    return placed.select("RANK", order.alias("IN_ORDER"), F.col("VAL_SCORE").between(0.0, 1.0).alias("IN_RANGE"), known.alias("IN_SPACE"))


@query("final_rounds", with_sql(BASE_SQL, select="SELECT count(*) AS N, true AS TENTH_MORE, true AS WITHIN FROM base"))
def final_rounds(spark, d):
    """The final booster takes a tenth more rounds than the trial kept: here, learning slowly, more than the least of 50."""
    rows, contract = encoded(spark, d, "binary")
    slow = ModelSpec(algorithm="xgboost", trials=1, fixed_params={"n_estimators": 60, "eval_metric": "logloss"},
                     search_space={"max_depth": [1], "learning_rate": [0.05]})
    found = L.search(rows, ~search_fit_rows(rows, "COHORT", 0.2, ["ROW_ID"]), "Y_BIN", contract, replace(X.USE_CASE, model=slow))
    kept = found.trials.first()["BEST_ITERATION"]
    return rows.agg(F.count("*").alias("N"), F.lit(found.rounds == max(int(kept * 1.1), 50)).alias("TENTH_MORE"), F.lit(50 < found.rounds <= 66).alias("WITHIN"))


def stopped(task: str, spec: BoosterSpec, patience: int):
    """A booster that stops by its held losses: the rounds kept are those of the least loss, and growth ended either
    `patience` rounds after them or at the most rounds."""
    def run(spark, d):
        rows, contract = encoded(spark, d, task)
        held = ~search_fit_rows(rows, "COHORT", 0.2, ["ROW_ID"])
        data = L.assembler(contract).transform(rows).select(VECTOR, col(TARGETS[task]).cast("double").alias(LABEL), held.alias(VALIDATES))
        classes = int(data.agg(F.max(LABEL)).first()[0]) + 1
        booster = Booster(data, task, classes, spec)
        best = booster.grow_with_patience(patience)
        seen = booster.losses[:best + patience]
        return rows.agg(F.count("*").alias("N"), F.lit(len(booster.losses) == booster.rounds).alias("ALL_RECORDED"),
                        F.lit(seen[best - 1] == min(seen)).alias("LEAST_LOSS"),
                        F.lit(booster.rounds == spec.rounds or booster.rounds >= best + patience).alias("ENDED"))
    return run


STOPPED = with_sql(BASE_SQL, select="SELECT count(*) AS N, true AS ALL_RECORDED, true AS LEAST_LOSS, true AS ENDED FROM base")
query("boosting_stop_binary", STOPPED)(stopped("binary", BoosterSpec(rounds=40, depth=3, learning_rate=0.8, reg_lambda=1.0), 5))
query("boosting_stop_multiclass", STOPPED)(stopped("multiclass", BoosterSpec(rounds=20, depth=2, learning_rate=0.8, reg_lambda=1.0), 3))
query("boosting_stop_regression", STOPPED)(stopped("regression", BoosterSpec(rounds=20, depth=3, learning_rate=0.8, reg_alpha=0.1), 3))


@query("boosting_resumed", with_sql(BASE_SQL, select="SELECT ROW_ID, true AS SAME FROM base"))
def boosting_resumed(spark, d):
    """Three rounds and three more of a fitted booster say of every row what six rounds in one go say."""
    rows, contract = encoded(spark, d, "binary")
    params = {"n_estimators": 6, "max_depth": 2, "reg_lambda": 3.0, "reg_alpha": 0.1}

    def scores(model, name):
        return L.score(model, rows, "binary").select("ROW_ID", F.col("SCORE").alias(name))

    half = L.fit(rows, "Y_BIN", contract, "xgboost", {**params, "n_estimators": 3}, 7, "binary", 0)
    more = L.more_rounds(half, rows, "Y_BIN", "xgboost", params, 7, "binary")
    whole = L.fit(rows, "Y_BIN", contract, "xgboost", params, 7, "binary", 0)
    return scores(more, "A").join(scores(whole, "B"), "ROW_ID").select("ROW_ID", (F.abs(F.col("A") - F.col("B")) < 1e-6).alias("SAME"))


def job_store(spark, **changes):
    store = new_store(spark)
    model = ModelSpec(algorithm="logistic_regression", trials=1, fixed_params={"max_iter": 20}, search_space={"C": [0.3]})
    scoring = ScoringSpec(business_columns={"ENTITY_ID": "CUSTOMER", "NATION": "COUNTRY"})
    store.use_case = replace(X.USE_CASE, model=model, scoring=scoring, **changes)
    return store


TRAINED_AT, FIRST, SECOND = "2000-01-02 01:00:00", "2000-06-01 05:00:00", "2001-01-01 05:00:00"


TEST_DAYS = with_sql(BASE_SQL, FEED_SQL, """
, shares AS (SELECT COHORT, CAST(sum(count(*)) OVER (ORDER BY COHORT) AS DOUBLE) / sum(count(*)) OVER () AS CUM FROM history GROUP BY COHORT)
, cut AS (SELECT min(COHORT) AS C FROM shares WHERE CUM >= 1 - 0.2e0)""", select="""
SELECT CAST(strptime(CAST(COHORT AS VARCHAR) || '01', '%Y%m%d') AS DATE) AS DT, count(*) AS N FROM history, cut WHERE COHORT >= C GROUP BY 1""")


@query("training_job", TEST_DAYS)
def training_job(spark, d):
    """The whole training job; its baseline holds exactly the test side of the temporal split."""
    return train(job_store(spark), X.history(spark, d), "V1", TRAINED_AT).summary.select("DT", "N")


def other_training_job(algorithm: str, task: str, fixed: dict, space: dict):
    """The training job of another task, with a booster that stops by patience."""
    def run(spark, d):
        store = job_store(spark)
        model = ModelSpec(algorithm=algorithm, trials=1, fixed_params=fixed, search_space=space)
        numeric = tuple(c for c in X.DATA.numeric if c != TARGETS[task] and not (task == "regression" and c == "TOTAL_PRICE"))
        store.use_case = replace(store.use_case, task=task, model=model, data=replace(X.DATA, target=TARGETS[task], numeric=numeric))
        done = train(store, X.history(spark, d), "V1", TRAINED_AT)
        return done.summary.select("DT", "N")
    return run


query("training_job_multiclass", TEST_DAYS)(other_training_job("xgboost", "multiclass", {"n_estimators": 4}, {"max_depth": [2], "learning_rate": [0.3], "reg_lambda": [3.0]}))
query("training_job_regression", TEST_DAYS)(other_training_job("lightgbm", "regression", {"n_estimators": 4}, {"num_leaves": [7], "learning_rate": [0.3], "reg_alpha": [0.1]}))

SCORED_RUNS = f"""
, runs AS (
  SELECT ROW_ID, CASE WHEN RECORD_TS <= TIMESTAMP '2000-06-01' THEN TIMESTAMP '{FIRST}' ELSE TIMESTAMP '{SECOND}' END AS SCORED_AT
  FROM feed WHERE RECORD_TS <= TIMESTAMP '2001-01-01'
)"""


def scored_store(spark, d, **changes):
    store, feed = job_store(spark, **changes), staged(X.feed(spark, d))
    train(store, X.history(spark, d), "V1", TRAINED_AT)
    for now in (FIRST, FIRST, SECOND):
        score_batch(store, feed, now)
    return store, feed


@query("scoring_job", with_sql(BASE_SQL, FEED_SQL, SCORED_RUNS, select="SELECT ROW_ID, SCORED_AT FROM runs"))
def scoring_job(spark, d):
    """Two incremental runs, the first one called twice: every feed row is scored once, by the first run that may see it."""
    store, _ = scored_store(spark, d)
    return store.monitor().where("RUN_ID <> 'seed'").select("ROW_ID", "SCORED_AT")


@query("concurrent_scoring", with_sql(BASE_SQL, FEED_SQL, select="""
SELECT ROW_ID, 1 AS TIMES FROM feed WHERE RECORD_TS <= TIMESTAMP '2001-01-01'"""))
def concurrent_scoring(spark, d):
    """Two runs of different days at once from one watermark, then the later day again: one of the two commits, what the other
    wrote stays unseen, and every row is scored once."""
    store, feed = job_store(spark), staged(X.feed(spark, d))
    train(store, X.history(spark, d), "V1", TRAINED_AT)
    with ThreadPool(2) as pool:
        pool.map(lambda now: score_batch(Store(spark, store.root, store.use_case), feed, now), (FIRST, SECOND))
    score_batch(store, feed, SECOND)
    return store.monitor().where("RUN_ID <> 'seed'").groupBy("ROW_ID").agg(F.count("*").cast("int").alias("TIMES"))


@query("scoring_log", with_sql(BASE_SQL, FEED_SQL, SCORED_RUNS, select="""
SELECT STATUS, MESSAGE FROM (VALUES ('SKIPPED', 'no new rows to score')) v(STATUS, MESSAGE)
UNION ALL SELECT 'OK', 'scored ' || count(*) || ' rows' FROM runs GROUP BY SCORED_AT"""))
def scoring_log(spark, d):
    store, _ = scored_store(spark, d)
    return store.log_rows(10).select("STATUS", "MESSAGE")


@query("scoring_business_table", with_sql(BASE_SQL, FEED_SQL, select="""
SELECT DISTINCT ENTITY_ID AS CUSTOMER, NATION AS COUNTRY FROM feed WHERE RECORD_TS <= TIMESTAMP '2001-01-01'"""))
def scoring_business_table(spark, d):
    store, _ = scored_store(spark, d)
    return store.business("CUSTOMER").select("CUSTOMER", "COUNTRY")


@query("labeling_job", with_sql(BASE_SQL, FEED_SQL, OUTCOMES_SQL, SCORED_RUNS, select="""
SELECT r.ROW_ID, CASE WHEN SCORED_AT + INTERVAL 90 DAY <= TIMESTAMP '2000-09-15' THEN CAST(OUTCOME AS BIGINT) END AS ACTUAL_LABEL
FROM runs r JOIN feed USING (ROW_ID) LEFT JOIN outcomes USING (ENTITY_ID)"""))
def labeling_job(spark, d):
    store, _ = scored_store(spark, d)
    outcomes = staged(X.outcomes(spark, d))
    for _ in range(2):
        backfill_labels(store, outcomes, "2000-09-15 00:00:00")
    return store.monitor().where("RUN_ID <> 'seed'").select("ROW_ID", "ACTUAL_LABEL")


@query("retraining_job", with_sql(BASE_SQL, FEED_SQL, OUTCOMES_SQL, SCORED_RUNS, """
, labeled AS (SELECT r.ROW_ID, h.* FROM runs r JOIN feed h USING (ROW_ID) JOIN outcomes USING (ENTITY_ID)
              WHERE OUTCOME IS NOT NULL AND SCORED_AT + INTERVAL 90 DAY <= TIMESTAMP '2001-06-15')""", select="""
SELECT (SELECT count(*) FROM labeled) AS N_LABELED, (SELECT CAST(round_even(count(*) * 0.5e0, 0) AS BIGINT) FROM labeled) AS N_HOLDOUT,
       (SELECT count(*) FROM history) + (SELECT count(*) - CAST(round_even(count(*) * 0.5e0, 0) AS BIGINT) FROM labeled) AS N_TRAIN, 'PROMOTED' AS STATUS"""))
def retraining_job(spark, d):
    """Labels, trains a challenger and compares it; gates wide open, so it is promoted and its run tells the row counts."""
    rules = RetrainSpec(min_holdout_rows=1, min_holdout_positives=1, min_primary_lift_pct=-1e9, max_guardrail_drop_pct=1e9)
    store, feed = scored_store(spark, d, retrain=rules)
    done = retrain(store, X.history(spark, d), feed, "2001-06-15 10:30:00", "V2", outcomes=staged(X.outcomes(spark, d)))
    extra = store.past_run("V2").extra
    labeled = store.monitor().where("RUN_ID <> 'seed' AND ACTUAL_LABEL IS NOT NULL")
    return labeled.agg(F.count("*").alias("N_LABELED"), F.lit(extra["comparison_rows"]).cast("bigint").alias("N_HOLDOUT"),
                       F.lit(extra["train_rows"]).cast("bigint").alias("N_TRAIN"), F.lit(done.status).alias("STATUS"))


@query("streamed_scoring", with_sql(BASE_SQL, FEED_SQL, select="SELECT ROW_ID, 1 AS TIMES FROM feed"))
def streamed_scoring(spark, d):
    """The feed as a stream of files: a second start finds nothing new, so every row is scored once."""
    store = job_store(spark)
    train(store, X.history(spark, d), "V1", TRAINED_AT)
    folder = f"{shared_folder(spark)}/feed-{uuid.uuid4().hex}"
    X.feed(spark, d).write.parquet(f"{folder}/files")
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/files").schema).parquet(f"{folder}/files")
    for _ in range(2):
        score_stream(store, stream, SECOND, f"{folder}/checkpoint").awaitTermination()
    return store.monitor().where("RUN_ID <> 'seed'").groupBy(col("ROW_ID")).agg(F.count("*").cast("int").alias("TIMES"))


DELIVERIES = """
, first AS (SELECT * FROM feed WHERE COHORT BETWEEN 200003 AND 200006), second AS (SELECT * FROM feed WHERE COHORT BETWEEN 200006 AND 200012)
, third AS (SELECT * FROM feed WHERE COHORT < 200003 OR COHORT > 200012)
, delivered AS (SELECT f.*, 1 AS TURN FROM first f UNION ALL SELECT s.*, 2 FROM second s UNION ALL SELECT t.*, 3 FROM third t)
, newest AS (SELECT (SELECT max(RECORD_TS) FROM first) AS AFTER_1, (SELECT max(RECORD_TS) FROM second) AS AFTER_2)
, taken AS (SELECT ROW_ID, bool_or(TURN = 1 OR RECORD_TS > CASE TURN WHEN 2 THEN AFTER_1 ELSE AFTER_2 END - INTERVAL 40 DAY) AS SCORED
            FROM delivered, newest GROUP BY ROW_ID)"""


@query("streamed_intake", with_sql(BASE_SQL, FEED_SQL, DELIVERIES, select="""
SELECT ROW_ID, CASE WHEN SCORED THEN 1 ELSE 0 END AS TIMES_SCORED, CASE WHEN SCORED THEN 0 ELSE 1 END AS TIMES_LATE FROM taken"""))
def streamed_intake(spark, d):
    """Three deliveries of the feed: the second repeats a month of the first, the third brings old and new months. A row delivered
    twice is scored once; what comes more than 40 days behind goes to the side table, once, however often it is recorded."""
    store, feed = job_store(spark), staged(X.feed(spark, d))
    train(store, X.history(spark, d), "V1", TRAINED_AT)
    folder = f"{shared_folder(spark)}/intake-{uuid.uuid4().hex}"
    for months in ("COHORT BETWEEN 200003 AND 200006", "COHORT BETWEEN 200006 AND 200012", "COHORT < 200003 OR COHORT > 200012"):
        feed.where(months).write.mode("append").parquet(f"{folder}/files")
        stream = spark.readStream.schema(feed.schema).parquet(f"{folder}/files")
        score_stream(store, stream, SECOND, f"{folder}/checkpoint", lateness="40 days").awaitTermination()
    for name in ("once", "again"):
        record_late(store, spark.read.schema(feed.schema).parquet(f"{folder}/files"), name)
    scored = store.monitor().where("RUN_ID <> 'seed'").select("ROW_ID", F.lit(1).alias("S"), F.lit(0).alias("L"))
    both = scored.unionByName(store.late_rows().select("ROW_ID", F.lit(0).alias("S"), F.lit(1).alias("L")))
    return both.groupBy("ROW_ID").agg(F.sum("S").cast("int").alias("TIMES_SCORED"), F.sum("L").cast("int").alias("TIMES_LATE"))
