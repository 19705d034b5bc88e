"""Outcomes, label back-fill, retraining dataset, champion comparison rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodemark.catalog import query
from lodemark.functions.columns import cohort_of
from lodemark.operators import labels as L
from lodemark.operators import metrics as M
from lodemark.operators.joins import latest_per_key
from lodemark.operators.monitoring import latest_batch
from lodemark.operators.ranking import newest_fraction
from lodemark.operators.splits import without
from lodemark.sources import fixtures as X
from lodemark.sources.fixtures import (BASE_SQL, FEED_SQL, MONITOR_SQL, NOW, OUTCOME_VERSIONS_SQL, OUTCOMES_SQL, SCORED_SQL,
                                       with_sql)
from lodemark.sources.scans import staged

ALL = (BASE_SQL, FEED_SQL, OUTCOMES_SQL, SCORED_SQL, MONITOR_SQL)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


@query("duplicate_key_count", with_sql(BASE_SQL, FEED_SQL, OUTCOMES_SQL, OUTCOME_VERSIONS_SQL, select="""
SELECT count(*) - count(DISTINCT ENTITY_ID) AS N_DUPLICATE FROM outcome_versions WHERE OUTCOME IS NOT NULL"""))
def duplicate_key_count(spark, d):
    return L.duplicate_keys(X.outcome_versions(spark, d), "ENTITY_ID", "OUTCOME")


@query("label_counts", with_sql(*ALL, select="""
SELECT count(*) AS TOTAL_ROWS, count(ACTUAL_LABEL) AS LABELED, count(*) - count(ACTUAL_LABEL) AS WAITING FROM monitor"""))
def label_counts(spark, d):
    return L.label_counts(X.monitor(spark, d))


@query("labelable_count", with_sql(*ALL, select="""
SELECT count(*) AS MONITOR_ROWS, count(*) FILTER (WHERE ACTUAL_LABEL IS NULL) AS MONITOR_PENDING,
       count(*) FILTER (WHERE ACTUAL_LABEL IS NULL AND g.ENTITY_ID IS NOT NULL) AS LABELABLE_NOW
FROM monitor m LEFT JOIN (SELECT DISTINCT ENTITY_ID FROM outcomes WHERE OUTCOME IS NOT NULL) g ON m.ENTITY_ID = g.ENTITY_ID"""))
def labelable_count(spark, d):
    return L.labelable(X.monitor(spark, d), X.outcomes(spark, d), "ENTITY_ID", "OUTCOME")


@query("ground_truth_profile", with_sql(*ALL, select="""
SELECT (SELECT count(*) FROM outcomes) AS SOURCE_ROWS, (SELECT count(DISTINCT ENTITY_ID) FROM outcomes) AS DISTINCT_KEYS,
       (SELECT count(*) FROM outcomes WHERE OUTCOME IS NULL) AS NULL_OUTCOMES, count(*) AS MONITOR_ROWS,
       count(*) FILTER (WHERE ACTUAL_LABEL IS NULL) AS MONITOR_PENDING,
       count(*) FILTER (WHERE ACTUAL_LABEL IS NULL AND OUTCOME IS NOT NULL) AS LABELABLE_NOW
FROM monitor LEFT JOIN outcomes USING (ENTITY_ID)"""))
def ground_truth_profile(spark, d):
    return L.outcome_profile(X.outcomes(spark, d), X.monitor(spark, d), "ENTITY_ID", "OUTCOME")


@query("label_join", with_sql(*ALL, select=f"""
SELECT ROW_ID, CAST(OUTCOME AS BIGINT) AS GT_LABEL FROM monitor_new JOIN outcomes USING (ENTITY_ID)
WHERE OUTCOME IS NOT NULL AND LABEL_MATURE_AT <= TIMESTAMP '{NOW}'"""))
def label_join(spark, d):
    updates = L.label_updates(X.monitor(spark, d, labeled=False), X.outcomes(spark, d), "ENTITY_ID", "OUTCOME", "binary", now())
    return updates.select("ROW_ID", "GT_LABEL")


@query("label_join_latest_wins", with_sql(*ALL, OUTCOME_VERSIONS_SQL, select="""
SELECT ROW_ID, CAST(OUTCOME AS BIGINT) AS GT_LABEL
FROM monitor_new JOIN (SELECT * FROM outcome_versions WHERE OUTCOME IS NOT NULL
                       QUALIFY row_number() OVER (PARTITION BY ENTITY_ID ORDER BY OUTCOME_TS DESC) = 1) USING (ENTITY_ID)"""))
def label_join_latest_wins(spark, d):
    updates = L.label_updates(X.monitor(spark, d, labeled=False), X.outcome_versions(spark, d), "ENTITY_ID", "OUTCOME", "binary",
                              now(), ts="OUTCOME_TS", respect_maturity=False)
    return updates.select("ROW_ID", "GT_LABEL")


@query("champion_predictions", with_sql(*ALL, select="""
SELECT ENTITY_ID, PREDICTED_PROBABILITY, PREDICTION, ACTUAL_LABEL, SCORED_AT FROM monitor
WHERE ACTUAL_LABEL IS NOT NULL AND MODEL_VERSION = 'LR_R1'
QUALIFY row_number() OVER (PARTITION BY ENTITY_ID ORDER BY SCORED_AT DESC, PREDICTED_PROBABILITY DESC) = 1"""))
def champion_predictions(spark, d):
    return L.labeled_scores(X.monitor(spark, d), ["ENTITY_ID"], "binary", "LR_R1")


LABELED_SQL = """
, labeled AS (
  SELECT ENTITY_ID, ACTUAL_LABEL, SCORED_AT FROM monitor WHERE ACTUAL_LABEL IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY ENTITY_ID ORDER BY SCORED_AT DESC, ACTUAL_LABEL DESC) = 1
), production AS (
  SELECT c.*, m.ACTUAL_LABEL, m.SCORED_AT FROM feed c JOIN labeled m ON c.ENTITY_ID = m.ENTITY_ID
  WHERE c.RECORD_TS <= m.SCORED_AT
  QUALIFY row_number() OVER (PARTITION BY c.ENTITY_ID ORDER BY c.RECORD_TS DESC, c.ROW_ID DESC) = 1
), retrain AS (
  SELECT ENTITY_ID, COHORT, CAST(Y_BIN AS BIGINT) AS Y_BIN, PRIORITY, TOTAL_PRICE, 'HISTORY' AS ROW_SOURCE, CAST(NULL AS TIMESTAMP) AS SCORED_AT
  FROM history
  UNION ALL SELECT ENTITY_ID, CAST(strftime(SCORED_AT, '%Y%m') AS INTEGER), ACTUAL_LABEL, PRIORITY, TOTAL_PRICE, 'PRODUCTION', SCORED_AT
  FROM production
)"""


def retrain(spark, d):
    return L.retrain_base(X.history(spark, d), X.feed(spark, d), X.monitor(spark, d), ["ENTITY_ID"], "COHORT", "Y_BIN",
                          ["PRIORITY", "TOTAL_PRICE"], "binary", cohort_of(F.col("SCORED_AT")), "RECORD_TS", ["ROW_ID"])


@query("asof_retrain_rows", with_sql(*ALL, LABELED_SQL, select="SELECT * FROM retrain WHERE ROW_SOURCE = 'PRODUCTION'"))
def asof_retrain_rows(spark, d):
    return retrain(spark, d).where("ROW_SOURCE = 'PRODUCTION'")


@query("retrain_base", with_sql(*ALL, LABELED_SQL, select="SELECT * FROM retrain"))
def retrain_rows(spark, d):
    return retrain(spark, d)


@query("rows_by_source", with_sql(*ALL, LABELED_SQL, select="SELECT ROW_SOURCE, count(*) AS N FROM retrain GROUP BY 1"))
def rows_by_source(spark, d):
    return L.rows_by_source(retrain(spark, d))


CHAMPION_SQL = LABELED_SQL + """
, champion AS (
  SELECT ENTITY_ID, PREDICTED_PROBABILITY AS CHAMPION_PREDICTED_PROBABILITY, PREDICTION AS CHAMPION_PREDICTION,
         SCORED_AT AS CHAMPION_SCORED_AT FROM monitor WHERE ACTUAL_LABEL IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY ENTITY_ID ORDER BY SCORED_AT DESC, PREDICTED_PROBABILITY DESC) = 1
), comparison AS (
  SELECT ENTITY_ID, Y_BIN, CHAMPION_PREDICTED_PROBABILITY, CHAMPION_PREDICTION, CHAMPION_SCORED_AT
  FROM retrain JOIN champion USING (ENTITY_ID) WHERE ROW_SOURCE = 'PRODUCTION'
), holdout AS (
  SELECT * FROM comparison
  QUALIFY row_number() OVER (ORDER BY CHAMPION_SCORED_AT DESC, md5('42|' || ENTITY_ID))
          <= (SELECT CAST(round_even(count(*) * 0.5e0, 0) AS BIGINT) FROM comparison)
)"""
COMPARED = ("ENTITY_ID", "Y_BIN", "CHAMPION_PREDICTED_PROBABILITY", "CHAMPION_PREDICTION", "CHAMPION_SCORED_AT")


def comparison(spark, d):
    champion = L.labeled_scores(X.monitor(spark, d), ["ENTITY_ID"], "binary", "LR_R1")
    return staged(L.champion_comparison(retrain(spark, d), champion, ["ENTITY_ID"]).select(*COMPARED))


def holdout(spark, d):
    return newest_fraction(comparison(spark, d), "CHAMPION_SCORED_AT", 0.5, ["ENTITY_ID"], 42)


@query("champion_comparison", with_sql(*ALL, CHAMPION_SQL, select="SELECT * FROM comparison"))
def champion_comparison(spark, d):
    return comparison(spark, d)


@query("comparison_holdout", with_sql(*ALL, CHAMPION_SQL, select="SELECT * FROM holdout"))
def comparison_holdout(spark, d):
    return holdout(spark, d)


@query("challenger_train_rows", with_sql(*ALL, CHAMPION_SQL, select="""
SELECT ROW_SOURCE, count(*) AS N, CAST(sum(Y_BIN) AS BIGINT) AS POSITIVES FROM retrain
WHERE ROW_SOURCE = 'HISTORY' OR ENTITY_ID NOT IN (SELECT ENTITY_ID FROM holdout) GROUP BY 1"""))
def challenger_train_rows(spark, d):
    held = holdout(spark, d).select("ENTITY_ID", F.lit(L.PRODUCTION).alias("ROW_SOURCE"))
    rows = without(retrain(spark, d), held, ["ENTITY_ID", "ROW_SOURCE"])
    return rows.groupBy("ROW_SOURCE").agg(F.count("*").alias("N"), F.sum("Y_BIN").alias("POSITIVES"))


@query("retrain_gates", with_sql(*ALL, CHAMPION_SQL, select="""
SELECT HOLDOUT_ROWS, HOLDOUT_POSITIVES, HOLDOUT_CLASSES, TRAIN_ROWS,
       CASE WHEN HOLDOUT_ROWS < 100 THEN 'too few labeled rows to compare on'
            WHEN HOLDOUT_POSITIVES < 100000 THEN 'too few positives to compare on'
            WHEN TRAIN_ROWS = 0 THEN 'nothing is left to fit a challenger' END AS SKIP_REASON
FROM (SELECT count(*) AS HOLDOUT_ROWS, count(*) FILTER (WHERE Y_BIN = 1) AS HOLDOUT_POSITIVES,
             count(DISTINCT Y_BIN) AS HOLDOUT_CLASSES, (SELECT count(*) FROM history) AS TRAIN_ROWS FROM holdout)"""))
def retrain_gates(spark, d):
    return M.retrain_gates(holdout(spark, d), X.history(spark, d), "Y_BIN", "binary", 100, 100_000)


@query("latest_batch_business_rows", with_sql(*ALL, select="""
SELECT m.ENTITY_ID AS CUSTOMER, f.NATION AS COUNTRY, m.PREDICTED_PROBABILITY, m.RISK_BAND
FROM monitor m JOIN feed f ON f.ROW_ID = m.ROW_ID WHERE m.SCORED_AT = (SELECT max(SCORED_AT) FROM monitor)
QUALIFY row_number() OVER (PARTITION BY m.ENTITY_ID ORDER BY m.SCORED_AT DESC, m.ROW_ID DESC) = 1"""))
def latest_batch_business_rows(spark, d):
    batch = latest_batch(X.monitor(spark, d))
    rows = batch.join(X.feed(spark, d).select("ROW_ID", "NATION"), "ROW_ID")
    return latest_per_key(rows, ["ENTITY_ID"], "SCORED_AT", ["ROW_ID"]).select(
        F.col("ENTITY_ID").alias("CUSTOMER"), F.col("NATION").alias("COUNTRY"), "PREDICTED_PROBABILITY", "RISK_BAND")
