"""Reports over the monitor, drift, contributions and causes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodemark.catalog import query
from lodemark.catalog.encoding import MULTI_SQL, multi
from lodemark.operators import explain as E
from lodemark.operators import monitoring as M
from lodemark.operators.targets import class_distribution
from lodemark.sources import fixtures as X
from lodemark.sources.fixtures import (BASE_SQL, BASELINE_SQL, FEED_SQL, MONITOR_SQL, OUTCOMES_SQL, SCORED_SQL, contributions_sql,
                                       with_sql)
from lodemark.sources.scans import shared_folder, staged
from lodemark.streaming.feeds import accuracy_stream, drift_stream

ALL = (BASE_SQL, FEED_SQL, OUTCOMES_SQL, SCORED_SQL, MONITOR_SQL, BASELINE_SQL)
LATEST = "(SELECT max(SCORED_AT) FROM monitor)"


@query("daily_summary_binary", with_sql(*ALL, select="""
SELECT CAST(SCORED_AT AS DATE) AS DT, MODEL_VERSION, count(*) AS N, round(avg(PREDICTED_PROBABILITY), 4) AS AVG_PROB,
       CAST(sum(PREDICTION) AS BIGINT) AS N_FLAGGED, count(*) FILTER (WHERE RISK_BAND = 'HIGH') AS N_HIGH,
       count(PROBABLE_CAUSES) AS N_WITH_CAUSES, count(ACTUAL_LABEL) AS N_ACTUAL
FROM monitor GROUP BY 1, 2 ORDER BY 1 DESC, 2 LIMIT 10"""))
def daily_summary_binary(spark, d):
    return M.scoring_summary(X.monitor(spark, d), "binary")


@query("daily_summary_multiclass", with_sql(BASE_SQL, SCORED_SQL, MULTI_SQL, select="""
SELECT CAST(SCORED_AT AS DATE) AS DT, MODEL_VERSION, count(*) AS N, round(avg(PREDICTED_PROBABILITY), 4) AS AVG_CONFIDENCE,
       count(DISTINCT PICK) AS N_CLASSES_PREDICTED, count(*) FILTER (WHERE RISK_BAND = 'HIGH') AS N_HIGH,
       count(nullif(RISK_BAND, 'LOW')) AS N_WITH_CAUSES, count(Y_MULTI) AS N_ACTUAL
FROM multi GROUP BY 1, 2 ORDER BY 1 DESC, 2 LIMIT 10"""))
def daily_summary_multiclass(spark, d):
    rows = multi(spark, d).withColumns({"PREDICTION": F.col("PICK"), "ACTUAL_LABEL": F.col("Y_MULTI"),
                                        "PROBABLE_CAUSES": F.nullif("RISK_BAND", F.lit("LOW"))})
    return M.scoring_summary(rows, "multiclass")


@query("daily_summary_regression", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT CAST(SCORED_AT AS DATE) AS DT, MODEL_VERSION, count(*) AS N, round(avg(sqrt(Y_REG)), 4) AS AVG_PRED, round(min(sqrt(Y_REG)), 4) AS MIN_PRED,
       round(max(sqrt(Y_REG)), 4) AS MAX_PRED, count(nullif(RISK_BAND, 'LOW')) AS N_WITH_CAUSES, count(N_RETURNED) AS N_ACTUAL
FROM scored GROUP BY 1, 2 ORDER BY 1 DESC, 2 LIMIT 10"""))
def daily_summary_regression(spark, d):
    rows = X.scored(spark, d).withColumns({"PREDICTED_VALUE": F.sqrt("Y_REG"), "ACTUAL_LABEL": F.col("N_RETURNED"),
                                           "PROBABLE_CAUSES": F.nullif("RISK_BAND", F.lit("LOW"))})
    return M.scoring_summary(rows, "regression")


@query("latest_batch_rows", with_sql(*ALL, select=f"SELECT ROW_ID, SCORED_AT, RISK_BAND FROM monitor WHERE SCORED_AT = {LATEST}"))
def latest_batch_rows(spark, d):
    return M.latest_batch(X.monitor(spark, d)).select("ROW_ID", "SCORED_AT", "RISK_BAND")


@query("score_drift_check", with_sql(*ALL, select=f"""
SELECT 'baseline' AS SRC, round(avg(PREDICTED_PROBABILITY), 4) AS AVG_SCORE, count(*) AS N FROM baseline
UNION ALL SELECT 'latest batch', round(avg(PREDICTED_PROBABILITY), 4), count(*) FROM monitor WHERE SCORED_AT = {LATEST}"""))
def score_drift_check(spark, d):
    return M.score_drift(X.baseline(spark, d), X.monitor(spark, d), "binary")


@query("prediction_mix_drift", with_sql(*ALL, select=f"""
SELECT 'baseline' AS SRC, PREDICTION, count(*) AS N FROM baseline GROUP BY 2
UNION ALL SELECT 'latest batch', PREDICTION, count(*) FROM monitor WHERE SCORED_AT = {LATEST} GROUP BY 2"""))
def prediction_mix_drift(spark, d):
    return M.prediction_mix(X.baseline(spark, d), X.monitor(spark, d))


@query("label_mix", with_sql(*ALL, select="SELECT ACTUAL_LABEL AS CLASS, count(*) AS N FROM monitor GROUP BY 1"))
def label_mix(spark, d):
    return class_distribution(X.monitor(spark, d), "ACTUAL_LABEL")


BINS_SQL = """
, edges AS (
  SELECT list(DISTINCT PREDICTED_PROBABILITY ORDER BY PREDICTED_PROBABILITY) AS E FROM (
    SELECT PREDICTED_PROBABILITY, row_number() OVER (ORDER BY PREDICTED_PROBABILITY) AS rn, count(*) OVER () AS n FROM baseline)
  WHERE rn IN (SELECT greatest((i * n + 9) // 10, 1) FROM range(1, 10) t(i))
), bins AS (SELECT unnest(range(0, len(E) + 1)) AS B FROM edges)
, expected AS (
  SELECT b.B, greatest(CAST(count(x.BIN) AS DOUBLE) / (SELECT count(*) FROM baseline), 1e-6) AS WAS
  FROM bins b LEFT JOIN (SELECT len(list_filter(E, lambda e: e < PREDICTED_PROBABILITY)) AS BIN FROM baseline, edges) x ON x.BIN = b.B
  GROUP BY b.B
), windowed AS (
  SELECT date_trunc('day', SCORED_AT) AS WINDOW_START, MODEL_VERSION, PREDICTED_PROBABILITY AS S, PREDICTION, ACTUAL_LABEL,
         len(list_filter(E, lambda e: e < PREDICTED_PROBABILITY)) AS BIN FROM monitor, edges
), found AS (
  SELECT w.WINDOW_START, w.MODEL_VERSION, e.B, any_value(WAS) AS WAS,
         greatest(CAST(count(*) FILTER (WHERE BIN = e.B) AS DOUBLE) / count(*), 1e-6) AS NOW
  FROM windowed w, expected e GROUP BY 1, 2, 3
), psi AS (SELECT WINDOW_START, MODEL_VERSION, sum((NOW - WAS) * ln(NOW / WAS)) AS PSI FROM found GROUP BY 1, 2)"""


@query("drift_windows", with_sql(*ALL, BINS_SQL, select="""
SELECT WINDOW_START, MODEL_VERSION, count(*) AS N, round(avg(S), 6) AS MEAN_SCORE, round(stddev_samp(S), 6) AS STD_SCORE,
       count(ACTUAL_LABEL) AS N_LABELED, round(avg(CASE WHEN ACTUAL_LABEL IS NOT NULL THEN CAST(PREDICTION = ACTUAL_LABEL AS DOUBLE) END), 6) AS ACCURACY,
       round(any_value(PSI), 6) AS PSI
FROM windowed JOIN psi USING (WINDOW_START, MODEL_VERSION) GROUP BY 1, 2"""))
def drift_windows(spark, d):
    reference = M.baseline_bins(X.baseline(spark, d), "PREDICTED_PROBABILITY")
    return _six_places(M.drift_windows(X.monitor(spark, d), reference, "binary"))


@query("drift_stream", with_sql(*ALL, BINS_SQL, select="""
SELECT WINDOW_START, MODEL_VERSION, count(*) AS N, round(avg(S), 6) AS MEAN_SCORE, round(stddev_samp(S), 6) AS STD_SCORE, count(ACTUAL_LABEL) AS N_LABELED,
       round(avg(CASE WHEN ACTUAL_LABEL IS NOT NULL THEN CAST(PREDICTION = ACTUAL_LABEL AS DOUBLE) END), 6) AS ACCURACY, round(any_value(PSI), 6) AS PSI
FROM windowed JOIN psi USING (WINDOW_START, MODEL_VERSION)
WHERE WINDOW_START < (SELECT max(WINDOW_START) - INTERVAL 1 DAY FROM windowed) GROUP BY 1, 2"""))
def drifted_stream(spark, d):
    """The monitor written as files and read as a stream; windows the watermark has closed come out."""
    folder = f"{shared_folder(spark)}/drift-{uuid.uuid4().hex}"
    rows = X.monitor(spark, d)
    rows.write.parquet(f"{folder}/monitor")
    reference = M.baseline_bins(X.baseline(spark, d), "PREDICTED_PROBABILITY")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/monitor")
    drift_stream(stream, reference, "binary", f"{folder}/report", f"{folder}/checkpoint").awaitTermination()
    report = spark.read.parquet(f"{folder}/report").withColumn("WINDOW_START", F.col("WINDOW_START").cast("timestamp_ntz"))
    return _six_places(report)


LATER_SQL = """
, later AS (
  SELECT s.*, SCORED_AT + to_days(10 * CAST(N_LINES AS INTEGER)) AS OUTCOME_AT FROM scored s WHERE RECORD_TS >= TIMESTAMP '%s'
), monitor AS (SELECT * EXCLUDE (OUTCOME_AT), CASE WHEN N_LINES > 0 AND N_LINES <= 4 THEN Y_BIN END AS ACTUAL_LABEL FROM later)
, closed AS (SELECT least(max(SCORED_AT), max(OUTCOME_AT) FILTER (WHERE N_LINES > 0)) - INTERVAL 47 DAY AS C FROM later)""" % X.FEED_START


@query("accuracy_stream", with_sql(BASE_SQL, SCORED_SQL, LATER_SQL, BASELINE_SQL, BINS_SQL, select="""
SELECT WINDOW_START, MODEL_VERSION, count(*) AS N, round(avg(S), 6) AS MEAN_SCORE, round(stddev_samp(S), 6) AS STD_SCORE, count(ACTUAL_LABEL) AS N_LABELED,
       round(avg(CASE WHEN ACTUAL_LABEL IS NOT NULL THEN CAST(PREDICTION = ACTUAL_LABEL AS DOUBLE) END), 6) AS ACCURACY, round(any_value(PSI), 6) AS PSI
FROM windowed JOIN psi USING (WINDOW_START, MODEL_VERSION) WHERE WINDOW_START + INTERVAL 1 DAY <= (SELECT C FROM closed) GROUP BY 1, 2"""))
def labels_as_stream(spark, d):
    """Scores and outcomes as two streams: an order's outcome follows ten days per line after its scoring and counts within 45 days;
    orders without lines have none. Every outcome is delivered twice."""
    folder = f"{shared_folder(spark)}/accuracy-{uuid.uuid4().hex}"
    rows = staged(X.monitor(spark, d, labeled=False))
    rows.write.parquet(f"{folder}/scores")
    known = rows.where("N_LINES > 0").selectExpr("ROW_ID", "Y_BIN", "SCORED_AT + make_dt_interval(cast(10 * N_LINES as int)) AS OUTCOME_AT")
    known.unionByName(known).write.parquet(f"{folder}/outcomes")
    scores = spark.readStream.schema(rows.schema).parquet(f"{folder}/scores")
    outcomes = spark.readStream.schema(known.schema).parquet(f"{folder}/outcomes")
    reference = M.baseline_bins(X.baseline(spark, d), "PREDICTED_PROBABILITY")
    accuracy_stream(scores, outcomes, ["ROW_ID"], "Y_BIN", "OUTCOME_AT", "45 days", reference, "binary", f"{folder}/report",
                    f"{folder}/checkpoint", lateness="2 days").awaitTermination()
    report = spark.read.parquet(f"{folder}/report").withColumn("WINDOW_START", F.col("WINDOW_START").cast("timestamp_ntz"))
    return _six_places(report)


def _six_places(report):
    return report.withColumns({c: F.round(c, 6) for c in ("MEAN_SCORE", "STD_SCORE", "ACCURACY", "PSI") if c in report.columns})


# ------------------------------------------------------------------------------------------------- contributions

CONTRIBUTIONS_SQL = contributions_sql()
CAUSE_PARTS = ("TOTAL_PRICE", "PRIORITY_1_URGENT", "ACCT_BAL", "N_LINES")
SOURCES = {"TOTAL_PRICE": "TOTAL_PRICE", "PRIORITY_1_URGENT": "PRIORITY", "ACCT_BAL": "ACCT_BAL", "N_LINES": "N_LINES"}
LONG_SQL = ", long AS (" + " UNION ALL ".join(
    f"SELECT ROW_ID, '{SOURCES[c]}' AS BASE, C_{c} AS CONTRIB FROM contributions" for c in CAUSE_PARTS) + """)
, causes AS (
  SELECT ROW_ID, list_aggregate((list(BASE ORDER BY CONTRIB DESC, BASE))[1:2], 'string_agg', ' | ') AS PROBABLE_CAUSES
  FROM long WHERE CONTRIB > 0 GROUP BY ROW_ID
)"""


def contributed(spark, d):
    rows = X.scored(spark, d)
    weights = X.MODELS["LR_R1"][1]
    means = E.feature_means(rows, list(weights))
    return rows, weights, means


@query("linear_score", with_sql(BASE_SQL, SCORED_SQL, select="SELECT ROW_ID, PREDICTED_PROBABILITY FROM scored"))
def linear_score(spark, d):
    return X.scored(spark, d).select("ROW_ID", "PREDICTED_PROBABILITY")


@query("linear_contributions", with_sql(BASE_SQL, SCORED_SQL, CONTRIBUTIONS_SQL, select=f"""
SELECT ROW_ID, {", ".join(f"round(C_{c}, 6) AS C_{SOURCES[c]}" for c in CAUSE_PARTS)} FROM contributions"""))
def linear_contributions(spark, d):
    rows, weights, means = contributed(spark, d)
    parts = E.centred_contributions(weights, means, X.CONTRACT.sources)
    return rows.select("ROW_ID", *[F.round(c, 6).alias(f"C_{s}") for s, c in parts.items()])


IMPORTANCES = {"TOTAL_PRICE": 0.5, "PRIORITY_1_URGENT": 0.3, "ACCT_BAL": 0.0, "N_LINES": 0.2}


@query("importance_contributions", with_sql(BASE_SQL, SCORED_SQL, select=f"""
SELECT ROW_ID, {", ".join(f"round(({c} - avg({c}) OVER ()) * {w}e0, 4) AS C_{SOURCES[c]}" for c, w in IMPORTANCES.items())} FROM scored"""))
def importance_contributions(spark, d):
    rows, _, means = contributed(spark, d)
    parts = E.centred_contributions(IMPORTANCES, means, X.CONTRACT.sources)
    return rows.select("ROW_ID", *[F.round(c, 4).alias(f"C_{s}") for s, c in parts.items()])


@query("feature_importance", with_sql(BASE_SQL, SCORED_SQL, CONTRIBUTIONS_SQL, select="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{SOURCES[c]}' AS FEATURE, round(avg(abs(C_{c})), 6) AS MEAN_ABS_CONTRIBUTION, round(avg(C_{c}), 6) + 0 AS DIRECTION FROM contributions"
    for c in CAUSE_PARTS) + ") ORDER BY MEAN_ABS_CONTRIBUTION DESC LIMIT 3"))
def feature_importance(spark, d):
    rows, weights, means = contributed(spark, d)
    report = E.feature_importance(rows, E.centred_contributions(weights, means, X.CONTRACT.sources), 3)
    return report.select("FEATURE", F.round("MEAN_ABS_CONTRIBUTION", 6).alias("MEAN_ABS_CONTRIBUTION"),
                         (F.round("DIRECTION", 6) + F.lit(0.0)).alias("DIRECTION"))


@query("row_causes", with_sql(BASE_SQL, SCORED_SQL, CONTRIBUTIONS_SQL, LONG_SQL, select="""
SELECT s.ROW_ID, PROBABLE_CAUSES FROM scored s LEFT JOIN causes c ON c.ROW_ID = s.ROW_ID"""))
def row_causes(spark, d):
    from lodemark.functions.columns import ranked_causes

    rows, weights, means = contributed(spark, d)
    parts = E.centred_contributions(weights, means, X.CONTRACT.sources)
    return rows.select("ROW_ID", ranked_causes(parts, 2).alias("PROBABLE_CAUSES"))


def explained(spark, d):
    """Contributions in the shape an explanation function returns: one column per encoded feature, with a suffix."""
    rows, weights, means = contributed(spark, d)
    return rows.select("ROW_ID", *[((F.col(c) - F.lit(means[c])) * F.lit(w)).alias(f"{c}_explanation") for c, w in weights.items()])


def contract_rows(spark):
    return X.CONTRACT.to_frame(spark, "ORDERS", "LR_R1", F.lit(X.NOW))


@query("contribution_rollup", with_sql(BASE_SQL, SCORED_SQL, CONTRIBUTIONS_SQL, LONG_SQL, select="""
SELECT ROW_ID, BASE, round(sum(CONTRIB), 6) AS CONTRIB FROM long GROUP BY 1, 2 HAVING sum(CONTRIB) > 0"""))
def contribution_rollup(spark, d):
    rows = E.contribution_rows(explained(spark, d), ["ROW_ID"], X.CONTRACT.encoded, contract_rows(spark), "_explanation")
    return rows.withColumn("CONTRIB", F.round("CONTRIB", 6))


@query("top_causes", with_sql(BASE_SQL, SCORED_SQL, CONTRIBUTIONS_SQL, LONG_SQL, select="SELECT * FROM causes"))
def top_causes(spark, d):
    rows = E.contribution_rows(explained(spark, d), ["ROW_ID"], X.CONTRACT.encoded, contract_rows(spark), "_explanation")
    return E.causes_by_key(rows, ["ROW_ID"], 2)


@query("causes_left_join", with_sql(BASE_SQL, SCORED_SQL, CONTRIBUTIONS_SQL, LONG_SQL, select="""
SELECT s.ROW_ID, RISK_BAND, PROBABLE_CAUSES FROM scored s LEFT JOIN causes c ON c.ROW_ID = s.ROW_ID"""))
def causes_left_join(spark, d):
    rows = E.contribution_rows(explained(spark, d), ["ROW_ID"], X.CONTRACT.encoded, contract_rows(spark), "_explanation")
    scored = X.scored(spark, d).select("ROW_ID", "RISK_BAND")
    return scored.join(E.causes_by_key(rows, ["ROW_ID"], 2), "ROW_ID", "left")


@query("predicted_class_explanation", with_sql(BASE_SQL, SCORED_SQL, MULTI_SQL, select="""
SELECT ROW_ID, PICK, round(CASE PICK WHEN 'F' THEN -2e-6 WHEN 'O' THEN 1e-6 ELSE 3e-6 END * (TOTAL_PRICE - avg(TOTAL_PRICE) OVER ()), 6) AS C_TOTAL_PRICE
FROM multi"""))
def predicted_class_explanation(spark, d):
    """Per-class contributions; each row shows those of the class it was predicted as."""
    rows = multi(spark, d)
    means = E.feature_means(rows, ["TOTAL_PRICE"])
    per_class = [E.centred_contributions({"TOTAL_PRICE": w}, means, {"TOTAL_PRICE": "TOTAL_PRICE"})["TOTAL_PRICE"] for w in (-2e-6, 1e-6, 3e-6)]
    at = F.array_position(F.array(F.lit("F"), F.lit("O"), F.lit("P")), F.col("PICK")).cast("int")
    return rows.select("ROW_ID", "PICK", F.round(F.element_at(F.array(*per_class), at), 6).alias("C_TOTAL_PRICE"))
