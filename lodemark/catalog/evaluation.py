"""Target profiles, metrics, comparison and promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodemark.catalog import query
from lodemark.catalog.encoding import MULTI_SQL, multi
from lodemark.operators import metrics as M
from lodemark.operators import targets as T
from lodemark.sources import fixtures as X
from lodemark.sources.fixtures import BASE_SQL, SCORED_2_SQL, SCORED_SQL, with_sql
from lodemark.sources.scans import staged

PLACES = 6


def rounded(df, *kept):
    return df.select(*[F.col(c) if c in kept else F.round(F.col(c).cast("double"), PLACES).alias(c) for c in df.columns])


def judged(spark, d, version: str = "LR_R1"):
    """What a binary metric set reads, scored once and written: the metrics pass over it several times."""
    return staged(X.scored(spark, d, version).select("ROW_ID", "Y_BIN", "PREDICTED_PROBABILITY", "PREDICTION"))


def judged_classes(spark, d):
    return staged(multi(spark, d).select("ROW_ID", "Y_MULTI", "PICK", "CONFIDENCE"))


@query("target_profile_binary", with_sql(BASE_SQL, select="""
SELECT count(*) AS N_ROWS, round(avg(Y_BIN), 6) AS BASE_RATE, round((1 - avg(Y_BIN)) / greatest(avg(Y_BIN), 1e-9), 6) AS IMBALANCE FROM base"""))
def target_profile_binary(spark, d):
    return rounded(T.target_profile(X.base(spark, d), "Y_BIN", "binary"), "N_ROWS")


@query("target_profile_regression", with_sql(BASE_SQL, select="""
SELECT count(*) AS N_ROWS, round(avg(Y_REG), 4) AS TARGET_MEAN, round(stddev_samp(Y_REG), 4) AS TARGET_STD FROM base"""))
def target_profile_regression(spark, d):
    profile = T.target_profile(X.base(spark, d), "Y_REG", "regression")
    return profile.select("N_ROWS", F.round("TARGET_MEAN", 4).alias("TARGET_MEAN"), F.round("TARGET_STD", 4).alias("TARGET_STD"))


@query("class_distribution", with_sql(BASE_SQL, select="SELECT Y_MULTI AS CLASS, count(*) AS N FROM base GROUP BY 1"))
def class_distribution(spark, d):
    return T.class_distribution(X.base(spark, d), "Y_MULTI")


@query("naive_baselines", with_sql(BASE_SQL, select="""
SELECT 'binary' AS TASK, round(avg(Y_BIN), 4) AS BASELINE FROM base
UNION ALL SELECT 'multiclass', round(max(n) / sum(n), 4) FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM base GROUP BY Y_MULTI)
UNION ALL SELECT 'regression', round(stddev_samp(Y_REG), 4) FROM base"""))
def naive_baselines(spark, d):
    rows = X.base(spark, d)
    parts = [T.naive_baseline(rows, t, task).select(F.lit(task).alias("TASK"), F.round("BASELINE", 4).alias("BASELINE"))
             for t, task in (("Y_BIN", "binary"), ("Y_MULTI", "multiclass"), ("Y_REG", "regression"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("class_weights", with_sql(BASE_SQL, select="""
SELECT 1e0 AS WEIGHT_NONE, round(sqrt(R), 6) AS WEIGHT_SQRT, round(R, 6) AS WEIGHT_FULL
FROM (SELECT CAST(count(*) FILTER (WHERE Y_BIN = 0) AS DOUBLE) / greatest(count(*) FILTER (WHERE Y_BIN = 1), 1) AS R FROM base)"""))
def class_weights(spark, d):
    return rounded(T.class_weights(X.base(spark, d), "Y_BIN"))


VALUE_SQL = """
, valued AS (SELECT ROW_ID, Y_REG, Y_REG * 0.9e0 + ACCT_BAL * 5e0 AS V FROM base)"""


def valued(spark, d):
    """Rows with a closed-form predicted value next to the true one."""
    return X.base(spark, d).select("ROW_ID", "Y_REG", (F.col("Y_REG") * 0.9 + F.col("ACCT_BAL") * 5.0).alias("V"))


@query("regression_metrics", with_sql(BASE_SQL, VALUE_SQL, select="""
SELECT round(sqrt(avg((V - Y_REG) ** 2)), 4) AS rmse, round(avg(abs(V - Y_REG)), 4) AS mae,
       round(1 - avg((V - Y_REG) ** 2) / var_pop(Y_REG), 6) AS r2 FROM valued"""))
def regression_metrics(spark, d):
    m = M.regression_metrics(valued(spark, d), "Y_REG", "V")
    return m.select(F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", PLACES).alias("r2"))


CONFUSION = """count(*) AS n, count(*) FILTER (WHERE y = yhat) AS hit, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp,
  count(*) FILTER (WHERE yhat = 1) AS flagged, count(*) FILTER (WHERE y = 1) AS positive"""


def confusion_sql(source: str) -> str:
    return f"""
SELECT CAST(hit AS DOUBLE) / n AS accuracy, coalesce(CAST(tp AS DOUBLE) / nullif(flagged, 0), 0) AS precision,
       coalesce(CAST(tp AS DOUBLE) / nullif(positive, 0), 0) AS recall,
       coalesce(2e0 * tp / nullif(flagged + positive, 0), 0) AS f1 FROM (SELECT {CONFUSION} FROM ({source}))"""


@query("confusion_metrics", with_sql(BASE_SQL, SCORED_SQL, select=f"""
SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
FROM ({confusion_sql('SELECT Y_BIN AS y, PREDICTION AS yhat FROM scored')})"""))
def confusion_metrics(spark, d):
    return rounded(M.confusion_metrics(X.scored(spark, d), "Y_BIN", "PREDICTION"))


REPORT_SQL = """
, classes AS (SELECT DISTINCT Y_MULTI AS CLASS FROM multi UNION SELECT DISTINCT PICK FROM multi)
, report AS (
  SELECT CLASS, coalesce(HIT / nullif(GUESSED, 0), 0) AS PRECISION, coalesce(HIT / nullif(SUPPORT, 0), 0) AS RECALL,
         coalesce(2 * HIT / nullif(GUESSED + SUPPORT, 0), 0) AS F1, CAST(SUPPORT AS BIGINT) AS SUPPORT
  FROM (SELECT CLASS, CAST(count(*) FILTER (WHERE Y_MULTI = CLASS AND PICK = CLASS) AS DOUBLE) AS HIT,
               CAST(count(*) FILTER (WHERE PICK = CLASS) AS DOUBLE) AS GUESSED,
               CAST(count(*) FILTER (WHERE Y_MULTI = CLASS) AS DOUBLE) AS SUPPORT
        FROM multi, classes GROUP BY CLASS)
)"""


@query("class_report", with_sql(BASE_SQL, SCORED_SQL, MULTI_SQL, REPORT_SQL, select="""
SELECT CLASS, round(PRECISION, 6) AS PRECISION, round(RECALL, 6) AS RECALL, round(F1, 6) AS F1, SUPPORT FROM report"""))
def class_report(spark, d):
    return rounded(M.class_report(multi(spark, d), "Y_MULTI", "PICK"), "CLASS", "SUPPORT")


@query("macro_metrics", with_sql(BASE_SQL, SCORED_SQL, MULTI_SQL, REPORT_SQL, select="""
SELECT round(avg(F1), 6) AS f1_macro, round(avg(PRECISION), 6) AS precision_macro, round(avg(RECALL), 6) AS recall_macro FROM report"""))
def macro_metrics(spark, d):
    return rounded(M.macro_metrics(multi(spark, d), "Y_MULTI", "PICK"))


def ranking_sql(source: str) -> str:
    """pr_auc and roc_auc over rows (y, s)."""
    return f"""
SELECT sum(POS * (RUN_POS / (RUN_POS + RUN_NEG))) / sum(POS) AS pr_auc,
       1 - sum(POS * (RUN_NEG - 0.5e0 * NEG)) / (sum(POS) * sum(NEG)) AS roc_auc
FROM (SELECT POS, NEG, sum(POS) OVER w AS RUN_POS, sum(NEG) OVER w AS RUN_NEG
      FROM (SELECT s, CAST(sum(y) AS DOUBLE) AS POS, CAST(sum(1 - y) AS DOUBLE) AS NEG FROM ({source}) GROUP BY s)
      WINDOW w AS (ORDER BY s DESC))"""


def decile_sql(source: str) -> str:
    """recall_at_decile and lift_at_decile over rows (id, y, s)."""
    return f"""
SELECT CAST(sum(y) FILTER (WHERE top) AS DOUBLE) / greatest(sum(y), 1) AS recall_at_decile,
       avg(y) FILTER (WHERE top) / greatest(avg(y), 1e-9) AS lift_at_decile
FROM (SELECT y, row_number() OVER (ORDER BY s DESC, md5('0|' || id)) <= greatest(count(*) OVER () // 10, 1) AS top FROM ({source}))"""


R1 = "SELECT ROW_ID AS id, Y_BIN AS y, PREDICTED_PROBABILITY AS s, PREDICTION AS yhat FROM scored"
R2 = "SELECT ROW_ID AS id, Y_BIN AS y, PREDICTED_PROBABILITY AS s, PREDICTION AS yhat FROM scored_2"
TIED = "SELECT ROW_ID AS id, Y_BIN AS y, round(PREDICTED_PROBABILITY, 2) AS s FROM scored"


@query("average_precision", with_sql(BASE_SQL, SCORED_SQL, select=f"SELECT round(pr_auc, 6) AS pr_auc FROM ({ranking_sql(R1)})"))
def average_precision(spark, d):
    return rounded(M.ranking_metrics(X.scored(spark, d), "Y_BIN", "PREDICTED_PROBABILITY").select("pr_auc"))


@query("roc_auc", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT round((sum(R) FILTER (WHERE Y_BIN = 1) - p * (p + 1) / 2e0) / (p * n), 6) AS roc_auc
FROM (SELECT Y_BIN, (rank() OVER (ORDER BY PREDICTED_PROBABILITY) + (count(*) OVER (PARTITION BY PREDICTED_PROBABILITY) - 1) / 2e0) AS R,
             CAST(sum(Y_BIN) OVER () AS DOUBLE) AS p, CAST(sum(1 - Y_BIN) OVER () AS DOUBLE) AS n FROM scored) GROUP BY p, n"""))
def roc_auc(spark, d):
    return rounded(M.ranking_metrics(X.scored(spark, d), "Y_BIN", "PREDICTED_PROBABILITY").select("roc_auc"))


@query("tied_ranking_metrics", with_sql(BASE_SQL, SCORED_SQL, select=f"""
SELECT round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc FROM ({ranking_sql(TIED)})"""))
def tied_ranking_metrics(spark, d):
    rows = X.scored(spark, d).select("Y_BIN", F.round("PREDICTED_PROBABILITY", 2).alias("S"))
    return rounded(M.ranking_metrics(rows, "Y_BIN", "S", rows_per_slice=3000))


@query("decile_metrics", with_sql(BASE_SQL, SCORED_SQL, select=f"""
SELECT round(recall_at_decile, 6) AS recall_at_decile, round(lift_at_decile, 6) AS lift_at_decile FROM ({decile_sql(R1)})"""))
def decile_metrics(spark, d):
    return rounded(M.decile_metrics(judged(spark, d), "Y_BIN", "PREDICTED_PROBABILITY", ["ROW_ID"]))


PRECISE_SQL = """
SELECT avg(CAST(Y_MULTI = PICK AS DOUBLE)) AS precision_at_decile FROM (
  SELECT * FROM multi QUALIFY row_number() OVER (ORDER BY CONFIDENCE DESC, md5('0|' || ROW_ID)) <= (SELECT greatest(count(*) // 10, 1) FROM multi))"""


@query("multiclass_decile_precision", with_sql(BASE_SQL, SCORED_SQL, MULTI_SQL, select=f"""
SELECT round(precision_at_decile, 6) AS precision_at_decile FROM ({PRECISE_SQL})"""))
def multiclass_decile_precision(spark, d):
    return rounded(M.decile_precision(judged_classes(spark, d), "Y_MULTI", "PICK", "CONFIDENCE", ["ROW_ID"]))


@query("metric_set_multiclass", with_sql(BASE_SQL, SCORED_SQL, MULTI_SQL, REPORT_SQL, select=f"""
SELECT (SELECT round(avg(CAST(Y_MULTI = PICK AS DOUBLE)), 6) FROM multi) AS accuracy, round(avg(F1), 6) AS f1_macro,
       round(avg(PRECISION), 6) AS precision_macro, round(avg(RECALL), 6) AS recall_macro,
       (SELECT round(precision_at_decile, 6) FROM ({PRECISE_SQL})) AS precision_at_decile FROM report"""))
def metric_set_multiclass(spark, d):
    return rounded(M.score_metrics(judged_classes(spark, d), "Y_MULTI", "PICK", "CONFIDENCE", ["ROW_ID"], "multiclass"))


BINARY_NAMES = ("pr_auc", "roc_auc", "accuracy", "precision", "recall", "f1", "recall_at_decile", "lift_at_decile")


def binary_set_sql(source: str) -> str:
    return f"SELECT * FROM ({ranking_sql(source)}), ({confusion_sql(source)}), ({decile_sql(source)})"


@query("metric_set_binary", with_sql(BASE_SQL, SCORED_SQL, select=f"""
SELECT {", ".join(f"round({n}, 6) AS {n}" for n in BINARY_NAMES)}, (SELECT round(avg(Y_BIN), 6) FROM scored) AS base_rate, 0.45e0 AS threshold
FROM ({binary_set_sql(R1.replace('PREDICTION AS yhat', 'CASE WHEN PREDICTED_PROBABILITY >= 0.45e0 THEN 1 ELSE 0 END AS yhat'))})"""))
def metric_set_binary(spark, d):
    return rounded(M.threshold_metrics(judged(spark, d), "Y_BIN", "PREDICTED_PROBABILITY", 0.45, ["ROW_ID"]))


COMPARE_SQL = f"""
, compared AS (
  SELECT 'LR_R1' AS model, * FROM ({binary_set_sql(R1)}) UNION ALL SELECT 'LR_R2', * FROM ({binary_set_sql(R2)})
)"""


def compared(spark, d):
    one = lambda v: M.score_metrics(judged(spark, d, v), "Y_BIN", "PREDICTION", "PREDICTED_PROBABILITY", ["ROW_ID"], "binary")
    return M.compare_models({v: one(v) for v in ("LR_R1", "LR_R2")})


@query("champion_challenger_table", with_sql(BASE_SQL, SCORED_SQL, SCORED_2_SQL, COMPARE_SQL, select=f"""
SELECT model, {", ".join(f"round({n}, 6) AS {n}" for n in BINARY_NAMES)} FROM compared"""))
def champion_challenger_table(spark, d):
    return rounded(compared(spark, d), "model")


@query("promotion_gate_binary", with_sql(BASE_SQL, SCORED_SQL, SCORED_2_SQL, COMPARE_SQL, select="""
SELECT D_RECALL > 5 AND D_PR > -10 AS promote, round(D_PR, 4) AS pr_auc_delta_pct, round(D_RECALL, 4) AS recall_at_decile_delta_pct,
       round(D_ROC, 4) AS roc_auc_delta
FROM (SELECT (n.pr_auc - o.pr_auc) / greatest(o.pr_auc, 1e-9) * 100 AS D_PR,
             (n.recall_at_decile - o.recall_at_decile) / greatest(o.recall_at_decile, 1e-9) * 100 AS D_RECALL, n.roc_auc - o.roc_auc AS D_ROC
      FROM compared o JOIN compared n ON o.model = 'LR_R1' AND n.model = 'LR_R2')"""))
def promotion_gate_binary(spark, d):
    gate = M.promotion_gate(compared(spark, d), "LR_R1", "LR_R2", "binary", 5.0, 10.0)
    return gate.select("promote", *[F.round(c, 4).alias(c) for c in gate.columns if c != "promote"])


@query("promotion_gate_regression", with_sql(BASE_SQL, VALUE_SQL, select="""
SELECT D_RMSE > 5 AND D_R2 > -0.1 AS promote, round(D_RMSE, 4) AS rmse_delta_pct, round(D_R2, 4) AS r2_delta
FROM (SELECT (o.e - n.e) / greatest(o.e, 1e-9) * 100 AS D_RMSE, n.r - o.r AS D_R2
      FROM (SELECT sqrt(avg((V - Y_REG) ** 2)) AS e, 1 - avg((V - Y_REG) ** 2) / var_pop(Y_REG) AS r FROM valued) o,
           (SELECT sqrt(avg((Y_REG * 0.05e0) ** 2)) AS e, 1 - avg((Y_REG * 0.05e0) ** 2) / var_pop(Y_REG) AS r FROM valued) n)"""))
def promotion_gate_regression(spark, d):
    rows = valued(spark, d).withColumn("W", F.col("Y_REG") * 1.05)
    table = M.compare_models({"A": M.regression_metrics(rows, "Y_REG", "V"), "B": M.regression_metrics(rows, "Y_REG", "W")})
    gate = M.promotion_gate(table, "A", "B", "regression", 5.0, 10.0)
    return gate.select("promote", F.round("rmse_delta_pct", 4).alias("rmse_delta_pct"), F.round("r2_delta", 4).alias("r2_delta"))


@query("promotion_gate_multiclass", with_sql(BASE_SQL, SCORED_SQL, MULTI_SQL, REPORT_SQL, f"""
, flat AS (SELECT CLASS, coalesce(2 * HIT / nullif(GUESSED + SUPPORT, 0), 0) AS F1
  FROM (SELECT CLASS, CAST(count(*) FILTER (WHERE Y_MULTI = CLASS AND CLASS = 'O') AS DOUBLE) AS HIT,
               CAST(count(*) FILTER (WHERE CLASS = 'O') AS DOUBLE) AS GUESSED, CAST(count(*) FILTER (WHERE Y_MULTI = CLASS) AS DOUBLE) AS SUPPORT
        FROM multi, (SELECT DISTINCT Y_MULTI AS CLASS FROM multi) GROUP BY CLASS))
, sides AS (
  SELECT (SELECT avg(F1) FROM report) AS o_f1, (SELECT avg(F1) FROM flat) AS n_f1,
         (SELECT precision_at_decile FROM ({PRECISE_SQL})) AS o_p,
         (SELECT precision_at_decile FROM ({PRECISE_SQL.replace('Y_MULTI = PICK', "Y_MULTI = 'O'")})) AS n_p
)""", select="""
SELECT D_F > 5 AND D_P > -10 AS promote, round(D_F, 4) AS f1_macro_delta_pct, round(D_P, 4) AS precision_at_decile_delta_pct
FROM (SELECT (n_f1 - o_f1) / greatest(o_f1, 1e-9) * 100 AS D_F, (n_p - o_p) / greatest(o_p, 1e-9) * 100 AS D_P FROM sides)"""))
def promotion_gate_multiclass(spark, d):
    rows = judged_classes(spark, d).withColumn("FLAT", F.lit("O"))
    sets = {v: M.score_metrics(rows, "Y_MULTI", c, "CONFIDENCE", ["ROW_ID"], "multiclass") for v, c in (("A", "PICK"), ("B", "FLAT"))}
    gate = M.promotion_gate(M.compare_models(sets), "A", "B", "multiclass", 5.0, 10.0)
    return gate.select("promote", *[F.round(c, 4).alias(c) for c in gate.columns if c != "promote"])
