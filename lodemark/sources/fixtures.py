"""Inputs with the shape a use case has, derived from the star-schema tables; `*_SQL` is the same in plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodemark.functions.columns import (at_least, cohort_of, json_number, linear_margin, logistic, matures_at, risk_band)
from lodemark.operators.encode import CAT_OHE, NUM, Contract, Feature, encode
from lodemark.operators.joins import latest_per_key
from lodemark.settings import DataSpec, ScoringSpec, UseCase

FEED_START = "2000-01-01 00:00:00"
NOW = "2001-06-15 10:30:00"
HORIZON_DAYS = 90
HIGH, MEDIUM = 0.7, 0.5   # fixed cuts of the fixture; the cutoff operator is checked on its own

CONTRACT = Contract((
    Feature("TOTAL_PRICE", "TOTAL_PRICE", NUM),
    Feature("PRIORITY_1_URGENT", "PRIORITY", CAT_OHE),
    Feature("ACCT_BAL", "ACCT_BAL", NUM),
    Feature("N_LINES", "N_LINES", NUM),
))
MODELS = {
    "LR_R1": (-3.0, {"TOTAL_PRICE": 8e-6, "PRIORITY_1_URGENT": 0.8, "ACCT_BAL": -1e-4, "N_LINES": 0.1}),
    "LR_R2": (-3.2, {"TOTAL_PRICE": 8e-6, "PRIORITY_1_URGENT": 1.2, "ACCT_BAL": -1e-4, "N_LINES": 0.1}),
}
IMPUTE = {"N_LINES": 0.0}

DATA = DataSpec(
    keys=("ENTITY_ID", "ROW_ID"), timestamp="COHORT", target="Y_BIN",
    categorical=("PRIORITY", "SEGMENT"), numeric=("TOTAL_PRICE", "ACCT_BAL", "N_LINES", "QTY", "AVG_DISC"),
    median_impute=("N_LINES", "AVG_DISC"), watermark="RECORD_TS", passthrough=("NATION",))
USE_CASE = UseCase(name="ORDERS", data=DATA, scoring=ScoringSpec(horizon_days=HORIZON_DAYS))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with features of its lines and its customer."""
    returned = F.col("l_returnflag") == "R"
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("N_LINES"), F.sum("l_quantity").alias("QTY"), F.avg("l_discount").alias("AVG_DISC"),
        F.count_if(returned).alias("N_RETURNED"))
    orders, customers, nations = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
              .join(customers, orders.o_custkey == customers.c_custkey)
              .join(nations, customers.c_nationkey == nations.n_nationkey))
    return joined.select(
        F.col("o_orderkey").alias("ROW_ID"), F.col("o_custkey").alias("ENTITY_ID"), F.col("o_orderdate").alias("RECORD_TS"),
        cohort_of(F.col("o_orderdate")).alias("COHORT"), F.col("o_orderpriority").alias("PRIORITY"),
        F.col("c_mktsegment").alias("SEGMENT"), F.col("n_name").alias("NATION"), F.col("o_totalprice").alias("TOTAL_PRICE"),
        F.col("c_acctbal").alias("ACCT_BAL"), "N_LINES", "QTY", "AVG_DISC", "N_RETURNED",
        F.when(F.coalesce("N_RETURNED", F.lit(0)) >= 3, 1).otherwise(0).alias("Y_BIN"),
        F.col("o_orderstatus").alias("Y_MULTI"), F.col("o_totalprice").alias("Y_REG"))


BASE_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS N_LINES, sum(l_quantity) AS QTY, avg(l_discount) AS AVG_DISC,
         count(*) FILTER (WHERE l_returnflag = 'R') AS N_RETURNED
  FROM lineitem GROUP BY l_orderkey
), base AS (
  SELECT o_orderkey AS ROW_ID, o_custkey AS ENTITY_ID, o_orderdate AS RECORD_TS,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS COHORT,
         o_orderpriority AS PRIORITY, c_mktsegment AS SEGMENT, n_name AS NATION,
         o_totalprice AS TOTAL_PRICE, c_acctbal AS ACCT_BAL, N_LINES, QTY, AVG_DISC, N_RETURNED,
         CASE WHEN coalesce(N_RETURNED, 0) >= 3 THEN 1 ELSE 0 END AS Y_BIN,
         o_orderstatus AS Y_MULTI, o_totalprice AS Y_REG
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).where(F.col("RECORD_TS") < F.lit(FEED_START).cast("timestamp_ntz"))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).where(F.col("RECORD_TS") >= F.lit(FEED_START).cast("timestamp_ntz"))


FEED_SQL = f""", history AS (SELECT * FROM base WHERE RECORD_TS < TIMESTAMP '{FEED_START}')
, feed AS (SELECT * FROM base WHERE RECORD_TS >= TIMESTAMP '{FEED_START}')"""


def score_rows(rows: DataFrame, version: str = "LR_R1") -> DataFrame:
    """Closed-form scores of `base` rows, in the shape of the monitor table. Scores keep 6 places, so ties occur."""
    intercept, weights = MODELS[version]
    carried = ["ROW_ID", "ENTITY_ID", "RECORD_TS", "COHORT", "Y_BIN", "Y_MULTI", "Y_REG", "N_RETURNED"]
    scored = encode(rows, CONTRACT, carried, IMPUTE).withColumn(
        "PREDICTED_PROBABILITY", F.round(logistic(linear_margin(weights, intercept)), 6))
    score, at = F.col("PREDICTED_PROBABILITY"), F.date_trunc("month", "RECORD_TS").cast("timestamp_ntz")
    scored_at = at + F.make_ym_interval(months=F.lit(1))
    return scored.select("*", at_least(score, HIGH).alias("PREDICTION"), risk_band(score, HIGH, MEDIUM).alias("RISK_BAND"),
                         scored_at.alias("SCORED_AT"), matures_at(scored_at, HORIZON_DAYS).alias("LABEL_MATURE_AT"),
                         F.lit(version).alias("MODEL_VERSION"))


def scored(spark: SparkSession, sf_dir: str, version: str = "LR_R1") -> DataFrame:
    return score_rows(base(spark, sf_dir), version)


def _scored_sql(name: str, version: str) -> str:
    intercept, w = MODELS[version]
    urgent = "CASE WHEN PRIORITY = '1-URGENT' THEN 1e0 ELSE 0e0 END"
    return f"""
, {name}_raw AS (
  SELECT ROW_ID, ENTITY_ID, RECORD_TS, COHORT, Y_BIN, Y_MULTI, Y_REG, N_RETURNED,
         TOTAL_PRICE, {urgent} AS PRIORITY_1_URGENT, ACCT_BAL, CAST(coalesce(N_LINES, 0) AS DOUBLE) AS N_LINES
  FROM base
), {name} AS (
  SELECT *, CASE WHEN PREDICTED_PROBABILITY >= {HIGH}e0 THEN 1 ELSE 0 END AS PREDICTION,
         CASE WHEN PREDICTED_PROBABILITY >= {HIGH}e0 THEN 'HIGH'
              WHEN PREDICTED_PROBABILITY >= {MEDIUM}e0 THEN 'MEDIUM' ELSE 'LOW' END AS RISK_BAND,
         SCORED_AT + INTERVAL {HORIZON_DAYS} DAY AS LABEL_MATURE_AT, '{version}' AS MODEL_VERSION
  FROM (SELECT *, CAST(date_trunc('month', RECORD_TS) + INTERVAL 1 MONTH AS TIMESTAMP) AS SCORED_AT,
               round(1e0 / (1e0 + exp(-({intercept}e0 + TOTAL_PRICE * {w['TOTAL_PRICE']:e}
                 + PRIORITY_1_URGENT * {w['PRIORITY_1_URGENT']:e} + ACCT_BAL * ({w['ACCT_BAL']:e})
                 + N_LINES * {w['N_LINES']:e}))), 6) AS PREDICTED_PROBABILITY
        FROM {name}_raw)
)"""


SCORED_SQL = _scored_sql("scored", "LR_R1")
SCORED_2_SQL = _scored_sql("scored_2", "LR_R2")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What really happened, one row per entity of the feed: NULL when the entity has no lines."""
    share = F.try_divide(F.sum(F.coalesce("N_RETURNED", F.lit(0))).cast("double"), F.sum("N_LINES"))
    return feed(spark, sf_dir).groupBy("ENTITY_ID").agg(share.alias("SHARE")).select(
        "ENTITY_ID", F.when(F.col("SHARE") >= 0.45, 1).when(F.col("SHARE").isNotNull(), 0).alias("OUTCOME"))


OUTCOMES_SQL = """
, outcomes AS (
  SELECT ENTITY_ID, CASE WHEN SHARE >= 0.45e0 THEN 1 WHEN SHARE IS NOT NULL THEN 0 END AS OUTCOME
  FROM (SELECT ENTITY_ID, CAST(sum(coalesce(N_RETURNED, 0)) AS DOUBLE) / sum(N_LINES) AS SHARE FROM feed GROUP BY ENTITY_ID)
)"""


def outcome_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcomes twice: a day later every flag is corrected to the opposite."""
    first = outcomes(spark, sf_dir)
    at = lambda day: F.lit(day).cast("timestamp_ntz").alias("OUTCOME_TS")
    return (first.select("ENTITY_ID", "OUTCOME", at("2001-01-01"))
            .unionByName(first.select("ENTITY_ID", (1 - F.col("OUTCOME")).alias("OUTCOME"), at("2001-01-02"))))


OUTCOME_VERSIONS_SQL = """
, outcome_versions AS (
  SELECT ENTITY_ID, OUTCOME, TIMESTAMP '2001-01-01' AS OUTCOME_TS FROM outcomes
  UNION ALL SELECT ENTITY_ID, 1 - OUTCOME, TIMESTAMP '2001-01-02' FROM outcomes
)"""


def monitor(spark: SparkSession, sf_dir: str, labeled: bool = True, version: str = "LR_R1") -> DataFrame:
    """Scored feed rows. Labeled: those mature at NOW whose entity has an outcome carry it."""
    rows = score_rows(feed(spark, sf_dir), version).withColumn(
        "PROBABLE_CAUSES", F.when(F.col("PRIORITY_1_URGENT") == 1, "PRIORITY"))
    if not labeled:
        return rows.withColumn("ACTUAL_LABEL", F.lit(None).cast("bigint"))
    mature = F.col("LABEL_MATURE_AT") <= F.lit(NOW).cast("timestamp_ntz")
    return rows.join(outcomes(spark, sf_dir), "ENTITY_ID", "left").withColumn(
        "ACTUAL_LABEL", F.when(mature, F.col("OUTCOME").cast("bigint"))).drop("OUTCOME")


MONITOR_SQL = f"""
, monitor_new AS (
  SELECT *, CASE WHEN PRIORITY_1_URGENT = 1 THEN 'PRIORITY' END AS PROBABLE_CAUSES, CAST(NULL AS BIGINT) AS ACTUAL_LABEL
  FROM scored WHERE RECORD_TS >= TIMESTAMP '{FEED_START}'
), monitor AS (
  SELECT m.* EXCLUDE (ACTUAL_LABEL),
         CASE WHEN LABEL_MATURE_AT <= TIMESTAMP '{NOW}' THEN CAST(OUTCOME AS BIGINT) END AS ACTUAL_LABEL
  FROM monitor_new m LEFT JOIN outcomes USING (ENTITY_ID)
)"""


def baseline(spark: SparkSession, sf_dir: str, version: str = "LR_R1") -> DataFrame:
    """Scores of all history before the feed starts."""
    return score_rows(history(spark, sf_dir), version).withColumns({
        "PROBABLE_CAUSES": F.when(F.col("PRIORITY_1_URGENT") == 1, "PRIORITY"), "ACTUAL_LABEL": F.col("Y_BIN").cast("bigint")})


BASELINE_SQL = f"""
, baseline AS (
  SELECT *, CASE WHEN PRIORITY_1_URGENT = 1 THEN 'PRIORITY' END AS PROBABLE_CAUSES, CAST(Y_BIN AS BIGINT) AS ACTUAL_LABEL
  FROM scored WHERE RECORD_TS < TIMESTAMP '{FEED_START}'
)"""


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second feed: events with a JSON text column."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("ROW_ID"), F.col("user_id").alias("ENTITY_ID"), F.col("ts").alias("RECORD_TS"),
        F.col("event_type").alias("EVENT_TYPE"), F.col("value").alias("VALUE"), F.col("props").alias("PROPS"),
        json_number(F.col("props"), "k").alias("K"))


EVENT_FEED_SQL = """
event_feed AS (
  SELECT event_id AS ROW_ID, user_id AS ENTITY_ID, ts AS RECORD_TS, event_type AS EVENT_TYPE, value AS VALUE,
         props AS PROPS, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS K
  FROM events
)"""


def outcome_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the account of their entity, for the simulated outcomes."""
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ENTITY_ID"), F.col("c_acctbal").alias("ACCT_BAL"),
                                                       F.col("c_nationkey").alias("NATION_KEY"))
    return event_feed(spark, sf_dir).join(customers, "ENTITY_ID")


def latest_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(feed(spark, sf_dir), ["ENTITY_ID"], "RECORD_TS", ["ROW_ID"])


def contributions_sql(version: str = "LR_R1") -> str:
    """w · (x − mean) of every encoded feature over all scored rows, as CTE `contributions`."""
    _, w = MODELS[version]
    parts = ", ".join(f"({c} - avg({c}) OVER ()) * ({w[c]:e}) AS C_{c}" for c in w)
    return f"\n, contributions AS (SELECT ROW_ID, {parts} FROM scored)"


def with_sql(*ctes: str, select: str) -> str:
    return "WITH " + "".join(ctes).strip() + "\n" + select.strip()
