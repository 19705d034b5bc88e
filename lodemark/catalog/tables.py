"""Sinks and table changes: each query writes through the store in the shared folder and returns what readers then see."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from lodemark.catalog import query
from lodemark.catalog.encoding import CONTRACT_SQL, VOCABULARY_SQL
from lodemark.functions.columns import digest
from lodemark.operators import encode as E
from lodemark.operators.labels import label_counts, label_updates
from lodemark.sources import fixtures as X
from lodemark.sources import store as S
from lodemark.sources.fixtures import (BASE_SQL, BASELINE_SQL, FEED_SQL, MONITOR_SQL, NOW, OUTCOMES_SQL, SCORED_SQL, with_sql)
from lodemark.sources.scans import shared_folder, staged

ALL = (BASE_SQL, FEED_SQL, OUTCOMES_SQL, SCORED_SQL, MONITOR_SQL, BASELINE_SQL)
AT = datetime.fromisoformat(NOW)
SCORE_COLUMNS = ["ENTITY_ID", "ROW_ID", "RECORD_TS", *X.CONTRACT.encoded, "PREDICTED_PROBABILITY", "PREDICTION", "RISK_BAND",
                 "PROBABLE_CAUSES", "SCORED_AT", "LABEL_MATURE_AT", "MODEL_VERSION"]


def new_store(spark) -> S.Store:
    return S.Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", X.USE_CASE)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def scored_store(spark, d) -> S.Store:
    """A store that holds the feed's scores as one committed run."""
    store = new_store(spark)
    rows = X.monitor(spark, d, labeled=False).select(*SCORE_COLUMNS).withColumn("FEED_ROW_ID", digest(F.col("ROW_ID")))
    _, newest = store.write_scores(rows, "run-1", "RECORD_TS")
    store.commit("run-1", newest, AT)
    return store


RUNS_SQL = """
runs AS (
  SELECT c_mktsegment AS USE_CASE_NAME, 'V' || c_nationkey AS MODEL_VERSION, max(c_custkey) AS LAST_KEY,
         TIMESTAMP '2000-01-01' + to_days(CAST(max(c_custkey) % 7 AS INTEGER)) AS CREATED_AT
  FROM customer GROUP BY 1, 2
)"""


@query("latest_run", with_sql(RUNS_SQL, select="""
SELECT USE_CASE_NAME, MODEL_VERSION, CAST(LAST_KEY AS DOUBLE) AS LAST_KEY, CREATED_AT FROM runs WHERE USE_CASE_NAME = 'BUILDING'
ORDER BY CREATED_AT DESC, MODEL_VERSION DESC LIMIT 1"""))
def latest_run(spark, d):
    """A run log derived from customers: one run per segment and nation, metrics as JSON."""
    runs = X.read(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("USE_CASE_NAME"), "c_nationkey").agg(F.max("c_custkey").alias("K"))
    created = F.lit("2000-01-01").cast("timestamp_ntz") + F.make_interval(days=(F.col("K") % 7).cast("int"))
    rows = runs.select("USE_CASE_NAME", F.concat(F.lit("V"), "c_nationkey").alias("MODEL_VERSION"),
                       F.to_json(F.struct(F.col("K").alias("LAST_KEY"))).alias("METRICS_JSON"), created.alias("CREATED_AT"))
    found = S.latest_run(rows, "BUILDING")
    return found.select("USE_CASE_NAME", "MODEL_VERSION", "CREATED_AT",
                        F.from_json("METRICS_JSON", "LAST_KEY double").getField("LAST_KEY").alias("LAST_KEY"))


@query("contract_replace_partition", with_sql(BASE_SQL, FEED_SQL, ", ", VOCABULARY_SQL, CONTRACT_SQL, select="""
SELECT ORDER_IDX, ENCODED_NAME, SOURCE_NAME, FEATURE_ROLE, 'LR_R1' AS MODEL_VERSION FROM contract
UNION ALL SELECT ORDER_IDX, ENCODED_NAME, SOURCE_NAME, FEATURE_ROLE, 'LR_R2' FROM contract"""))
def contract_replace_partition(spark, d):
    """A first contract of version LR_R1 is replaced; LR_R2, written in between, stays."""
    store, contract = new_store(spark), E.fit_contract(X.history(spark, d), X.DATA)
    store.save_contract(X.CONTRACT, "LR_R1", now())
    store.save_contract(contract, "LR_R2", now())
    store.save_contract(contract, "LR_R1", now())
    return store.contracts().select("ORDER_IDX", "ENCODED_NAME", "SOURCE_NAME", "FEATURE_ROLE", "MODEL_VERSION")


@query("contract_newest_batch", with_sql(BASE_SQL, FEED_SQL, ", ", VOCABULARY_SQL, CONTRACT_SQL, select="SELECT ORDER_IDX, ENCODED_NAME FROM contract"))
def contract_newest_batch(spark, d):
    """Two stacked batches of one version: only the newest counts."""
    contract = E.fit_contract(X.history(spark, d), X.DATA)
    stacked = X.CONTRACT.to_frame(spark, "ORDERS", "LR_R1", F.lit("2000-01-01")).unionByName(
        contract.to_frame(spark, "ORDERS", "LR_R1", F.lit("2000-01-02")))
    return S.newest_contract(stacked, "ORDERS", "LR_R1").orderBy("ORDER_IDX").select("ORDER_IDX", "ENCODED_NAME")


@query("overwrite_recast_timestamps", with_sql(*ALL, select="SELECT ROW_ID, SCORED_AT, LABEL_MATURE_AT, RISK_BAND FROM baseline"))
def overwrite_recast_timestamps(spark, d):
    """The baseline with its timestamps as text, recast when it is written; the second write replaces the first."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    rows = X.baseline(spark, d).select("ROW_ID", "RISK_BAND", text("SCORED_AT"), text("LABEL_MATURE_AT"))
    store = new_store(spark)
    store.save_baseline(rows.where("RISK_BAND = 'HIGH'"), "LR_R1")
    store.save_baseline(S.recast_timestamps(rows, ["SCORED_AT", "LABEL_MATURE_AT"]), "LR_R1")
    return store.baseline("LR_R1").select("ROW_ID", "SCORED_AT", "LABEL_MATURE_AT", "RISK_BAND")


@query("monitor_seed", with_sql(*ALL, select="SELECT ROW_ID, PREDICTED_PROBABILITY, ACTUAL_LABEL FROM baseline"))
def monitor_seed(spark, d):
    """The monitor starts as a labeled copy of the baseline; seeding again changes nothing."""
    store = new_store(spark)
    rows = X.baseline(spark, d).select(*SCORE_COLUMNS, "ACTUAL_LABEL").withColumn("FEED_ROW_ID", digest(F.col("ROW_ID")))
    for _ in range(2):
        store.seed_monitor(rows, AT, now())
    return store.monitor().select("ROW_ID", "PREDICTED_PROBABILITY", "ACTUAL_LABEL")


@query("scored_batch_append", with_sql(*ALL, select="""
SELECT ROW_ID, PREDICTED_PROBABILITY, RISK_BAND, CAST(NULL AS BIGINT) AS ACTUAL_LABEL, LABEL_MATURE_AT FROM monitor_new"""))
def scored_batch_append(spark, d):
    """Two runs written, one of them twice and one never committed: readers see the committed rows once."""
    store = scored_store(spark, d)
    again = staged(store.run_scores("run-1").drop("RUN_ID", "USE_CASE_NAME"))
    store.write_scores(again, "run-1", "RECORD_TS")
    store.write_scores(again, "run-2", "RECORD_TS")
    return store.monitor().select("ROW_ID", "PREDICTED_PROBABILITY", "RISK_BAND", "ACTUAL_LABEL", "LABEL_MATURE_AT")


@query("label_backfill", with_sql(*ALL, select="SELECT ROW_ID, ACTUAL_LABEL FROM monitor"))
def label_backfill(spark, d):
    store = scored_store(spark, d)
    fill(store, X.outcomes(spark, d))
    return store.monitor().select("ROW_ID", "ACTUAL_LABEL")


def fill(store, outcomes) -> int:
    updates = label_updates(store.monitor(), outcomes, "ENTITY_ID", "OUTCOME", "binary", now())
    return store.add_labels(updates.select("RUN_ID", "FEED_ROW_ID", "GT_LABEL"), now())


@query("label_backfill_repeat", with_sql(*ALL, select="""
SELECT count(ACTUAL_LABEL) AS FIRST_RUN, CAST(0 AS BIGINT) AS SECOND_RUN, count(*) AS TOTAL_ROWS, count(ACTUAL_LABEL) AS LABELED,
       count(*) - count(ACTUAL_LABEL) AS WAITING FROM monitor"""))
def label_backfill_repeat(spark, d):
    store, outcomes = scored_store(spark, d), staged(X.outcomes(spark, d))
    first, second = fill(store, outcomes), fill(store, outcomes)
    return label_counts(store.monitor()).select(F.lit(first).cast("bigint").alias("FIRST_RUN"), F.lit(second).cast("bigint").alias("SECOND_RUN"), "*")


@query("business_upsert", with_sql(BASE_SQL, FEED_SQL, SCORED_SQL, select="""
SELECT coalesce(c_custkey, ENTITY_ID) AS CUSTOMER, c_name AS NAME, coalesce(P, c_acctbal) AS SCORE,
       CASE WHEN ENTITY_ID IS NOT NULL THEN TIMESTAMP '2001-06-15 10:30:00' END AS SYS_UPD_DT
FROM (SELECT * FROM customer WHERE c_custkey IN (SELECT ENTITY_ID FROM history)) FULL JOIN (
  SELECT ENTITY_ID, max(PREDICTED_PROBABILITY) AS P FROM scored WHERE RECORD_TS >= TIMESTAMP '2000-01-01' GROUP BY 1) ON c_custkey = ENTITY_ID"""))
def business_upsert(spark, d):
    """Customers of the history are known and keep their name; those that first come with the feed are added without one."""
    customers = X.read(spark, d, "customer")
    seen = X.history(spark, d).select(F.col("ENTITY_ID").alias("c_custkey"))
    target = customers.join(seen, "c_custkey", "left_semi").select(
        F.col("c_custkey").alias("CUSTOMER"), F.col("c_name").alias("NAME"), F.col("c_acctbal").alias("SCORE"),
        F.lit(None).cast("timestamp_ntz").alias("SYS_UPD_DT"))
    source = X.scored(spark, d).where("RECORD_TS >= TIMESTAMP_NTZ '2000-01-01 00:00:00'").groupBy(
        F.col("ENTITY_ID").alias("CUSTOMER")).agg(F.max("PREDICTED_PROBABILITY").alias("SCORE"))
    return S.upsert(target, source, ["CUSTOMER"], now())


@query("business_table_by_delta", with_sql(BASE_SQL, FEED_SQL, SCORED_SQL, select="""
SELECT CUSTOMER, RISK_BAND, SYS_UPD_DT FROM (
  SELECT ENTITY_ID AS CUSTOMER, RISK_BAND, CASE WHEN COHORT < 200007 THEN TIMESTAMP '2000-07-01' ELSE TIMESTAMP '2001-01-01' END AS SYS_UPD_DT
  FROM scored WHERE RECORD_TS >= TIMESTAMP '2000-01-01' AND COHORT < 200101
  QUALIFY row_number() OVER (PARTITION BY ENTITY_ID ORDER BY RECORD_TS DESC, ROW_ID DESC) = 1)"""))
def business_table_by_delta(spark, d):
    """One delta per run, newest committed value per key; the third run is never committed."""
    from lodemark.operators.joins import latest_per_key

    store, rows = new_store(spark), staged(X.score_rows(X.feed(spark, d)))
    for i, (low, high, at) in enumerate(((200001, 200007, "2000-07-01"), (200007, 200101, "2001-01-01"), (200101, 209901, "2001-07-01"))):
        delta = latest_per_key(rows.where(f"COHORT >= {low} AND COHORT < {high}"), ["ENTITY_ID"], "RECORD_TS", ["ROW_ID"])
        store.add_business(delta.select(F.col("ENTITY_ID").alias("CUSTOMER"), "RISK_BAND",
                                        F.lit(at).cast("timestamp_ntz").alias("SYS_UPD_DT")), f"run-{i}")
        if i < 2:
            store.commit(f"run-{i}", None, AT)
    return store.business("CUSTOMER")


@query("watermark_upsert", with_sql(BASE_SQL, FEED_SQL, select="""
SELECT max(RECORD_TS) AS LAST_RECORD_TS, TIMESTAMP '2001-06-15 10:30:00' AS UPDATED_AT FROM feed"""))
def watermark_upsert(spark, d):
    return S.current_watermark(scored_store(spark, d).commits()).select("LAST_RECORD_TS", "UPDATED_AT")


@query("rollback_unlabeled", with_sql(*ALL, select="SELECT ROW_ID, ACTUAL_LABEL, TIMESTAMP '2000-01-01' AS WATERMARK FROM monitor WHERE ACTUAL_LABEL IS NOT NULL"))
def rollback_unlabeled(spark, d):
    """After the back-fill the version is rolled back: labeled rows stay, the watermark is the older one."""
    store = scored_store(spark, d)
    fill(store, X.outcomes(spark, d))
    store.roll_back("LR_R1")
    store.reset_watermark(datetime(2000, 1, 1), datetime(2001, 6, 16))
    return store.monitor().select("ROW_ID", "ACTUAL_LABEL", F.lit(store.watermark()).cast("timestamp_ntz").alias("WATERMARK"))


@query("log_append", with_sql(BASE_SQL, select="""
SELECT 'ORDERS' AS USE_CASE_NAME, 'SCORE_BATCH' AS PROCEDURE_NAME, count(*) AS N_ROWS, 'OK' AS STATUS, 'scored ' || count(*) || ' rows' AS MESSAGE FROM base
UNION ALL SELECT 'ORDERS', 'SCORE_BATCH', 0, 'SKIPPED', 'no new rows to score'"""))
def log_append(spark, d):
    store, n = new_store(spark), X.base(spark, d).count()
    store.log("SCORE_BATCH", n, "OK", f"scored {n} rows", AT)
    store.log("SCORE_BATCH", 0, "SKIPPED", "no new rows to score", AT)
    return store.log_rows().drop("RUN_TS")


@query("report_view", with_sql(BASE_SQL, SCORED_SQL, select="SELECT RISK_BAND, count(*) AS N FROM scored GROUP BY 1"))
def report_view(spark, d):
    """A saved view over a query, read back by SQL."""
    X.scored(spark, d).createOrReplaceTempView("scored_rows_view")
    return spark.sql("SELECT RISK_BAND, count(*) AS N FROM scored_rows_view GROUP BY RISK_BAND")
