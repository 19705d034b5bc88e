"""Scans, scalar expressions, encoding and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodemark.catalog import query
from lodemark.functions.columns import (as_ordinal, at_least, best_class, cohort_of, cohort_start, digest, json_number,
                                        label_as, matures_at, midnight, normalize_category, numeric_column, risk_band,
                                        stable_bucket)
from lodemark.operators import encode as E
from lodemark.operators import targets as T
from lodemark.sources import fixtures as X
from lodemark.sources.fixtures import BASE_SQL, EVENT_FEED_SQL, FEED_SQL, NOW, SCORED_SQL, with_sql
from lodemark.sources.scans import batch_bounds, incremental_rows, late_rows, load_source

NORMAL = "coalesce(nullif(trim(regexp_replace(upper(trim(CAST({c} AS VARCHAR))), '[^A-Z0-9]+', '_', 'g'), '_'), ''), 'MISSING')"


def normal_sql(c: str) -> str:
    return NORMAL.format(c=c)


@query("source_scan", "SELECT o_orderkey AS O_ORDERKEY, o_totalprice AS O_TOTALPRICE, o_orderdate AS O_ORDERDATE FROM orders")
def source_scan(spark, d):
    return load_source(spark, f"{d}/orders.parquet", ["O_ORDERKEY", "O_TOTALPRICE", "O_ORDERDATE"])


@query("normalize_category", f"""
SELECT o_orderkey AS ROW_ID, {normal_sql('o_orderpriority')} AS PRIORITY, {normal_sql("replace(o_orderpriority, 'LOW', ' ')")} AS CUT,
       {normal_sql('o_totalprice > 0')} AS FLAG, {normal_sql("nullif(o_orderstatus, 'P')")} AS STATUS FROM orders""")
def normalize(spark, d):
    o = X.read(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("ROW_ID"), normalize_category(F.col("o_orderpriority")).alias("PRIORITY"),
                    normalize_category(F.replace("o_orderpriority", F.lit("LOW"), F.lit(" "))).alias("CUT"),
                    normalize_category(F.col("o_totalprice") > 0).alias("FLAG"),
                    normalize_category(F.nullif("o_orderstatus", F.lit("P"))).alias("STATUS"))


@query("normalize_document_category", f"SELECT doc_id, {normal_sql('source')} AS SOURCE, {normal_sql('lang')} AS LANG FROM documents")
def normalize_documents(spark, d):
    return X.read(spark, d, "documents").select("doc_id", normalize_category(F.col("source")).alias("SOURCE"),
                                                normalize_category(F.col("lang")).alias("LANG"))


@query("coerce_number", """
SELECT o_orderkey AS ROW_ID, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS LEVEL,
       TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS DOUBLE) AS CUST,
       TRY_CAST(CAST(o_custkey AS VARCHAR) || 'd' AS DOUBLE) AS SUFFIXED FROM orders""")
def coerce(spark, d):
    cust = F.col("o_custkey").cast("string")
    text = X.read(spark, d, "orders").select(
        F.col("o_orderkey").alias("ROW_ID"), F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("LEVEL"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(cust).alias("CUST"), F.concat(cust, F.lit("d")).alias("SUFFIXED"))
    return text.select("ROW_ID", *[numeric_column(text, c).alias(c) for c in ("LEVEL", "CUST", "SUFFIXED")])


VOCABULARY_SQL = f"""
vocabulary AS (
  SELECT DISTINCT 'PRIORITY' AS SOURCE_NAME, {normal_sql('PRIORITY')} AS VALUE FROM history
  UNION SELECT DISTINCT 'SEGMENT', {normal_sql('SEGMENT')} FROM history
)"""


@query("one_hot_vocabulary", with_sql(BASE_SQL, FEED_SQL, ", ", VOCABULARY_SQL, select="SELECT * FROM vocabulary"))
def one_hot_vocabulary(spark, d):
    return E.vocabulary(X.history(spark, d), X.DATA.categorical)


NUMERIC = X.DATA.numeric
CONTRACT_SQL = f"""
, names AS (
  SELECT * FROM (VALUES {", ".join(f"({i}, '', '{c}', '{c}', 'NUM')" for i, c in enumerate(NUMERIC))})
    AS v(GRP, VAL, ENCODED_NAME, SOURCE_NAME, FEATURE_ROLE)
  UNION ALL SELECT 100, VALUE, 'PRIORITY_' || VALUE, 'PRIORITY', 'CAT_OHE' FROM vocabulary WHERE SOURCE_NAME = 'PRIORITY'
  UNION ALL SELECT 200, VALUE, 'SEGMENT_' || VALUE, 'SEGMENT', 'CAT_OHE' FROM vocabulary WHERE SOURCE_NAME = 'SEGMENT'
), contract AS (
  SELECT CAST(row_number() OVER (ORDER BY GRP, VAL) - 1 AS INTEGER) AS ORDER_IDX, ENCODED_NAME, SOURCE_NAME, FEATURE_ROLE FROM names
)"""


@query("feature_contract", with_sql(BASE_SQL, FEED_SQL, ", ", VOCABULARY_SQL, CONTRACT_SQL, select="SELECT * FROM contract"))
def feature_contract(spark, d):
    contract = E.fit_contract(X.history(spark, d), X.DATA)
    frame = contract.to_frame(spark, "ORDERS", "LR_R1", F.lit(NOW))
    return frame.select("ORDER_IDX", "ENCODED_NAME", "SOURCE_NAME", "FEATURE_ROLE")


@query("encoded_source_map", with_sql(BASE_SQL, select=f"""
SELECT ENCODED, CASE WHEN ENCODED = 'SEGMENT_NATION' OR starts_with(ENCODED, 'SEGMENT_NATION_') THEN 'SEGMENT_NATION'
                     WHEN ENCODED = 'SEGMENT' OR starts_with(ENCODED, 'SEGMENT_') THEN 'SEGMENT'
                     WHEN ENCODED = 'NATION' OR starts_with(ENCODED, 'NATION_') THEN 'NATION' ELSE ENCODED END AS SOURCE_NAME
FROM (SELECT DISTINCT unnest(['SEGMENT_' || SEGMENT, 'SEGMENT_NATION_' || NATION, 'NATION_' || NATION, 'NATION', 'SEGMENTED']) AS ENCODED
      FROM base)"""))
def encoded_source_map(spark, d):
    names = X.base(spark, d).select(F.explode(F.array(
        F.concat(F.lit("SEGMENT_"), "SEGMENT"), F.concat(F.lit("SEGMENT_NATION_"), "NATION"),
        F.concat(F.lit("NATION_"), "NATION"), F.lit("NATION"), F.lit("SEGMENTED"))).alias("ENCODED")).distinct()
    return names.select("ENCODED", E.source_name(F.col("ENCODED"), ["SEGMENT", "NATION", "SEGMENT_NATION"]).alias("SOURCE_NAME"))


ENCODE_CONTRACT = E.Contract((
    *[E.Feature(c, c, E.NUM) for c in NUMERIC],
    *[E.Feature(f"PRIORITY_{v}", "PRIORITY", E.CAT_OHE) for v in ("1_URGENT", "2_HIGH", "NEVER_SEEN")],
    E.Feature("ABSENT_X", "ABSENT", E.CAT_OHE)))


def encoded_sql(fill: dict[str, str]) -> str:
    numbers = ", ".join(f"coalesce(CAST({c} AS DOUBLE), {fill[c]})" + f" AS {c}" if c in fill else f"CAST({c} AS DOUBLE) AS {c}"
                        for c in NUMERIC if c != "AVG_DISC")
    disc = f"coalesce(AVG_DISC, {fill['AVG_DISC']})" if "AVG_DISC" in fill else "AVG_DISC"
    flags = ", ".join(f"CASE WHEN {normal_sql('PRIORITY')} = '{v}' THEN 1e0 ELSE 0e0 END AS \"PRIORITY_{v}\""
                      for v in ("1_URGENT", "2_HIGH", "NEVER_SEEN"))
    return f"{numbers}, round({disc}, 6) AS AVG_DISC, {flags}, 0e0 AS ABSENT_X"


def _rounded(df):
    return df.withColumn("AVG_DISC", F.round("AVG_DISC", 6))


@query("one_hot_encode", with_sql(BASE_SQL, select=f"SELECT ROW_ID, {encoded_sql({})} FROM base"))
def one_hot_encode(spark, d):
    return _rounded(E.encode(X.base(spark, d), ENCODE_CONTRACT, ["ROW_ID"]))


@query("impute_apply", with_sql(BASE_SQL, select="""
SELECT ROW_ID, coalesce(CAST(N_LINES AS DOUBLE), 4e0) AS N_LINES, coalesce(QTY, 0.5e0) AS QTY FROM base"""))
def impute_apply(spark, d):
    rows = X.base(spark, d).select("ROW_ID", F.col("N_LINES").cast("double"), "QTY")
    return E.impute(rows, {"N_LINES": 4.0, "QTY": 0.5})


@query("scoring_input", with_sql(BASE_SQL, FEED_SQL, select=f"""
SELECT ENTITY_ID, ROW_ID, RECORD_TS, NATION, {encoded_sql({'N_LINES': '4e0', 'QTY': '0e0', 'AVG_DISC': '0.05e0'})} FROM feed"""))
def scoring_input(spark, d):
    fills = {"N_LINES": 4.0, "QTY": 0.0, "AVG_DISC": 0.05}
    return _rounded(E.scoring_input(X.feed(spark, d), ENCODE_CONTRACT, X.DATA, fills))


@query("impute_fit", with_sql(BASE_SQL, FEED_SQL, select="""
SELECT 'QTY' AS NAME, round(avg(QTY), 6) AS FILL FROM history
UNION ALL SELECT 'N_LINES', round(median(N_LINES), 6) FROM history
UNION ALL SELECT 'AVG_DISC', round(median(AVG_DISC), 6) FROM history"""))
def impute_fit(spark, d):
    rows = E.encode(X.history(spark, d), E.Contract(tuple(E.Feature(c, c, E.NUM) for c in NUMERIC))).persist()
    fills = E.fit_imputation(rows, NUMERIC, X.DATA.median_impute)
    rows.unpersist()
    return spark.createDataFrame(sorted(fills.items()), "NAME string, FILL double").withColumn("FILL", F.round("FILL", 6))


@query("retrain_extra_impute", with_sql(BASE_SQL, select="""
SELECT 'N_LINES' AS NAME, round(avg(N_LINES), 6) AS FILL FROM base
UNION ALL SELECT 'AVG_DISC', round(avg(AVG_DISC), 6) FROM base"""))
def retrain_extra_impute(spark, d):
    rows = E.encode(X.base(spark, d), E.Contract(tuple(E.Feature(c, c, E.NUM) for c in NUMERIC)))
    known = {"QTY": 100.0}
    fills = E.fit_imputation(E.impute(rows, known), NUMERIC)
    return spark.createDataFrame(sorted(fills.items()), "NAME string, FILL double").withColumn("FILL", F.round("FILL", 6))


@query("null_feature_rows", with_sql(BASE_SQL, select="""
SELECT 'N_LINES' AS NAME, count(*) FILTER (WHERE N_LINES IS NULL) AS N_NULL FROM base
UNION ALL SELECT 'QTY', count(*) FILTER (WHERE QTY IS NULL) FROM base
UNION ALL SELECT 'AVG_DISC', count(*) FILTER (WHERE AVG_DISC IS NULL) FROM base"""))
def null_feature_rows(spark, d):
    return E.null_feature_rows(E.encode(X.base(spark, d), ENCODE_CONTRACT), ENCODE_CONTRACT)


@query("target_regression", with_sql(BASE_SQL, select="SELECT ROW_ID, CAST(CAST(Y_REG AS VARCHAR) AS DOUBLE) AS Y_REG FROM base"))
def target_regression(spark, d):
    rows = X.base(spark, d).select("ROW_ID", F.col("Y_REG").cast("string").alias("Y_REG"))
    return T.prepare_target(rows, "Y_REG", "regression")[0]


@query("target_classes", with_sql(BASE_SQL, select="""
SELECT ROW_ID, CASE Y WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 0 END AS Y
FROM (SELECT ROW_ID, CASE WHEN N_LINES IS NOT NULL THEN Y_MULTI END AS Y FROM base)"""))
def target_classes(spark, d):
    rows = X.base(spark, d).select("ROW_ID", F.when(F.col("N_LINES").isNotNull(), F.col("Y_MULTI")).alias("Y"))
    return T.prepare_target(rows, "Y", "multiclass")[0]


@query("target_digit_text", with_sql(BASE_SQL, select="""
SELECT ROW_ID, CAST(coalesce(CAST(COHORT AS INTEGER), 0) AS INTEGER) AS Y FROM (SELECT ROW_ID, CASE WHEN N_LINES > 2 THEN COHORT END AS COHORT FROM base)"""))
def target_digit_text(spark, d):
    rows = X.base(spark, d).select("ROW_ID", F.when(F.col("N_LINES") > 2, F.col("COHORT").cast("string")).alias("Y"))
    return T.prepare_target(rows, "Y", "binary")[0]


@query("label_cast", with_sql(BASE_SQL, select="""
SELECT ROW_ID, CAST(N_RETURNED AS BIGINT) AS L_BINARY, CAST(N_RETURNED AS VARCHAR) AS L_MULTICLASS,
       CAST(N_RETURNED AS DOUBLE) AS L_REGRESSION FROM base"""))
def label_cast(spark, d):
    return X.base(spark, d).select("ROW_ID", *[label_as(t, F.col("N_RETURNED")).alias(f"L_{t.upper()}")
                                               for t in ("binary", "multiclass", "regression")])


@query("production_cohort", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT ROW_ID, CAST(strftime(SCORED_AT, '%Y%m') AS INTEGER) AS COHORT FROM scored"""))
def production_cohort(spark, d):
    return X.scored(spark, d).select("ROW_ID", cohort_of(F.col("SCORED_AT")).alias("COHORT"))


@query("cohort_timestamp", with_sql(BASE_SQL, select="""
SELECT ROW_ID, CAST(try_strptime(CAST(C AS VARCHAR) || '01', '%Y%m%d') AS TIMESTAMP) AS AT
FROM (SELECT ROW_ID, CASE WHEN N_LINES = 3 THEN 200199 ELSE COHORT END AS C FROM base)"""))
def cohort_timestamp(spark, d):
    cohort = F.when(F.col("N_LINES") == 3, 200199).otherwise(F.col("COHORT"))
    return X.base(spark, d).select("ROW_ID", cohort_start(cohort).alias("AT"))


@query("threshold_flag", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT ROW_ID, CASE WHEN PREDICTED_PROBABILITY >= 0.45e0 THEN 1 ELSE 0 END AS PREDICTION FROM scored"""))
def threshold_flag(spark, d):
    return X.scored(spark, d).select("ROW_ID", at_least(F.col("PREDICTED_PROBABILITY"), 0.45).alias("PREDICTION"))


@query("risk_bands", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT ROW_ID, CASE WHEN PREDICTED_PROBABILITY >= 0.6e0 THEN 'HIGH' WHEN PREDICTED_PROBABILITY >= 0.4e0 THEN 'MEDIUM'
                    ELSE 'LOW' END AS RISK_BAND FROM scored"""))
def risk_bands(spark, d):
    return X.scored(spark, d).select("ROW_ID", risk_band(F.col("PREDICTED_PROBABILITY"), 0.6, 0.4).alias("RISK_BAND"))


CLASS_P = {"F": "round(1e0 - PREDICTED_PROBABILITY, 1)", "O": "round(PREDICTED_PROBABILITY, 1)", "P": "0.3e0"}
MULTI_SQL = f"""
, multi AS (
  SELECT *, greatest(P_F, P_O, P_P) AS CONFIDENCE,
         CASE WHEN P_F = greatest(P_F, P_O, P_P) THEN 'F' WHEN P_O = greatest(P_F, P_O, P_P) THEN 'O' ELSE 'P' END AS PICK
  FROM (SELECT *, {", ".join(f"{p} AS P_{c}" for c, p in CLASS_P.items())} FROM scored)
)"""


def multi(spark, d):
    """Scored rows with three class probabilities (many ties), the picked class and its confidence."""
    p = F.col("PREDICTED_PROBABILITY")
    rows = X.scored(spark, d).withColumns({"P_F": F.round(1.0 - p, 1), "P_O": F.round(p, 1), "P_P": F.lit(0.3)})
    confidence, label = best_class(F.array("P_F", "P_O", "P_P"), ["F", "O", "P"])
    return rows.withColumns({"CONFIDENCE": confidence, "PICK": label})


@query("multiclass_pick", with_sql(BASE_SQL, SCORED_SQL, MULTI_SQL, select="SELECT ROW_ID, CONFIDENCE, PICK FROM multi"))
def multiclass_pick(spark, d):
    return multi(spark, d).select("ROW_ID", "CONFIDENCE", "PICK")


@query("label_maturity", with_sql(BASE_SQL, select="SELECT ROW_ID, RECORD_TS + INTERVAL 90 DAY AS LABEL_MATURE_AT FROM base"))
def label_maturity(spark, d):
    return X.base(spark, d).select("ROW_ID", matures_at(F.col("RECORD_TS"), 90).alias("LABEL_MATURE_AT"))


@query("tagged_renamed_columns", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT ENTITY_ID AS CUSTOMER_NO, PREDICTED_PROBABILITY AS CHAMPION_SCORE, 'HISTORY' AS ROW_SOURCE, MODEL_VERSION AS VERSION FROM scored"""))
def tagged_renamed_columns(spark, d):
    rows = X.scored(spark, d).select("ENTITY_ID", "PREDICTED_PROBABILITY", "MODEL_VERSION").withColumn("ROW_SOURCE", F.lit("HISTORY"))
    return rows.withColumnsRenamed({"ENTITY_ID": "CUSTOMER_NO", "PREDICTED_PROBABILITY": "CHAMPION_SCORE", "MODEL_VERSION": "VERSION"})


@query("stable_buckets", """
SELECT CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 20 AS BUCKET, count(*) AS N
FROM orders GROUP BY 1""")
def stable_buckets(spark, d):
    return (X.read(spark, d, "orders").groupBy(stable_bucket(F.col("o_orderkey"), 20).alias("BUCKET"))
            .agg(F.count("*").alias("N")))


@query("row_digest", "SELECT o_orderkey AS ROW_ID, md5('1:7' || length(CAST(o_orderkey AS VARCHAR)) || ':' || o_orderkey || length(CAST(o_custkey AS VARCHAR)) || ':' || o_custkey) AS DIGEST FROM orders")
def row_digest(spark, d):
    return X.read(spark, d, "orders").select(
        F.col("o_orderkey").alias("ROW_ID"), digest(F.col("o_orderkey"), F.col("o_custkey"), seed=7).alias("DIGEST"))


@query("json_field_number", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS K,
       CAST(NULL AS DOUBLE) AS ABSENT, CAST(NULL AS DOUBLE) AS BROKEN FROM events""")
def json_field_number(spark, d):
    return X.read(spark, d, "events").select(
        "event_id", json_number(F.col("props"), "k").alias("K"), json_number(F.col("props"), "absent").alias("ABSENT"),
        json_number(F.concat(F.lit("{{"), "props"), "k").alias("BROKEN"))


@query("row_predicates", with_sql(BASE_SQL, SCORED_SQL, select=f"""
SELECT ROW_ID, N_RETURNED IS NULL AS NO_LINES, LABEL_MATURE_AT <= TIMESTAMP '{NOW}' AS MATURE,
       RECORD_TS > TIMESTAMP '1999-01-01' AND RECORD_TS <= TIMESTAMP '2000-01-01' AS IN_RANGE
FROM scored WHERE MODEL_VERSION = 'LR_R1'
  AND ENTITY_ID IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""))
def row_predicates(spark, d):
    wanted = X.read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("ENTITY_ID"))
    rows = X.scored(spark, d).where("MODEL_VERSION = 'LR_R1'").join(wanted, "ENTITY_ID", "left_semi")
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    ts = F.col("RECORD_TS")
    return rows.select("ROW_ID", F.col("N_RETURNED").isNull().alias("NO_LINES"), (F.col("LABEL_MATURE_AT") <= at(NOW)).alias("MATURE"),
                       ((ts > at("1999-01-01")) & (ts <= at("2000-01-01"))).alias("IN_RANGE"))


@query("report_expressions", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT ROW_ID, round(sqrt(PREDICTED_PROBABILITY), 4) AS P4, coalesce(N_RETURNED, 0) AS RETURNED,
       CASE WHEN PREDICTED_PROBABILITY < 0.2 THEN 1 ELSE 0 END AS LOW_FLAG, MODEL_VERSION || '/' || RISK_BAND AS TAG FROM scored"""))
def report_expressions(spark, d):
    p = F.col("PREDICTED_PROBABILITY")
    return X.scored(spark, d).select(
        "ROW_ID", F.round(F.sqrt(p), 4).alias("P4"), F.coalesce("N_RETURNED", F.lit(0)).alias("RETURNED"),
        F.when(p < 0.2, 1).otherwise(0).alias("LOW_FLAG"), F.concat("MODEL_VERSION", F.lit("/"), "RISK_BAND").alias("TAG"))


@query("feature_unpivot", with_sql(BASE_SQL, select="""
SELECT * FROM (
  SELECT ROW_ID, 'QTY' AS NAME, QTY AS VALUE FROM base
  UNION ALL SELECT ROW_ID, 'N_LINES', CAST(N_LINES AS DOUBLE) FROM base
  UNION ALL SELECT ROW_ID, 'ACCT_BAL', ACCT_BAL FROM base) WHERE VALUE IS NOT NULL"""))
def feature_unpivot(spark, d):
    rows = X.base(spark, d).select("ROW_ID", "QTY", F.col("N_LINES").cast("double"), "ACCT_BAL")
    return E.feature_rows(rows, ["ROW_ID"], ["QTY", "N_LINES", "ACCT_BAL"])


@query("incremental_feed", with_sql(EVENT_FEED_SQL, select="""
SELECT ROW_ID, ENTITY_ID, RECORD_TS, EVENT_TYPE, VALUE FROM event_feed
WHERE RECORD_TS > TIMESTAMP '2024-01-10 06:00:00' AND RECORD_TS <= TIMESTAMP '2024-01-20 00:00:00'"""))
def incremental_feed(spark, d):
    rows = incremental_rows(X.event_feed(spark, d), "RECORD_TS", "2024-01-10 06:00:00", F.lit("2024-01-20 15:30:00").cast("timestamp_ntz"))
    return rows.select("ROW_ID", "ENTITY_ID", "RECORD_TS", "EVENT_TYPE", "VALUE")


@query("first_incremental_feed", with_sql(EVENT_FEED_SQL, select="""
SELECT count(*) AS N_ROWS, max(RECORD_TS) AS NEW_WATERMARK FROM event_feed WHERE RECORD_TS <= TIMESTAMP '2024-01-20 00:00:00'"""))
def first_incremental_feed(spark, d):
    rows = incremental_rows(X.event_feed(spark, d), "RECORD_TS", None, F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return batch_bounds(rows, "RECORD_TS")


@query("watermark_advance", with_sql(BASE_SQL, FEED_SQL, select=f"""
SELECT count(*) AS N_ROWS, max(RECORD_TS) AS NEW_WATERMARK FROM feed
WHERE RECORD_TS > TIMESTAMP '2000-06-30 00:00:00' AND RECORD_TS <= TIMESTAMP '2001-06-15 00:00:00'"""))
def watermark_advance(spark, d):
    now = F.lit(NOW).cast("timestamp_ntz")
    return batch_bounds(incremental_rows(X.feed(spark, d), "RECORD_TS", "2000-06-30 00:00:00", now), "RECORD_TS")


@query("late_feed_rows", with_sql(EVENT_FEED_SQL, select="""
SELECT ROW_ID, RECORD_TS FROM event_feed WHERE RECORD_TS <= TIMESTAMP '2024-01-15 00:00:00' AND EVENT_TYPE = 'click'"""))
def late_feed_rows(spark, d):
    events = X.event_feed(spark, d)
    scored = events.where("EVENT_TYPE <> 'click'")
    return late_rows(events, scored, "RECORD_TS", "2024-01-15 00:00:00", ["ROW_ID"]).select("ROW_ID", "RECORD_TS")


@query("day_ordinal", "SELECT o_orderkey AS ROW_ID, CAST(epoch_us(o_orderdate) AS DOUBLE) AS MICROS, date_trunc('day', o_orderdate) AS DAY FROM orders")
def day_ordinal(spark, d):
    orders = X.read(spark, d, "orders")
    return orders.select(F.col("o_orderkey").alias("ROW_ID"), as_ordinal(orders, "o_orderdate").alias("MICROS"),
                         midnight(F.col("o_orderdate")).alias("DAY"))
