"""Windows, global order, top rows, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodemark.catalog import query
from lodemark.functions.columns import at_least, linear_margin, logistic, risk_band
from lodemark.operators import ranking as R
from lodemark.operators import splits as S
from lodemark.operators.encode import encode
from lodemark.operators.joins import asof_lookup, latest_per_key
from lodemark.operators.monitoring import training_summary
from lodemark.operators.outcomes import OutcomeRule, synthetic_outcomes
from lodemark.settings import SplitSpec
from lodemark.sources import fixtures as X
from lodemark.sources.fixtures import BASE_SQL, EVENT_FEED_SQL, FEED_SQL, SCORED_SQL, with_sql
from lodemark.sources.scans import staged

LATEST_SQL = """
, latest AS (
  SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY ENTITY_ID ORDER BY RECORD_TS DESC, ROW_ID DESC) = 1
)"""


@query("latest_per_key", with_sql(BASE_SQL, FEED_SQL, LATEST_SQL, select="SELECT ENTITY_ID, ROW_ID, RECORD_TS, TOTAL_PRICE FROM latest"))
def latest_rows(spark, d):
    return X.latest_feed(spark, d).select("ENTITY_ID", "ROW_ID", "RECORD_TS", "TOTAL_PRICE")


@query("latest_event_per_type", with_sql(EVENT_FEED_SQL, select="""
SELECT EVENT_TYPE, ROW_ID, RECORD_TS FROM event_feed
QUALIFY row_number() OVER (PARTITION BY EVENT_TYPE ORDER BY RECORD_TS DESC, ROW_ID DESC) = 1"""))
def latest_event_per_type(spark, d):
    rows = latest_per_key(X.event_feed(spark, d), ["EVENT_TYPE"], "RECORD_TS", ["ROW_ID"])
    return rows.select("EVENT_TYPE", "ROW_ID", "RECORD_TS")


def _cuts_sql(sizes: dict[str, int]) -> str:
    return "SELECT " + ", ".join(
        f"(SELECT min(PREDICTED_PROBABILITY) FROM (SELECT PREDICTED_PROBABILITY FROM scored ORDER BY 1 DESC LIMIT {n})) AS {name}"
        for name, n in sizes.items())


@query("daily_band_report", with_sql(BASE_SQL, FEED_SQL, LATEST_SQL, """
, raw AS (
  SELECT ROW_ID, RECORD_TS, round(1e0 / (1e0 + exp(-(-3e0 + TOTAL_PRICE * 8e-6
           + CASE WHEN PRIORITY = '1-URGENT' THEN 1e0 ELSE 0e0 END * 8e-1 + ACCT_BAL * (-1e-4)
           + CAST(coalesce(N_LINES, 0) AS DOUBLE) * 1e-1))), 6) AS P FROM latest
), cuts AS (
  SELECT (SELECT min(P) FROM (SELECT P FROM raw ORDER BY P DESC LIMIT 500)) AS HI,
         (SELECT min(P) FROM (SELECT P FROM raw ORDER BY P DESC LIMIT 2500)) AS MD
)""", select="""
SELECT CAST(RECORD_TS AS DATE) AS DT, CASE WHEN P >= HI THEN 'HIGH' WHEN P >= MD THEN 'MEDIUM' ELSE 'LOW' END AS RISK_BAND,
       count(*) AS N, round(avg(P), 12) AS AVG_PROB, CAST(sum(CASE WHEN P >= HI THEN 1 ELSE 0 END) AS BIGINT) AS N_FLAGGED
FROM raw, cuts GROUP BY 1, 2"""))
def daily_band_report(spark, d):
    """The scoring path end to end: latest row per entity, encode, score, exact cutoffs, bands, daily counts."""
    intercept, weights = X.MODELS["LR_R1"]
    encoded = encode(X.latest_feed(spark, d), X.CONTRACT, ["ROW_ID", "RECORD_TS"], X.IMPUTE)
    scored = staged(encoded.select("ROW_ID", "RECORD_TS", F.round(logistic(linear_margin(weights, intercept)), 6).alias("P")))
    cuts = R.cutoffs(scored, "P", {"high": X.USE_CASE.scoring.n_high, "medium": X.USE_CASE.scoring.n_medium})
    p = F.col("P")
    return (scored.groupBy(F.to_date("RECORD_TS").alias("DT"), risk_band(p, cuts["high"], cuts["medium"]).alias("RISK_BAND"))
            .agg(F.count("*").alias("N"), F.round(F.avg(p), 12).alias("AVG_PROB"),
                 F.sum(at_least(p, cuts["high"])).alias("N_FLAGGED")))


@query("percent_rank_values", with_sql(EVENT_FEED_SQL, select="""
SELECT ROW_ID, round(percent_rank() OVER (ORDER BY coalesce(K, 0)), 6) AS R_K,
       round(percent_rank() OVER (ORDER BY coalesce(VALUE, 0)), 6) AS R_VALUE FROM event_feed"""))
def percent_rank_values(spark, d):
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    rows = X.event_feed(spark, d).select("ROW_ID", zero("K"), zero("VALUE"))
    ranked = R.percent_ranks(rows, {"R_K": "K", "R_VALUE": "VALUE"})
    return ranked.select("ROW_ID", F.round("R_K", 6).alias("R_K"), F.round("R_VALUE", 6).alias("R_VALUE"))


@query("percent_rank_descending", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT ROW_ID, round(percent_rank() OVER (ORDER BY round(PREDICTED_PROBABILITY, 2) DESC), 6) AS R_SCORE FROM scored"""))
def percent_rank_descending(spark, d):
    rows = X.scored(spark, d).select("ROW_ID", F.round("PREDICTED_PROBABILITY", 2).alias("S"))
    return R.percent_ranks(rows, {"R": "S"}, descending=True).select("ROW_ID", F.round("R", 6).alias("R_SCORE"))


RULE = OutcomeRule(
    ranked={"K": 1.00, "VALUE": 0.70, "NATION_KEY": 0.40, "EVENT_HOUR": -0.30},
    flags={"EVENT_TYPE = 'purchase'": 0.90, "ACCT_BAL < 0": 0.35})


@query("synthetic_outcomes", with_sql(EVENT_FEED_SQL, """
, latest AS (
  SELECT e.*, c_acctbal AS ACCT_BAL, c_nationkey AS NATION_KEY, hour(RECORD_TS) AS EVENT_HOUR
  FROM event_feed e JOIN customer ON ENTITY_ID = c_custkey
  QUALIFY row_number() OVER (PARTITION BY ENTITY_ID ORDER BY RECORD_TS DESC, ROW_ID DESC) = 1
), ranked AS (
  SELECT ENTITY_ID, percent_rank() OVER (ORDER BY coalesce(K, 0)) AS R_K, percent_rank() OVER (ORDER BY coalesce(VALUE, 0)) AS R_VALUE,
         percent_rank() OVER (ORDER BY coalesce(NATION_KEY, 0)) AS R_NATION, percent_rank() OVER (ORDER BY coalesce(EVENT_HOUR, 0)) AS R_HOUR,
         CASE WHEN EVENT_TYPE = 'purchase' THEN 1 ELSE 0 END AS F_0, CASE WHEN ACCT_BAL < 0 THEN 1 ELSE 0 END AS F_1
  FROM latest
), scored AS (
  SELECT ENTITY_ID, 0e0 + 1e0 * R_K + 0.7e0 * R_VALUE + 0.4e0 * R_NATION + (-0.3e0) * R_HOUR + 0.9e0 * F_0 + 0.35e0 * F_1
         + 1.2e0 * ((CAST(('0x' || substr(md5(CAST(ENTITY_ID AS VARCHAR)), 1, 8)) AS BIGINT) % 100000) / 100000e0) AS S
  FROM ranked
)""", select="""
SELECT ENTITY_ID, CASE WHEN percent_rank() OVER (ORDER BY S DESC) < 0.0018 THEN 1 ELSE 0 END AS OUTCOME,
       round(S, 4) AS SYNTHETIC_SCORE FROM scored"""))
def simulated(spark, d):
    rows = X.outcome_inputs(spark, d).withColumn("EVENT_HOUR", F.hour("RECORD_TS"))
    return synthetic_outcomes(rows, "ENTITY_ID", "RECORD_TS", ["ROW_ID"], RULE)


@query("cumulative_cohort_share", with_sql(BASE_SQL, select="""
SELECT COHORT, count(*) AS N, round(sum(count(*)) OVER (ORDER BY COHORT) / sum(count(*)) OVER (), 6) AS CUM_SHARE
FROM base GROUP BY COHORT"""))
def cumulative_cohort_share(spark, d):
    shares = S.cohort_shares(X.base(spark, d), "COHORT")
    return shares.select("COHORT", "N", F.round("CUM_SHARE", 6).alias("CUM_SHARE"))


@query("newest_fraction", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT ROW_ID, SCORED_AT FROM scored
QUALIFY row_number() OVER (ORDER BY SCORED_AT DESC, md5('11|' || ROW_ID))
        <= (SELECT CAST(round_even(count(*) * 0.3e0, 0) AS BIGINT) FROM scored)"""))
def newest_fraction(spark, d):
    rows = staged(X.scored(spark, d).select("ROW_ID", "SCORED_AT"))
    return R.newest_fraction(rows, "SCORED_AT", 0.3, ["ROW_ID"], 11)


SIZES = {"CUT_HIGH": 500, "CUT_MEDIUM": 2500}


@query("risk_cutoffs", with_sql(BASE_SQL, SCORED_SQL, select=_cuts_sql(SIZES)))
def risk_cutoffs(spark, d):
    found = R.cutoffs(X.scored(spark, d), "PREDICTED_PROBABILITY", SIZES)
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{n} double" for n in found))


@query("capacity_threshold", with_sql(BASE_SQL, SCORED_SQL, select=_cuts_sql({"CAPACITY_THRESHOLD": 750, "ALL_ROWS": 100_000_000})))
def capacity_threshold(spark, d):
    found = R.cutoffs(X.scored(spark, d), "PREDICTED_PROBABILITY", {"CAPACITY_THRESHOLD": 750, "ALL_ROWS": 100_000_000})
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{n} double" for n in found))


@query("top_decile_rows", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT ROW_ID, round(PREDICTED_PROBABILITY, 2) AS SCORE FROM scored
QUALIFY row_number() OVER (ORDER BY round(PREDICTED_PROBABILITY, 2) DESC, md5('0|' || ROW_ID))
        <= (SELECT greatest(count(*) // 10, 1) FROM scored)"""))
def top_decile_rows(spark, d):
    rows = staged(X.scored(spark, d).select("ROW_ID", F.round("PREDICTED_PROBABILITY", 2).alias("SCORE")))
    return R.top_decile(rows, "SCORE", ["ROW_ID"])


@query("top_business_rows", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT ENTITY_ID, ROW_ID, PREDICTED_PROBABILITY FROM scored ORDER BY PREDICTED_PROBABILITY DESC, ROW_ID LIMIT 5"""))
def top_business_rows(spark, d):
    return X.scored(spark, d).select("ENTITY_ID", "ROW_ID", "PREDICTED_PROBABILITY").orderBy(
        F.desc("PREDICTED_PROBABILITY"), "ROW_ID").limit(5)


TEMPORAL_SQL = """
, shares AS (
  SELECT COHORT, CAST(sum(count(*)) OVER (ORDER BY COHORT) AS DOUBLE) / sum(count(*)) OVER () AS CUM FROM base GROUP BY COHORT
), cut AS (SELECT min(COHORT) AS C FROM shares WHERE CUM >= 1 - 0.2e0)"""


@query("temporal_split", with_sql(BASE_SQL, TEMPORAL_SQL, select="""
SELECT CASE WHEN COHORT < C THEN 'train' ELSE 'test' END AS SIDE, min(COHORT) AS FIRST_COHORT, max(COHORT) AS LAST_COHORT,
       count(*) AS N FROM base, cut GROUP BY 1"""))
def temporal_split(spark, d):
    split = S.split_data(X.base(spark, d), "COHORT", ["ENTITY_ID"], SplitSpec())
    sides = [s.select(F.lit(n).alias("SIDE"), "COHORT") for n, s in (("train", split.train), ("test", split.test))]
    return sides[0].unionByName(sides[1]).groupBy("SIDE").agg(
        F.min("COHORT").alias("FIRST_COHORT"), F.max("COHORT").alias("LAST_COHORT"), F.count("*").alias("N"))


ID_TEST_SQL = """
, test_ids AS (
  SELECT ENTITY_ID FROM (SELECT DISTINCT ENTITY_ID FROM base)
  QUALIFY row_number() OVER (ORDER BY md5('42|' || ENTITY_ID))
          <= (SELECT greatest(CAST(floor(count(DISTINCT ENTITY_ID) * 0.2e0) AS BIGINT), 1) FROM base)
)"""


@query("sampled_ids", with_sql(BASE_SQL, ID_TEST_SQL, select="SELECT ENTITY_ID FROM test_ids"))
def sampled_ids(spark, d):
    return S.sampled_ids(X.base(spark, d), "ENTITY_ID", 0.2, 42)


@query("random_id_split", with_sql(BASE_SQL, ID_TEST_SQL, select="""
SELECT ROW_ID, CASE WHEN ENTITY_ID IN (SELECT ENTITY_ID FROM test_ids) THEN 'test' ELSE 'train' END AS SIDE FROM base"""))
def random_id_split(spark, d):
    split = S.split_data(X.base(spark, d), "COHORT", ["ROW_ID", "ENTITY_ID"], SplitSpec(strategy="random"))
    return split.train.select("ROW_ID", F.lit("train").alias("SIDE")).unionByName(
        split.test.select("ROW_ID", F.lit("test").alias("SIDE")))


@query("hpo_cohort_split", with_sql(BASE_SQL, FEED_SQL, """
, cohorts AS (SELECT DISTINCT COHORT FROM history)
, cut AS (
  SELECT COHORT AS C FROM cohorts
  QUALIFY row_number() OVER (ORDER BY COHORT) = (SELECT greatest(CAST(floor(count(*) * (1 - 0.2e0)) AS BIGINT), 1) + 1 FROM cohorts)
)""", select="SELECT COHORT < C AS FITS, count(*) AS N, max(COHORT) AS LAST_COHORT FROM history, cut GROUP BY 1"))
def hpo_cohort_split(spark, d):
    rows = X.history(spark, d)
    fits = S.search_fit_rows(rows, "COHORT", 0.2, ["ROW_ID"])
    return rows.groupBy(fits.alias("FITS")).agg(F.count("*").alias("N"), F.max("COHORT").alias("LAST_COHORT"))


@query("hpo_row_split", with_sql(BASE_SQL, FEED_SQL, select="""
SELECT ROW_ID, row_number() OVER (ORDER BY md5('0|' || ROW_ID)) <= (SELECT CAST(floor(count(*) * (1 - 0.2e0)) AS BIGINT) FROM history) AS FITS
FROM history"""))
def hpo_row_split(spark, d):
    """All rows share one value of the timestamp column, so the split is by rows."""
    rows = X.history(spark, d).withColumn("ONE", F.lit(1))
    return rows.select("ROW_ID", S.search_fit_rows(rows, "ONE", 0.2, ["ROW_ID"]).alias("FITS"))


@query("anti_join_train_rows", with_sql(BASE_SQL, SCORED_SQL, select="""
SELECT ROW_ID FROM base WHERE ROW_ID NOT IN (SELECT ROW_ID FROM scored WHERE RISK_BAND = 'HIGH')"""))
def anti_join_train_rows(spark, d):
    held = X.scored(spark, d).where("RISK_BAND = 'HIGH'")
    return S.without(X.base(spark, d).select("ROW_ID"), held, ["ROW_ID"])


@query("feature_asof_lookup", with_sql(BASE_SQL, FEED_SQL, select="""
SELECT s.ROW_ID, s.RECORD_TS, f.FEATURE_ROW, f.PAST_PRICE
FROM feed s LEFT JOIN (SELECT ENTITY_ID, RECORD_TS, max(ROW_ID) AS FEATURE_ROW, max_by(TOTAL_PRICE, ROW_ID) AS PAST_PRICE
                       FROM base GROUP BY ENTITY_ID, RECORD_TS) f
  ON s.ENTITY_ID = f.ENTITY_ID AND f.RECORD_TS <= s.RECORD_TS - INTERVAL 30 DAY
QUALIFY row_number() OVER (PARTITION BY s.ROW_ID ORDER BY f.RECORD_TS DESC NULLS LAST) = 1"""))
def feature_asof_lookup(spark, d):
    features = X.base(spark, d).select("ENTITY_ID", F.col("RECORD_TS").alias("FEATURE_TS"), F.col("ROW_ID").alias("FEATURE_ROW"),
                                       F.col("TOTAL_PRICE").alias("PAST_PRICE"))
    spine = X.feed(spark, d).select("ENTITY_ID", "ROW_ID", "RECORD_TS",
                                    (F.col("RECORD_TS") - F.expr("INTERVAL '30' DAY")).alias("AS_OF"))
    found = asof_lookup(spine, features, ["ENTITY_ID"], "AS_OF", "FEATURE_TS", ["FEATURE_ROW"])
    return found.select("ROW_ID", "RECORD_TS", "FEATURE_ROW", "PAST_PRICE")


@query("daily_training_summary", with_sql(BASE_SQL, FEED_SQL, SCORED_SQL, X.BASELINE_SQL, select="""
SELECT CAST(SCORED_AT AS DATE) AS DT, count(*) AS N, CAST(sum(CASE WHEN RISK_BAND = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS N_HIGH
FROM baseline GROUP BY 1"""))
def daily_training_summary(spark, d):
    return training_summary(X.baseline(spark, d), "binary")


@query("daily_training_summary_regression", with_sql(BASE_SQL, FEED_SQL, SCORED_SQL, X.BASELINE_SQL, select="""
SELECT CAST(SCORED_AT AS DATE) AS DT, count(*) AS N, round(avg(Y_REG), 4) AS AVG_PREDICTED_VALUE FROM baseline GROUP BY 1"""))
def daily_training_summary_regression(spark, d):
    report = training_summary(X.baseline(spark, d).withColumn("PREDICTION", F.col("Y_REG")), "regression")
    return report.withColumn("AVG_PREDICTED_VALUE", F.round("AVG_PREDICTED_VALUE", 4))
