"""What the physical plans must look like, and the registered queries as a whole."""

from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from lodemark.operators import ranking as R
from lodemark.sources import fixtures as X
from lodemark.sources.scans import incremental_rows, load_source


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_incremental_scan_reaches_the_reader(spark, data):
    events = X.read(spark, data, "events").select("event_id", "ts")
    text = plan(incremental_rows(events, "ts", "2024-01-10 00:00:00", F.lit("2024-01-20 09:00:00").cast("timestamp_ntz")))
    assert "GreaterThan(ts" in text and "LessThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text and "Exchange" not in text


def test_projection_reaches_the_reader(spark, data):
    text = plan(load_source(spark, f"{data}/orders.parquet", ["O_ORDERKEY", "O_TOTALPRICE"]))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_top_rows_are_a_filter_without_shuffle(spark, data):
    orders = X.read(spark, data, "orders")
    text = plan(R.top_decile(orders, "o_totalprice", ["o_orderkey"]))
    assert "Exchange" not in text and "Window" not in text and "Filter" in text


def test_encoding_is_one_codegen_stage_without_python(spark, data):
    from lodemark.catalog.encoding import ENCODE_CONTRACT
    from lodemark.operators.encode import encode
    text = plan(encode(X.read(spark, data, "orders").withColumnRenamed("o_orderpriority", "PRIORITY"), ENCODE_CONTRACT, ["o_orderkey"]))
    assert "Python" not in text and "Exchange" not in text
    assert "*(1) Project" in text and "*(2)" not in text
    assert text.count("regexp_replace") == 1  # a category is normalised once per row, not once per encoded column


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_flagship_runs(spark):
    report = entry(spark)
    assert report.columns == ["DT", "RISK_BAND", "N", "AVG_PROB", "N_FLAGGED"]
    assert report.agg(F.sum("N")).first()[0] == X.feed(spark, "/root/testdata/sf0.001").select("ENTITY_ID").distinct().count()
