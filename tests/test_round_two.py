"""Cases at the edges: NaN in ranks, wide contracts, many classes, row ids, long whole numbers, labels of a new class."""

import math

import pytest
from pyspark.sql import functions as F

from lodemark.functions.columns import digest
from lodemark.operators import encode as E
from lodemark.operators import ranking as R
from lodemark.operators import targets as T
from lodemark.operators.boosting import best_round
from lodemark.operators.monitoring import Reference, drift_windows
from lodemark.settings import DataSpec
from lodemark.sources import scans


def test_contract_refuses_instead_of_dropping(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    wide = DataSpec(keys=("k",), timestamp="t", target="y", categorical=("c",), numeric=tuple(f"n{k}" for k in range(9_999)))
    with pytest.raises(ValueError, match="10000 encoded columns"):
        E.fit_contract(df, wide)
    contract = E.Contract(tuple(E.Feature(f"n{k}", f"n{k}", E.NUM) for k in range(10_045)))
    frame = contract.to_frame(spark, "u", "v", F.lit("2000-01-01"))
    assert E.Contract.from_frame(frame) == contract


def test_too_many_classes_are_refused(spark):
    df = spark.range(1500).select(F.col("id").cast("double").alias("y"))
    with pytest.raises(ValueError, match="more than 1000 classes"):
        T.balanced_weights(df, "y")


def test_nan_is_null_at_every_size(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 100 == 0, F.lit(float("nan"))).otherwise(F.col("id").cast("double")).alias("s"))
    small = R.cutoffs(df, "s", {"high": 10})
    found = R.order_statistics(df, [("s", lambda n: n)], exact_rows=50, grid=20)[0]
    assert small == {"high": 1990.0} and found.value == 1999.0 and found.rows == 1980
    for rows in (100, 10_000):
        totals = R.running_totals(df, "s", {"N": F.count("*")}, rows_per_slice=rows)
        assert totals.count() == 1980 and totals.agg(F.max("RUN_N")).first()[0] == 1980
    assert not any(math.isnan(r[0]) for r in R.leading_rows(df, [("s", "desc")], lambda n: 30).collect())


def test_long_keys_do_not_fall_together(spark):
    keys = [2**53 + k for k in range(6)] + [-(2**60), -(2**60) - 1]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    assert [r[0] for r in R.leading_rows(df, [("id", "desc")], lambda n: 1).collect()] == [max(keys)]
    assert {r[0] for r in R.leading_rows(df, [("id", "asc")], lambda n: 3).collect()} == set(sorted(keys)[:3])


def test_row_ids_tell_rows_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("x", None), ("", "x"), ("~", "x"), ("1:a", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(digest(F.col("a"), F.col("b"))).distinct().count() == len(rows)


def test_seeded_orders_tell_rows_apart(spark):
    """Keys that read alike when joined by a bar stay apart, so the leading rows are exactly as many as asked for."""
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("x", None), ("", "x"), ("x", ""), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    for n in range(1, len(rows)):
        assert R.leading_rows(df, R.seeded(["a", "b"], 7), lambda _, n=n: n).count() == n
    one = spark.createDataFrame([("",), (None,), ("|",), ("7",)], "a string")
    assert [R.leading_rows(one, R.seeded(["a"], 7), lambda _, n=n: n).count() for n in (1, 2, 3)] == [1, 2, 3]


def test_class_codes_stay_and_labels_are_stored(spark):
    first, labels = T.prepare_target(spark.createDataFrame([("C",), ("A",)], "y string"), "y", "multiclass")
    later, more = T.prepare_target(spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "y string"), "y", "multiclass", known=labels)
    assert labels == ["A", "C"] and more == ["A", "C", "B"]
    assert sorted(r[0] for r in later.collect()) == [0, 0, 1, 2]
    assert [r[0] for r in later.orderBy("y").select(T.label_text(F.col("y"), more)).collect()] == ["A", "A", "C", "B"]
    monitor = spark.createDataFrame([("A", "A", 0.9), ("B", "C", 0.4)], "PREDICTION string, ACTUAL_LABEL string, PREDICTED_PROBABILITY double")
    monitor = monitor.withColumns({"SCORED_AT": F.lit("2000-01-01").cast("timestamp_ntz"), "MODEL_VERSION": F.lit("V")})
    assert drift_windows(monitor, Reference((0.5,), (0.5, 0.5)), "multiclass").first()["ACCURACY"] == 0.5


def test_patience_ends_a_search():
    assert best_round([5, 4, 3, 3.5, 3.6, 1], 2) == (3, True)
    assert best_round([5, 4, 3, 3.5, 3.6, 1], 3) == (6, False)
    assert best_round([1.0], 5) == (1, False)


def test_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), spark.conf

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scans.shared_folder(Session())


def test_scratch_tables_can_be_dropped(spark):
    scratch = scans.Scratch(spark)
    table = scratch.write(spark.range(5))
    assert table.count() == 5
    scratch.drop(table)
    with pytest.raises(Exception):
        spark.read.parquet(table._scratch_path).count()
