import pytest
from pyspark.sql import functions as F

from lodemark.functions import columns as C
from lodemark.operators import encode as E
from lodemark.operators import targets as T
from lodemark.settings import DataSpec, ModelSpec, UseCase

DATA = DataSpec(keys=("K",), timestamp="T", target="Y", categorical=("C",), numeric=("N", "M"), median_impute=("M",))


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize("text, expected", [
    ("  a b-c ", "A_B_C"), ("__x__", "X"), ("", "MISSING"), ("  ", "MISSING"), (None, "MISSING"), ("--", "MISSING"),
    ("\tTab\n", "TAB"), ("café", "CAF"), ("1-URGENT", "1_URGENT")])
def test_normalize_category(spark, text, expected):
    assert one(spark, C.normalize_category(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("text, expected", [
    ("1.5", 1.5), (" 7 ", 7.0), ("1e3", 1000.0), ("x", None), ("", None), ("1d", None), ("2.0f", None), ("nan", None), (None, None)])
def test_coerce_number(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(C.numeric_column(df, "v").alias("v")).first()["v"] == expected


def test_contract_encodes_unseen_and_absent_as_zero(spark):
    rows = spark.createDataFrame([("a", 1.0, 2.0), (None, None, 3.0), ("b!", float("nan"), None)], "C string, N double, M double")
    contract = E.fit_contract(rows, DATA)
    assert contract.encoded == ["N", "M", "C_A", "C_B", "C_MISSING"]
    new = spark.createDataFrame([("zzz", "4", "bad")], "C string, N string, M string")
    assert E.encode(new, contract).first().asDict() == {"N": 4.0, "M": None, "C_A": 0.0, "C_B": 0.0, "C_MISSING": 0.0}
    assert E.encode(new.drop("C"), contract).first()["C_MISSING"] == 0.0


def test_impute_fit_only_where_there_are_gaps(spark):
    rows = spark.createDataFrame([(1.0, 1.0, None, 5.0), (2.0, None, None, 5.0), (None, 4.0, None, 5.0), (6.0, 9.0, None, 5.0), (9.0, 2.0, None, 5.0)],
                                 "N double, M double, Z double, F double")
    assert E.fit_imputation(rows, ["N", "M", "Z", "F"], ["M", "Z"]) == {"N": 4.5, "M": 3.0, "Z": 0.0}


def test_duplicate_and_missing_columns_are_refused(spark):
    feed = spark.createDataFrame([(1, 2, "a", 1.0, 1.0)], "K int, RECORD_TS int, C string, N double, M double")
    contract = E.fit_contract(feed, DATA)
    with pytest.raises(ValueError, match=r"duplicate column\(s\) \['N'\]"):
        E.scoring_input(feed, contract, DataSpec(keys=("K",), timestamp="T", target="Y", categorical=("C",), numeric=("N", "M"), passthrough=("N",)), {})
    with pytest.raises(ValueError, match=r"\['C', 'M'\]"):
        E.scoring_input(feed.drop("C", "M"), contract, DATA, {})


def test_longest_source_name_wins(spark):
    names = spark.createDataFrame([("A_B_X",), ("A_X",), ("A",), ("AX",)], "e string")
    got = [r[0] for r in names.select(E.source_name(F.col("e"), ["A", "A_B"])).collect()]
    assert got == ["A_B", "A", "A", "AX"]


def test_targets(spark):
    words = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "y string")
    coded, labels = T.prepare_target(words, "y", "multiclass")
    assert [r["y"] for r in coded.collect()] == [1, 0, 0, 2] and labels == ["a", "b", "c"]
    assert T.prepare_target(words, "y", "multiclass", drop_null=True)[0].count() == 3
    digits, none = T.prepare_target(spark.createDataFrame([("3",), (None,)], "y string"), "y", "binary")
    assert [r["y"] for r in digits.collect()] == [3, 0] and none is None
    with pytest.raises(ValueError, match="regression target"):
        T.prepare_target(words, "y", "regression")


def test_causes_and_picks(spark):
    parts = {"a": F.lit(0.5), "b": F.lit(0.5), "c": F.lit(-1.0), "d": F.lit(2.0)}
    assert one(spark, C.ranked_causes(parts, 2)) == "d | a"
    assert one(spark, C.ranked_causes({"c": F.lit(-1.0), "z": F.lit(0.0)}, 2)) is None
    confidence, label = C.best_class(F.array(F.lit(0.4), F.lit(0.4), F.lit(0.2)), ["x", "y", "z"])
    assert (one(spark, confidence), one(spark, label)) == (0.4, "x")
    assert [one(spark, C.risk_band(F.lit(s), 0.7, 0.5)) for s in (0.7, 0.5, 0.49)] == ["HIGH", "MEDIUM", "LOW"]
    assert one(spark, C.json_number(F.lit('{"k": "12"}'), "k")) == 12.0 and one(spark, C.json_number(F.lit('{"k": "x"}'), "k")) is None


def test_settings_refuse_nonsense():
    with pytest.raises(ValueError, match="metric"):
        UseCase("u", DATA, task="regression", model=ModelSpec(metric="pr_auc"))
    with pytest.raises(ValueError, match="task"):
        UseCase("u", DATA, task="ranking")
