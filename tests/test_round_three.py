"""Findings of the third round."""

from dataclasses import replace

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lodemark.catalog.modeling import TRAINED_AT, job_store
from lodemark.operators import explain
from lodemark.operators.boosting import FEATURES, LABEL, VALIDATES, WEIGHT, Booster, BoosterSpec, _leaf_steps
from lodemark.operators.explain import causes_by_key, contribution_rows
from lodemark.operators.ranking import running_totals
from lodemark.plans.training import train
from lodemark.sources import fixtures as X


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_contributions_are_summed_wide_before_they_become_rows(spark):
    """A key met twice is one group, NULL adds nothing, a feature of two encoded columns is one sum; no copy of a row per feature."""
    rows = spark.createDataFrame(
        [(1, 1.0, 2.0, -1.0), (1, None, 0.5, 0.25), (2, -1.0, 0.5, 3.0), (None, 4.0, None, None), (3, None, None, None)],
        "K int, A_X_why double, a_y_why double, B_why double")
    contract = spark.createDataFrame([("a_x", "A"), ("A_Y", "A"), ("B", "B"), ("GONE", "C")], "ENCODED_NAME string, SOURCE_NAME string")
    found = contribution_rows(rows, ["K"], ["A_X", "a_y", "B"], contract, "_why")
    assert found.columns == ["K", "BASE", "CONTRIB"]
    assert {(r["K"], r["BASE"]): r["CONTRIB"] for r in found.collect()} == {(1, "A"): 3.5, (2, "B"): 3.0, (None, "A"): 4.0}
    assert {r["K"]: r["PROBABLE_CAUSES"] for r in causes_by_key(found, ["K"], 2).collect()} == {1: "A", 2: "B", None: "A"}
    assert "Expand" not in plan_of(found) and "Join" not in plan_of(found)
    assert contribution_rows(rows, ["K"], ["A_X"], contract.where("false"), "_why").collect() == []


def test_thousands_of_encoded_columns_are_one_sum(spark):
    names = [f"A_{i}" for i in range(1500)]
    rows = spark.range(2).select("id", *[F.lit(1.0).alias(n) for n in names])
    contract = spark.createDataFrame([(n, "A") for n in names], "ENCODED_NAME string, SOURCE_NAME string")
    found = contribution_rows(rows, ["id"], names, contract).collect()
    assert [r["CONTRIB"] for r in found] == pytest.approx([1500.0, 1500.0])


def test_running_totals_read_the_rows_once(spark):
    """However many slices there are, only the table of distinct values is read again."""
    rows = spark.range(300).selectExpr("if(id % 50 = 49, null, cast(id % 50 as double) / 7) K", "id % 3 V")
    found = running_totals(rows, "K", {"N": F.count("*"), "S": F.sum("V")}, descending=True, rows_per_slice=10)
    assert "Range" not in plan_of(found)
    expected, n, total = [], 0, 0
    for k in range(48, -1, -1):
        own = [i % 3 for i in range(300) if i % 50 == k]
        n, total = n + len(own), total + sum(own)
        expected.append((pytest.approx(k / 7), len(own), sum(own), n, total))
    assert [tuple(r) for r in found.orderBy(F.desc("K")).collect()] == expected


@pytest.mark.parametrize("task", ["binary", "multiclass", "regression"])
def test_a_tree_holds_the_leaf_sums_of_its_rows(spark, task):
    """Without sampling no pass over the rows sums the leaves; the tree says the same as that pass."""
    rows = spark.range(600).selectExpr("cast(id % 13 as double) A", "cast(id % 7 as double) B", f"cast(id % 13 % 3 {'> 0' if task == 'binary' else ''} as double) {LABEL}",
                                       f"id % 4 = 0 {VALIDATES}", f"1 + id % 5 / 10 {WEIGHT}")
    data = VectorAssembler(inputCols=["A", "B"], outputCol=FEATURES).transform(rows).drop("A", "B")
    booster = Booster(data, task, 3, BoosterSpec(rounds=1, depth=3))
    before = booster._with_chances(booster.rows).persist()
    before.count()  # growing drops the table it came from
    booster.grow(1)
    leaves = before
    for k, trees in enumerate(booster.trees):
        leaves = trees[0].transform(leaves).drop(f"_P{k}")
    new = [trees[0] for trees in booster.trees]
    told = booster._leaf_sums(leaves, new)
    booster.spec = replace(booster.spec, subsample=0.5)
    summed = booster._leaf_sums(leaves, new)
    for tree, a, b in zip(new, told, summed):
        assert len(_leaf_steps(tree)) == len(a) == len(b) > 2
        assert [x for pair in a for x in pair] == pytest.approx([x for pair in b for x in pair], abs=1e-9)


def test_a_block_of_explained_rows_stays_small():
    """A worker holds a block's features, contributions and their Arrow copies, four of 8 bytes a value, beside CELLS."""
    assert explain.FEATURES_AT_ONCE * 8 * 4 <= 16 * 2**20


def test_training_reads_its_source_once(spark, data):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def told(cohort):
        seen.add(1)
        return cohort

    history = X.history(spark, data).persist()
    train(job_store(spark), history.withColumn("COHORT", told("COHORT")), "V1", TRAINED_AT)
    assert seen.value == history.count() > 0
