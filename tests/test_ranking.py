"""Order statistics, running totals and splits against brute force, with many slices, ties and skew."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lodemark.operators import ranking as R
from lodemark.operators import splits as S
from lodemark.settings import SplitSpec


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value."""
    rng = random.Random(3)
    rows = [(i, 5.0 if i % 3 == 0 else round(rng.uniform(-50, 50), 1), rng.randrange(4)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id long, x double, g int").persist()


def test_order_statistics_narrow_to_the_exact_value(skewed):
    rows, df = skewed
    values = sorted(r[1] for r in rows)
    ranks = [1, 2, 700, 1000, 1500, 1501, 2999, 3000]
    found = R.order_statistics(df, [("x", lambda n, k=k: k) for k in ranks], exact_rows=40, grid=8)
    for k, f in zip(ranks, found):
        assert (f.value, f.rows) == (values[k - 1], 3000)
        assert f.below == sum(v < f.value for v in values) and f.ties == values.count(f.value)


def test_many_columns_narrow_in_the_same_few_jobs(spark, skewed):
    """Forty columns take as many jobs as one: all intervals narrow together and share the bound on rows ranked exactly."""
    _, df = skewed
    wide = df.select(*[(F.col("x") * (i + 1) + F.when(F.col("id") % 7 == 0, None).otherwise(0)).alias(f"c{i}") for i in range(40)]).persist()
    values = sorted(r[0] for r in wide.select("c0").where("c0 IS NOT NULL").collect())

    def jobs(columns):
        context, name = spark.sparkContext, f"ranks-{len(columns)}"
        context.setJobGroup(name, name)
        found = R.order_statistics(wide, [(c, lambda n: n // 2) for c in columns], exact_rows=400, grid=64)
        context._jsc.clearJobGroup()
        return found, len(context.statusTracker().getJobIdsForGroup(name))

    (one,), few = jobs(["c0"])
    many, more = jobs([f"c{i}" for i in range(40)])
    assert one.value == values[len(values) // 2 - 1]
    for i, f in enumerate(many):
        assert f.value == pytest.approx(one.value * (i + 1)) and (f.below, f.ties, f.rows) == (one.below, one.ties, one.rows)
    assert more <= few + 4


def test_order_statistics_skip_null_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "x double, y double")
    x, y = R.order_statistics(df, [("x", lambda n: n), ("y", lambda n: 1)])
    assert (x.value, x.rows, y) == (3.0, 2, None)
    assert R.order_statistics(df, []) == []


def test_running_totals_over_many_slices(skewed):
    rows, df = skewed
    got = {r["x"]: (r["n"], r["RUN_n"]) for r in R.running_totals(df, "x", {"n": F.count("*")}, rows_per_slice=100).collect()}
    values = [r[1] for r in rows]
    assert got == {v: (values.count(v), sum(w <= v for w in values)) for v in set(values)}


def test_percent_ranks_match_the_window_and_salting_keeps_rows(skewed, monkeypatch):
    rows, df = skewed
    expected = {r["id"]: r["p"] for r in df.selectExpr("id", "percent_rank() over (order by x) p").collect()}
    assert {r["id"]: r["p"] for r in R.percent_ranks(df, {"p": "x"}, rows_per_slice=200).collect()} == expected
    monkeypatch.setattr(R, "LOOKUP_ROWS", 0)  # the shuffle path beyond the broadcast bound
    assert {r["id"]: r["p"] for r in R.percent_ranks(df, {"p": "x"}, rows_per_slice=200).collect()} == expected


def test_wide_integers_follow_exactly(spark):
    """Neighbours above 2^53 share a double, at both ends of the range too; ranks and totals tell them apart."""
    rows = [(i, v) for i, v in enumerate([2**53 + 1, 2**53, 2**53 + 1, -(2**63), 2**63 - 1, 2**63 - 2, -(2**63) + 1, 0, 7])]
    df = spark.createDataFrame(rows, "id long, k long")
    for way, descending in (("asc", False), ("desc", True)):
        expected = {r["id"]: r["p"] for r in df.selectExpr("id", f"percent_rank() over (order by k {way}) p").collect()}
        for per_slice in (2, 100):
            got = R.percent_ranks(df, {"p": "k"}, descending, rows_per_slice=per_slice)
            assert got.columns == ["id", "k", "p"] and {r["id"]: r["p"] for r in got.collect()} == expected
            totals = R.running_totals(df, "k", {"n": F.count("*")}, descending, rows_per_slice=per_slice)
            running = sum(1 for _ in rows)
            assert {r["k"]: r["RUN_n"] for r in totals.collect()} == {
                v: sum((w >= v if descending else w <= v) for _, w in rows) for _, v in rows} and totals.agg(F.max("RUN_n")).first()[0] == running


def test_percent_ranks_of_several_columns_share_their_pass(spark, skewed):
    _, df = skewed
    wide = df.selectExpr("id", "x", "cast(id % 17 as int) y", "date_add(date'2024-01-01', cast(id % 5 as int)) z")
    expected = {r["id"]: tuple(r)[1:] for r in wide.selectExpr("id", *[f"percent_rank() over (order by {c})" for c in "xyz"]).collect()}
    for per_slice in (150, 10**6):
        got = R.percent_ranks(wide, {"px": "x", "py": "y", "pz": "z"}, rows_per_slice=per_slice)
        assert {r["id"]: (r["px"], r["py"], r["pz"]) for r in got.collect()} == expected
    assert R.percent_ranks(wide.where("id < 0"), {"px": "x", "py": "y"}).count() == 0
    assert R.percent_ranks(wide, {}).columns == wide.columns


def test_percent_rank_of_one_row(spark):
    df = spark.createDataFrame([(1, 2.0)], "id long, x double")
    assert R.percent_ranks(df, {"p": "x"}).first()["p"] == 0.0


@pytest.mark.parametrize("k", [0, 1, 999, 1000, 1500, 3000, 9999])
def test_leading_rows_break_ties_exactly(skewed, k):
    rows, df = skewed
    kept = {r["id"] for r in R.leading_rows(df, [("x", "desc"), ("id", "asc")], lambda n: k).collect()}
    best = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
    assert kept == {r[0] for r in best}


def test_cutoffs_cap_at_the_rows_there_are(spark):
    df = spark.createDataFrame([(0.1,), (0.9,), (0.5,), (0.9,)], "s double")
    assert R.cutoffs(df, "s", {"a": 1, "b": 3, "c": 100}) == {"a": 0.9, "b": 0.5, "c": 0.1}
    assert R.cutoffs(df.where("s > 1"), "s", {"a": 1}) == {"a": None}


def test_newest_fraction_rounds_half_to_even(spark):
    df = spark.createDataFrame([(i, 1) for i in range(5)], "id long, t int")
    assert R.newest_fraction(df, "t", 0.5, ["id"], 1).count() == 2  # 2.5 rows
    a = {r["id"] for r in R.newest_fraction(df, "t", 0.6, ["id"], 1).collect()}
    assert a == {r["id"] for r in R.newest_fraction(df, "t", 0.6, ["id"], 1).collect()} and len(a) == 3


def test_temporal_split_puts_the_split_cohort_on_the_test_side(spark):
    df = spark.createDataFrame([(i, 200001 + i // 10) for i in range(50)], "id long, c int")
    split = S.split_data(df, "c", ["id"], SplitSpec(test_fraction=0.2))
    assert (split.point, split.strategy) == (200004, "temporal")  # the share reaches 0.8 with 200004
    assert (split.train.count(), split.test.count()) == (30, 20)


def test_single_cohort_falls_back_to_ids(spark):
    df = spark.createDataFrame([(i % 7, 1) for i in range(70)], "id long, c int")
    split = S.split_data(df, "c", ["id"], SplitSpec(test_fraction=0.3))
    train, test = ({r["id"] for r in s.select("id").distinct().collect()} for s in (split.train, split.test))
    assert split.strategy == "random" and not train & test and len(test) == 2 and len(train) == 5


def test_search_split(spark):
    df = spark.createDataFrame([(i, i // 10) for i in range(100)], "id long, c int")
    assert df.where(S.search_fit_rows(df, "c", 0.2, ["id"])).agg(F.max("c")).first()[0] == 7
    assert df.where(S.search_fit_rows(df, "c", 0.0, ["id"])).count() == 100
    one = df.withColumn("c", F.lit(1))
    assert one.where(S.search_fit_rows(one, "c", 0.25, ["id"])).count() == 75


def test_timestamps_order_without_a_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist there on this day
        df = spark.sql("select * from values (1, timestamp_ntz'2024-03-10 02:30:00'), (2, timestamp_ntz'2024-03-10 03:15:00') v(id, t)")
        assert R.leading_rows(df, [("t", "desc")], lambda n: 1).first()["id"] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_decile_size():
    assert [R.decile(n) for n in (0, 5, 10, 19, 20)] == [1, 1, 1, 1, 2]
    assert math.isclose(R.half_even(3.5), 4)
