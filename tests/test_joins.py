import random

from pyspark.sql import functions as F

from lodemark.operators import joins as J


def test_salted_join_equals_the_plain_join(spark):
    rng = random.Random(5)
    left = spark.createDataFrame([(i, None if i % 5 == 0 else (1 if i % 3 else rng.randrange(50))) for i in range(2000)], "id long, k int")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 50, 2)] + [(1, 10)], "k int, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        salted = J.salted_join(left, right, ["k"], how, hot_rows=50)
        plain = left.join(right, ["k"], how)
        rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
        assert rows(salted) == rows(plain), how
    hashes = {r["k"]: r["h"] for r in left.select("k", J.key_hash(["k"]).alias("h")).distinct().collect()}
    hot = J.hot_keys(left, ["k"], 50)
    assert hot[hashes[1]] > 2 and hashes[None] in hot


def test_every_hot_key_is_split_without_a_shuffle(spark):
    left = spark.range(60_000).selectExpr("id", "cast(id % 2000 as int) AS k")
    assert len(J.hot_keys(left, ["k"], 20)) == 2000 and set(J.hot_keys(left, ["k"], 20).values()) == {2}
    right = spark.range(2000).selectExpr("cast(id as int) AS k", "id AS v")
    plain = J.salted_join(left, right, ["k"], "inner", hot_rows=1000)._jdf.queryExecution().toString()
    assert "_SALT" not in plain
    assert J.salted_join(left, right, ["k"], "inner", hot_rows=20).where("v = k").count() == 60_000


def test_hot_key_is_spread_over_partitions(spark):
    left = spark.range(4000).select("id", F.lit(1).alias("k"))
    right = spark.createDataFrame([(1, "a")], "k int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = J.salted_join(left, right, ["k"], hot_rows=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and len(sizes) > 1 and max(sizes) < 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 4, 9), (2, None, 1)], "k int, t int, tie int")
    latest = J.latest_per_key(df, ["k"], "t", ["tie"])
    assert sorted(map(tuple, latest.collect())) == [(1, 5, 2), (2, None, 1)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan  # a limit on the map side, and one after the shuffle


def brute_asof(spine, features):
    out = []
    for k, t in spine:
        best = max((f for f in features if f[0] == k and f[1] <= t), key=lambda f: (f[1], f[2]), default=None)
        out.append((k, t, best and best[1], best and best[2]))
    return sorted(out, key=str)


def test_asof_lookup_over_many_slices(spark):
    rng = random.Random(11)
    pick = lambda: 1 if rng.random() < 0.4 else rng.randrange(2, 6)  # a hot key
    features = [(pick(), rng.randrange(400), i) for i in range(600)]
    spine = [(rng.choice([1, 1, 2, 3, 4, 5, 77]), rng.randrange(-20, 420)) for _ in range(500)]
    found = J.asof_lookup(spark.createDataFrame(spine, "k int, at int"), spark.createDataFrame(features, "k int, t int, v int"),
                          ["k"], "at", "t", ["v"], rows_per_slice=60)
    assert sorted(((r["k"], r["at"], r["t"], r["v"]) for r in found.collect()), key=str) == brute_asof(spine, features)


def test_asof_for_unique_drops_keys_without_an_earlier_row(spark):
    feed = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 9, "c")], "k int, t int, v string")
    spine = spark.createDataFrame([(1, 2), (2, 5)], "k int, at int")
    assert [(r["k"], r["v"]) for r in J.asof_for_unique(spine, feed, ["k"], "at", "t").collect()] == [(1, "a")]
