"""As-of join against a brute-force nearest search, ranking rules."""

import random

import pytest
from pyspark.sql import functions as F

from pitwall.operators.joins import asof_nearest, join_small
from pitwall.operators.rank import rank_final_position, rank_race_time


def _asof(spark, left, right, width):
    L = spark.createDataFrame(left, "k string, lid int, t double")
    R = spark.createDataFrame(right, "k string, rid int, rt double, v string")
    out = asof_nearest(
        L, R, by=["k"], left_time="t", right_time="rt", right_id="rid", bucket_width=width,
    )
    rows = out.collect()
    assert len(rows) == len(left)  # exactly one output row per left row
    return {r.lid: r for r in rows}


def brute(left, right):
    out = {}
    for k, lid, t in left:
        cands = [(abs(rt - t), rt, rid, v) for (rk, rid, rt, v) in right if rk == k and rt is not None]
        if t is None or not cands:
            out[lid] = None
        else:
            out[lid] = min(cands)[2]
    return out


@pytest.mark.parametrize("width", [1.0, 3.0, 50.0, 1000.0])
def test_asof_edge_rows(spark, width):
    left = [("a", 1, 10.0), ("b", 2, 5.0), ("a", 3, None), ("a", 4, 100.0), ("a", 5, 9.0)]
    right = [("a", 11, 9.0, "nine"), ("a", 12, 11.0, "eleven"), ("a", 13, 9.0, "nine-b")]
    got = _asof(spark, left, right, width)
    assert got[1].rid == 11  # tie 9 vs 11 -> earlier time; equal times -> lower id
    assert got[2].rid is None  # no sample under the key
    assert got[3].rid is None  # NULL time
    assert got[4].rid == 12 and got[4].asof_distance == 89.0
    assert got[5].rid == 11 and got[5].asof_distance == 0.0


@pytest.mark.parametrize("width", [1.0, 7.0, 500.0])
def test_asof_matches_brute_force(spark, width):
    rng = random.Random(7)
    keys = ["a", "b", "c"]
    left = [(rng.choice(keys), i, float(rng.randint(0, 200))) for i in range(300)]
    # a hot key: most samples under "a", with many equal times
    right = [(rng.choice(["a", "a", "a", "b"]), 1000 + i, float(rng.randint(0, 200)), "v") for i in range(120)]
    exp = brute(left, right)
    got = _asof(spark, left, right, width)
    assert {k: v.rid for k, v in got.items()} == exp


def test_asof_far_samples_and_null_keys(spark):
    left = [("a", 1, 3.0e9), ("a", 2, 1.0), (None, 3, 1.0)]
    right = [("a", 11, 0.0, "v"), ("a", 12, 3.2e9, "v"), (None, 13, 1.0, "v")]
    got = _asof(spark, left, right, 1.0)  # a century apart at a width of one second
    assert (got[1].rid, got[2].rid, got[3].rid) == (12, 11, None)


def test_asof_rows_in_the_plan_stay_linear(spark):
    n = 20_000  # all rows of both sides under one key and bucket
    L = spark.range(n).selectExpr("'a' as k", "cast(id as int) as lid", "id % 7200 + 0.5D as t")
    R = spark.range(n).selectExpr("'a' as k", "cast(id as int) as rid", "cast(id % 7200 as double) as rt")
    out = asof_nearest(L, R, ["k"], "t", "rt", "rid", bucket_width=86400.0)
    assert out.where("asof_distance = 0.5").count() == n


def test_asof_plan_has_no_pairs(spark):
    L = spark.createDataFrame([("a", 1, 1.0)], "k string, lid int, t double")
    R = spark.createDataFrame([("a", 2, 1.0)], "k string, rid int, rt double")
    out = asof_nearest(L, R, ["k"], "t", "rt", "rid", bucket_width=10.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_join_small_follows_runtime_size(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 5)
    small = big.groupBy("k").count()

    def plan():
        df = join_small(big, small, ["k"])
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rank_race_time_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 1, "c", 90.0), (1, 1, "a", 90.0), (1, 1, "b", None), (1, 1, "d", 80.0), (1, 2, "a", 70.0)],
        "year int, round int, driver string, p double",
    )
    got = {(r.round, r.driver): r.pred_race_pos for r in rank_race_time(df, "p").collect()}
    assert got == {(1, "d"): 1, (1, "a"): 2, (1, "c"): 3, (1, "b"): None, (2, "a"): 1}


def test_rank_final_position(spark):
    df = spark.createDataFrame(
        [(1, 1, "x", 3.0, 1.0), (1, 1, "y", 2.0, 0.0), (1, 1, "z", 1.0, None), (1, 1, "w", 4.0, 2.0)],
        "year int, round int, driver string, start_grid double, pred_delta double",
    )
    got = {r.driver: r.pred_final_position for r in rank_final_position(df).collect()}
    # scores: x 2, y 2, w 2 -> equal scores ordered by grid; z has no score -> last
    assert got == {"y": 1, "x": 2, "w": 3, "z": 4}
    assert sorted(got.values()) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        rank_final_position(df.drop("start_grid"))


def test_rank_hot_race_spread_over_partitions(spark):
    import random as _r

    from pitwall.operators.rank import ordered_rank

    rng = _r.Random(3)
    rows = [(2024, 1, f"d{i:04d}", float(rng.randint(0, 50))) for i in range(600)]
    rows += [(2024, 2, "solo", 1.0), (None, None, "nullrace", 2.0)]
    df = spark.createDataFrame(rows, "year int, round int, driver string, p double")
    got = ordered_rank(df, ["year", "round"], [F.col("p"), F.col("driver")], "r", partitions=16).collect()
    hot = sorted((r for r in got if r.round == 1), key=lambda r: r.r)
    assert [r.r for r in hot] == list(range(1, 601))
    assert [(r.p, r.driver) for r in hot] == sorted((r.p, r.driver) for r in hot)
    assert {r.driver: r.r for r in got if r.round != 1} == {"solo": 1, "nullrace": 1}


def test_row_numbers_equal_window_row_number_on_a_hot_group(spark):
    """Exact per-group row numbers with one group holding a third of the rows,
    NULL keys and small Arrow batches (runs continue across batches and
    across partitions)."""
    from pyspark.sql import Window

    from pitwall.operators.rank import row_numbers

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1))
        .when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise(F.col("id") % 40)
        .cast("int")
        .alias("k1"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit("a")).alias("k2"),
        (F.col("id") * 7919 % 5003).alias("o"),
        "id",
    )
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = row_numbers(df, ["k1", "k2"], [F.col("o"), F.col("id")], "rn", partitions=16)
        exp = df.withColumn(
            "rn", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("o", "id")).cast("bigint")
        )
        assert got.count() == 3000
        assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
        spread = got.filter(F.col("k1") == 1).select(F.spark_partition_id()).distinct().count()
        assert spread > 1  # the hot group is not one task
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_asof_hot_key_on_distributed_numbering(spark):
    """With the window limit at 0 the right side's neighbours come from the
    distributed row numbering; results still equal the brute force."""
    import pitwall.operators.rank as K

    rng = random.Random(11)
    left = [(rng.choice(["a", "a", "b"]), i, float(rng.randint(0, 300))) for i in range(200)]
    right = [(rng.choice(["a", "a", "a", "b"]), 2000 + i, float(rng.randint(0, 300)), "v") for i in range(150)]
    exp = brute(left, right)
    default = K.WINDOW_MAX_GROUP_ROWS
    try:
        K.WINDOW_MAX_GROUP_ROWS = 0
        got = _asof(spark, left, right, 10.0)
    finally:
        K.WINDOW_MAX_GROUP_ROWS = default
    assert {k: v.rid for k, v in got.items()} == exp


@pytest.mark.parametrize("limit", [None, 0])
def test_prev_next_equals_lag_lead(spark, limit):
    """Both paths of prev_next (window, and numbering + index joins) equal
    lag/lead, with NULL keys and a hot key."""
    from pyspark.sql import Window

    from pitwall.operators.rank import prev_next

    df = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot"))
        .when(F.col("id") % 13 == 0, F.lit(None))
        .otherwise((F.col("id") % 9).cast("string"))
        .alias("k"),
        (F.col("id") * 7919 % 100003).alias("t"),
        (F.col("id") % 5).cast("double").alias("v"),
    )
    got = prev_next(df, ["k"], "t", "v", "pv", "nv", max_group_rows=limit)
    w = Window.partitionBy("k").orderBy("t")
    exp = df.select("*", F.lag("v").over(w).alias("pv"), F.lead("v").over(w).alias("nv"))
    assert got.columns == exp.columns
    assert got.count() == 2000
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
