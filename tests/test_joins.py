from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from pathlark.operators import joins as J
from pathlark.operators.evaluation import ctr_cvr_after_rec, ctr_cvr_naive, rec_outcomes
from tests.helpers import at, behaviors, rows


@pytest.fixture(scope="module")
def sides(spark):
    """One key holds a third of the left rows; some keys have no partner."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("bigint").alias("k"), F.col("id").alias("v"))
    right = spark.range(5, 60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [500, 1, 10**9])
def test_salting_changes_nothing(sides, how, hot_rows):
    left, right = sides
    want = [tuple(r) for r in left.join(right, ["k"], how).collect()]
    got = J.skew_join(left, right, ["k"], how, hot_rows, salts=8)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert got.columns == left.join(right, ["k"], how).columns


def test_salting_spreads_the_hot_key(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        def busiest(df):
            return df.filter("k = 7").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert busiest(J.skew_join(left, right, ["k"])) >= 1000
        assert busiest(J.skew_join(left, right, ["k"], hot_rows=500, salts=64)) < 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_outer_right_is_refused(sides):
    with pytest.raises(ValueError):
        J.skew_join(*sides, ["k"], "full", 5)


def test_cold_start(spark):
    feats = spark.createDataFrame([(1, 10, 3), (2, 10, 8)], "user_id BIGINT, item_id BIGINT, category_id BIGINT")
    users = spark.createDataFrame(
        [(1, Dec("0.2000"), Dec("0.3000"), 4)],
        "user_id BIGINT, buy_rate DECIMAL(18,4), active_score DECIMAL(18,4), high_freq_category BIGINT")
    got = rows(J.join_user_features(feats, users), "user_id", "buy_rate", "active_score", "high_freq_category", "category_match")
    assert got == [(1, Dec("0.2000"), Dec("0.3000"), 4, 0), (2, Dec("0.0500"), Dec("1.0000"), 8, 1)]


def test_default_popularity(spark):
    feats = spark.createDataFrame([(1,), (2,), (3,)], "item_id BIGINT")
    items = spark.createDataFrame([(1, Dec("2.5000")), (2, None)], "item_id BIGINT, popularity_score DECIMAL(18,4)")
    assert rows(J.join_item_popularity(feats, items)) == [(1, Dec("2.5000")), (2, Dec("0.5000")), (3, Dec("0.5000"))]


def recommendations(spark, data):
    return spark.createDataFrame([(u, i, at(t)) for u, i, t in data], "user_id BIGINT, item_id BIGINT, create_time TIMESTAMP")


def test_only_later_behaviours_count(spark):
    recs = recommendations(spark, [(1, 1, 10), (1, 2, 10), (2, 1, 10)])
    b = behaviors(spark, [
        (1, 1, 1, "pv", 10),  # same moment: not later
        (1, 2, 1, "pv", 11), (1, 2, 1, "pv", 12),  # counted once
        (2, 1, 1, "buy", 12),  # bought without a view
    ])
    assert rows(rec_outcomes(recs, b), "user_id", "item_id", "viewed", "bought") == [
        (1, 1, False, False), (1, 2, True, False), (2, 1, False, True)]
    assert rows(ctr_cvr_after_rec(recs, b)) == [(3, 1, 1, 1 / 3, 1.0)]
    assert rows(ctr_cvr_naive(recs, b)) == [(3, 2, 1, 2 / 3, 0.5)]
    assert rows(J.join_before_after(recs, b)) == [(4, 1, 3, 25.0, 75.0)]
    assert len(rows(J.join_rec_then_behavior(recs, b))) == 3


def test_empty_denominators(spark):
    recs = recommendations(spark, [(1, 1, 10)])
    bought = behaviors(spark, [(1, 1, 1, "buy", 20)])
    assert rows(ctr_cvr_after_rec(recs.limit(0), bought)) == [(0, 0, 0, 0.0, 0.0)]
    assert rows(ctr_cvr_after_rec(recs, bought)) == [(1, 0, 1, 0.0, 0.0)]
    assert rows(J.join_before_after(recs.limit(0), bought)) == [(0, 0, 0, 0.0, 0.0)]


def test_pairs_without_history_count_zero(spark):
    b = behaviors(spark, [(1, 1, 1, "pv", 0), (1, 1, 1, "pv", 1), (2, 2, 1, "buy", 0)])
    past = spark.createDataFrame([(1, 1, 4, 1)], "user_id BIGINT, item_id BIGINT, pv_count_5min INT, is_cart_or_fav INT")
    assert rows(J.join_pairs_interactions(b, past)) == [(1, 1, 4, 1), (2, 2, 0, 0)]


def test_cold_rows_are_counted(spark):
    b = behaviors(spark, [(1, 1, 1, "pv", 0), (2, 1, 1, "pv", 1), (2, 2, 1, "buy", 0)])
    assert rows(J.count_cold_rows(b, spark.range(1, 2).withColumnRenamed("id", "user_id"))) == [(2,)]
    assert rows(J.count_cold_rows(b, spark.range(1, 3).withColumnRenamed("id", "user_id"))) == [(0,)]


def test_adaptive_execution_splits_a_heavy_user(spark, sf):
    """Without any hint, a user holding a third of the rows is split at run time."""
    from pathlark.session import use_utc

    use_utc(spark)
    feats = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).cast("bigint").alias("user_id"),
        F.xxhash64("id").alias("item_id"), (F.col("id") % 9).alias("category_id"))
    users = spark.range(5000).select(
        F.col("id").alias("user_id"), F.lit(Dec("0.1000")).cast("decimal(18,4)").alias("buy_rate"),
        F.lit(Dec("0.1000")).cast("decimal(18,4)").alias("active_score"), F.lit(1).cast("bigint").alias("high_freq_category"))
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k"}
    before = {k: spark.conf.get(k, None) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        best = J.join_user_features(feats.repartition(8), users).groupBy("user_id", "item_id").agg(F.max("buy_rate"))
        assert best.count() == 300000
        best.collect()
        assert "skew=true" in best._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
