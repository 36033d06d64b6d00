from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from pathlark.functions import labels, numeric
from pathlark.operators import features as X
from tests.helpers import behaviors, rows


def test_half_up_is_exact(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (5, 0), (0, 7), (1, 20000), (3, 20000)], "a BIGINT, b BIGINT")
    got = [r[0] for r in df.select(numeric.half_up_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [Dec(x) for x in ("0.1250", "0.3333", "0.6667", "0.0000", "0.0000", "0.0001", "0.0002")]


def test_final_score_rounds_half_up(spark):
    df = spark.createDataFrame([(0.5, Dec("1.0000")), (1 / 3, Dec("0.5000"))], "p DOUBLE, q DECIMAL(18,4)")
    got = [r[0] for r in df.select(numeric.final_score(F.col("p"), F.col("q"))).collect()]
    assert got == [Dec("0.650000000000"), Dec("0.383333333333")]


def test_user_features(spark):
    df = behaviors(spark, [
        (1, 1, 5, "pv", 0), (1, 2, 6, "pv", 1), (1, 3, 6, "buy", 2), (1, 4, 5, "cart", 3),  # tie of 5 and 6
        (2, 1, 9, "buy", 4),  # no views
    ])
    got = rows(X.user_features(df))
    assert got == [
        (1, 2, 1, 1, 0, Dec("0.5000"), Dec("0.0400"), 5),
        (2, 0, 1, 0, 0, Dec("0.0000"), Dec("0.0100"), 9),
    ]
    assert rows(X.user_high_freq_category(df)) == [(1, 5), (2, 9)]


def test_activity_is_capped(spark):
    df = behaviors(spark, [(1, 1, 1, "pv", t) for t in range(150)])
    assert rows(X.user_features(df), "active_score") == [(Dec("1.0000"),)]


def test_item_features(spark):
    df = behaviors(spark, [(1, 1, 5, "pv", 0), (2, 1, 7, "buy", 1), (3, 1, 6, "buy", 2)])
    assert rows(X.item_features(df)) == [(1, 7, 1, 2, Dec("1.7000"))]


def test_funnel_with_empty_stages(spark):
    df = behaviors(spark, [(1, 1, 1, "pv", 0), (1, 1, 1, "pv", 1), (1, 1, 1, "buy", 2)])
    zero = Dec("0.0000")
    assert rows(X.behavior_funnel(df)) == [(2, 0, 0, 1, zero, zero, zero, Dec("50.0000"))]
    none = X.behavior_funnel(df.limit(0))
    assert rows(none) == [(0, 0, 0, 0, zero, zero, zero, zero)]


def test_distribution_and_share_list_all_stages(spark):
    df = behaviors(spark, [(1, 1, 1, "pv", 0), (1, 1, 1, "pv", 1), (1, 1, 1, "fav", 2)])
    assert rows(X.behavior_distribution(df)) == [(2, 0, 1, 0)]
    assert rows(X.behavior_share(df)) == [
        ("buy", 0, Dec("0.00")), ("cart", 0, Dec("0.00")), ("fav", 1, Dec("33.33")), ("pv", 2, Dec("66.67"))]
    assert {r["share_pct"] for r in X.behavior_share(df.limit(0)).collect()} == {Dec("0.00")}


def test_training_samples_equal_join_then_group(spark):
    data = [(u, i, i % 3 + 1, k, u * 7 + i) for u in range(1, 5) for i in range(1, 6) for k in ("pv", "cart", "buy")
            if (u + i) % 3]
    df = behaviors(spark, data * 9)
    users, items = X.user_features(df).filter("user_id <> 4"), X.item_features(df).filter("item_id <> 5")
    from pathlark.operators.joins import join_training_samples

    raw = join_training_samples(df, users, items).groupBy("user_id", "item_id").agg(
        F.least(F.count(F.lit(1)), F.lit(20)).alias("pv"), F.max((F.col("behavior_type") == "buy").cast("int")).alias("y"),
        F.max((F.col("high_freq_category") == F.col("item_category")).cast("int")).alias("m"))
    got = X.agg_training_samples(df, users, items)
    assert rows(got, "user_id", "item_id", "pv_count_5min", "buy_label", "category_match") == rows(raw)


def test_profile_of_nobody_is_zero(spark):
    users = X.user_features(behaviors(spark, [(1, 1, 1, "pv", 0)])).limit(0)
    assert rows(X.avg_user_profile(users)) == [(0.0,) * 6]


@pytest.mark.parametrize("score,want", [(0.7, "高"), (0.6999, "中"), (0.4, "中"), (0.39, "低"), (None, "低")])
def test_levels(spark, score, want):
    df = spark.createDataFrame([(score,)], "s DOUBLE")
    assert df.select(labels.popularity_level(F.col("s"))).first()[0] == want


def test_small_expressions(spark):
    df = spark.createDataFrame([("pv", 30, 1.5, 4, None), ("huh", 3, -0.5, 4, 4)], "k STRING, n INT, p DOUBLE, a INT, b INT")
    got = rows(df.select(
        labels.behavior_type_desc(F.col("k")), numeric.clip_pv(F.col("n")), numeric.clamp_probability(F.col("p")),
        labels.category_match(F.col("a"), F.col("b")), labels.label_buy(F.col("k"))))
    assert got == [("huh", 3, 0.0, 1, 0), ("浏览", 20, 1.0, 0, 0)]


def test_prediction_stats_never_negative(spark):
    three, one = spark.range(3), spark.range(1)
    assert rows(X.prediction_stats(three, one)) == [(3, 0)]
    assert rows(X.prediction_stats(one, three)) == [(1, 2)]


def test_coverage(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (3, 0), (0, 0)], "pv_count_5min INT, is_cart_or_fav INT")
    assert rows(X.interaction_coverage(df)) == [(4, 2, 50.0, 1.0, 25.0)]
    assert rows(X.interaction_coverage(df.limit(0))) == [(0, 0, 0.0, 0.0, 0.0)]
