from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from pathlark.functions.trees import STARTER, Ensemble, Split, score_tree_ensemble
from pathlark.operators import dashboard as D
from pathlark.operators import ranking as R
from pathlark.operators import windows as W
from pathlark.operators.cleaning import with_event_time
from tests.helpers import T0, at, behaviors, rows


def test_sliding_features(spark):
    b = with_event_time(behaviors(spark, [
        (1, 1, 5, "pv", 0), (1, 1, 6, "cart", 12), (1, 1, 4, "buy", 12), (1, 1, 9, "pv", 31)]))
    got = W.win_sliding_features(b).select(
        (F.unix_timestamp("window_start") - T0).alias("s"), "category_id", "pv_count_5min", "is_cart_or_fav")
    assert rows(got) == [
        (-20, 5, 1, 0), (-10, 4, 3, 1), (0, 4, 3, 1), (10, 9, 3, 1), (20, 9, 1, 0), (30, 9, 1, 0)]


@pytest.mark.parametrize("ids", [(5, 2**32 + 5), (2**32 + 5, 5), (2**62, 2**62 + 1)])
def test_newest_category_with_wide_ids(spark, ids):
    b = with_event_time(behaviors(spark, [(1, 1, c, "pv", 12) for c in ids]).coalesce(1))
    assert W.win_sliding_features(b).select("category_id").distinct().collect()[0][0] == min(ids)


def test_features_do_not_depend_on_partitioning(spark, sf):
    from checks.queries import beh

    b = with_event_time(beh(spark, sf))
    one = rows(W.win_sliding_features(b.coalesce(1), "1 day", "8 hours"))
    many = rows(W.win_sliding_features(b.repartition(7, "behavior_time").sortWithinPartitions(F.desc("id")), "1 day", "8 hours"))
    assert one == many


def test_salted_equals_unsalted(spark):
    # one item holds a third of all views, and one view is repeated very often
    b = with_event_time(behaviors(spark, [
        (u % 13 + 1, 1 if u % 3 == 0 else u % 17, 1, "pv", u * 7 if u % 5 else 60) for u in range(900)]))
    want = rows(W.hot_items_unsalted(b))
    for salts in (1, 10, 97):
        assert rows(W.hot_items_two_phase(b, salts=salts)) == want
    with pytest.raises(ValueError):
        W.hot_items_two_phase(b, 100, 60)


def scored(spark, data):
    full = [(u, i, p, Dec(q), Dec(f), at(t)) for u, i, p, q, f, t in data]
    return spark.createDataFrame(full, "user_id BIGINT, item_id BIGINT, predict_score DOUBLE, popularity_score DECIMAL(18,4), "
                                 "final_score DECIMAL(28,12), window_end TIMESTAMP")


def test_topk_ties_and_best_ever(spark):
    data = [(1, i, 0.5, "1", "1.5", i) for i in range(12, 1, -1)]  # eleven equal items
    data += [(1, 5, 0.9, "1", "2.0", 50), (1, 5, 0.1, "1", "0.1", 60)]  # a later lower score does not replace
    got = R.topk_per_user(scored(spark, data), 10, "window_end")
    assert rows(got, "rank_no", "item_id") == [(1, 5), (2, 2), (3, 3), (4, 4), (5, 6), (6, 7), (7, 8), (8, 9), (9, 10), (10, 11)]
    five = got.filter("item_id = 5").first()
    assert (five["final_score"], five["predict_score"]) == (Dec("2.0"), 0.9)
    assert five["create_time"].timestamp() == T0 + 5  # when the pair was first seen


def test_topk_is_pruned_before_the_shuffle(spark):
    plan = R.topk_per_user(scored(spark, [(1, 1, 0.5, "1", "1", 0)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_by_score_and_by_rank(spark):
    recs = spark.createDataFrame(
        [(1, 10, 0.5, Dec("0.3000"), Dec("0.900000000000"), 2), (1, 11, 0.5, Dec("0.8000"), Dec("0.300000000000"), 1),
         (2, 12, 0.5, Dec("0.8000"), Dec("0.300000000000"), 1)],
        "user_id BIGINT, item_id BIGINT, predict_score DOUBLE, popularity_score DECIMAL(18,4), final_score DECIMAL(28,12), rank_no INT")
    by_score = R.latest_recommendations(recs, 1)
    assert rows(by_score, "rank_no", "item_id", "popularity") == [(1, 10, "高"), (2, 11, "低")]
    by_rank = R.latest_recommendations(recs, 1, by="rank")
    assert rows(by_rank, "rank_no", "item_id", "popularity") == [(1, 11, "高"), (2, 10, "低")]


def test_served_users_come_first(spark):
    kind = "user_id BIGINT, item_id BIGINT, predict_score DOUBLE, popularity_score DECIMAL(18,4), final_score DECIMAL(28,12), rank_no INT"
    stored = spark.createDataFrame([(u, 10 + k, 0.5, Dec("0.8"), Dec(k), 3 - k) for u in (1, 2) for k in range(3)], kind)
    served = spark.createDataFrame([(1, 50, 0.5, Dec("0.2")), (1, 51, 0.5, Dec("0.9"))], "user_id BIGINT, item_id BIGINT, predict_score DOUBLE, final_score DECIMAL(28,12)")
    got = R.served_or_stored(served, stored, 2)
    assert rows(got, "user_id", "rank_no", "item_id", "popularity") == [(1, 1, 51, "高"), (1, 2, 50, "低"), (2, 1, 12, "高"), (2, 2, 11, "高")]


def brute(node, x):
    while isinstance(node, Split):
        node = node.left if x[node.feature] <= node.threshold else node.right
    return node


def test_scoring_against_brute_force(spark):
    import itertools
    import math

    import numpy as np

    grid = list(itertools.product([0.0, 0.05, 0.2, 0.8, 1.1, 1.4], [0.1, 0.6, 1.0], [0, 1, 3, 9], [0, 1], [0, 1]))
    names = ["buy_rate", "active_score", "pv_count_5min", "is_cart_or_fav", "category_match"]
    df = spark.createDataFrame([tuple(map(float, g)) for g in grid], ", ".join(f"{n} DOUBLE" for n in names))
    for r in score_tree_ensemble(df).collect():
        x = {n: float(np.float32(r[n])) for n in names}
        z = sum(brute(t, x) for t in STARTER.trees) * STARTER.rate + STARTER.intercept
        assert r["predict_score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-12)


def test_missing_inputs_and_float32(spark):
    model = Ensemble((Split("a", 0.1, 0.0, 8.0),), rate=1.0)
    df = spark.createDataFrame([(None,), (0.1,)], "a DOUBLE")  # float32(0.1) lies above 0.1
    low, high = [r["predict_score"] for r in score_tree_ensemble(df, model, features=["a"]).collect()]
    assert low == 0.5 and high > 0.99


def test_dashboard_lists(spark):
    items = spark.createDataFrame([(i, i % 3, 100 - i % 5, Dec(i % 4)) for i in range(1, 71)],
                                  "item_id BIGINT, category_id BIGINT, pv_count BIGINT, popularity_score DECIMAL(18,4)")
    top = [r["item_id"] for r in D.top10_items(items).collect()]
    assert top == [3, 7, 11, 15, 19, 23, 27, 31, 35, 39]
    found = [r["item_id"] for r in D.item_list(items, "6").collect()]
    assert found[:3] == [60, 65, 6] and set(found) == {i for i in range(1, 71) if "6" in str(i)}
    assert len(D.item_list(items, "  ").collect()) == 50
    assert [r[0] for r in D.category_list(items).collect()] == [0, 1, 2]


def metrics(spark):
    data = [(1, at(0), at(9), 0.5, -1.0, -1.0, -1, at(1)), (2, at(0), at(9), -1.0, 0.25, 0.5, 7, at(2)),
            (3, at(0), at(9), None, None, 0.75, 7, at(3)), (4, at(0), at(9), 0.6, -1.0, -1.0, -1, at(1))]
    return spark.createDataFrame(data, "id BIGINT, metric_start_time TIMESTAMP, metric_end_time TIMESTAMP, pr_auc DOUBLE, "
                                 "ctr DOUBLE, cvr DOUBLE, recommend_count BIGINT, create_time TIMESTAMP")


def test_metric_lists(spark):
    m = metrics(spark)
    assert [r["id"] for r in D.pr_auc_trend(m).collect()] == [4, 1]
    assert [r["id"] for r in D.pr_auc_latest(m).collect()] == [4]
    start, end = "2024-01-01 00:00:00", "2024-01-01 00:00:09"
    assert [tuple(r)[2:] for r in D.ctr_cvr_trend(m, start, end).collect()] == [(0.25, 0.5), (0.0, 0.75)]
    assert len(D.ctr_cvr_trend(m, start, end, exclude_sentinel=False).collect()) == 4
    recs = spark.createDataFrame([(at(0),), (at(9),), (at(10),)], "create_time TIMESTAMP")
    assert D.ctr_cvr_lookup(m.filter("id < 4"), recs, start, end).first()[:3] == (0.0, 0.75, 2)
    assert D.ctr_cvr_lookup(m.limit(0), recs, start, end).first()[:3] == (0.0, 0.0, 2)


@pytest.mark.parametrize("trees,depth", [(3, 5), (50, 3), (100, 5), (30, 4), (20, 6), (5, 7)])
def test_large_ensembles_leave_the_stage_compiled(spark, trees, depth):
    """Up to 100 trees of depth 5, as many as the search may choose; lopsided trees; one leaf; beyond bit vectors."""
    def grown(depth, k):
        feature = ["buy_rate", "active_score", "pv_count_5min", "is_cart_or_fav", "category_match"][(depth + k) % 5]
        if not depth or k % 11 == 10:
            return float(k % 7) - 3
        return Split(feature, 0.1 * depth + 0.01 * (k % 40), grown(depth - 1, 2 * k), grown(depth - 1, 2 * k + 1))

    model = Ensemble((*(grown(depth, k + 1) for k in range(trees)), 0.25), rate=0.1, weights=tuple(0.5 + k % 2 for k in range(trees + 1)))
    data = spark.range(200).select(*(
        (F.pmod(F.xxhash64("id", F.lit(c)), F.lit(100)) / 100).alias(c) for c in ("buy_rate", "active_score", "pv_count_5min", "is_cart_or_fav", "category_match")))
    got = score_tree_ensemble(data, model)

    def leaf(node, row):
        while isinstance(node, Split):
            node = node.left if row[node.feature] <= node.threshold else node.right
        return node

    import numpy as np

    for r in got.collect():
        x = {c: float(np.float32(r[c])) for c in data.columns}
        p = 1 / (1 + np.exp(-0.1 * sum(leaf(t, x) * w for t, w in zip(model.trees, model.weights))))
        assert r["predict_score"] == pytest.approx(p, abs=1e-9)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("transform(" in plan) == (depth == 7) != plan.strip().startswith("*(")
