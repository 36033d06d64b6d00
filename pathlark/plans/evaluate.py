"""Offline (average precision) and online (click-through, conversion) evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathlark.functions.labels import category_match, label_buy
from pathlark.functions.trees import score_tree_ensemble
from pathlark.operators.cleaning import history_behavior
from pathlark.operators.evaluation import (
    average_precision, ctr_cvr_after_rec, eval_row,
)
from pathlark.operators.features import agg_interactions
from pathlark.operators.joins import join_exclude_cold_users, skew_join
from pathlark.plans.recommend import Scorer
from pathlark.sources.feeds import in_range


def offline_features(
    test: DataFrame, users: DataFrame, history: DataFrame, keep: tuple[str, ...] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """Model inputs of test rows. Users without features are left out; no history counts as 0."""
    known = join_exclude_cold_users(test, users, hot_rows)
    past = agg_interactions(history_behavior(history))
    joined = skew_join(known, past, ["user_id", "item_id"], "left", hot_rows)
    return joined.select(
        "user_id", "item_id", *keep, "buy_rate", "active_score",
        category_match(F.col("category_id"), F.col("high_freq_category")).alias("category_match"),
        F.coalesce("pv_count_5min", F.lit(0)).alias("pv_count_5min"),
        F.coalesce("is_cart_or_fav", F.lit(0)).alias("is_cart_or_fav"),
    )


def score_batch(features: DataFrame, scorer: Scorer = score_tree_ensemble) -> DataFrame:
    return scorer(features)


def evaluate_offline(
    test: DataFrame, users: DataFrame, history: DataFrame, scorer: Scorer = score_tree_ensemble
) -> DataFrame:
    """Average precision over all test rows.

    Rows of one (user, item, category) share their features and hence their score, so they are
    counted first and scored once; the measure needs only counts per score.
    """
    groups = test.groupBy("user_id", "item_id", "category_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(label_buy(F.col("behavior_type"))).alias("pos")
    )
    scored = scorer(offline_features(groups, users, history, keep=("n", "pos")))
    counts = scored.groupBy(F.col("predict_score").alias("s")).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos")
    )
    return average_precision(counts)


def evaluate_online(recommendations: DataFrame, behaviors: DataFrame, start: str, end: str) -> DataFrame:
    """Click-through and conversion of what was recommended and done within [start, end]."""
    return ctr_cvr_after_rec(in_range(recommendations, start, end), in_range(behaviors, start, end))


def offline_row(result: DataFrame, start: str, created: str, row_id: int) -> DataFrame:
    return eval_row(result.select("pr_auc"), start, start, created, row_id)


def online_row(result: DataFrame, start: str, end: str, created: str, row_id: int) -> DataFrame:
    return eval_row(result.select("ctr", "cvr", "recommend_count"), start, end, created, row_id)
