"""Behaviours to ranked recommendations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.functions.numeric import final_score
from pathlark.functions.trees import STARTER, Ensemble, score_tree_ensemble
from pathlark.operators.cleaning import with_event_time
from pathlark.operators.joins import join_item_popularity, join_user_features
from pathlark.operators.ranking import top_per_user
from pathlark.operators.windows import win_sliding_features


Scorer = Callable[[DataFrame], DataFrame]


def predict(rows: DataFrame, model: Ensemble | Scorer) -> DataFrame:
    """Add P(buy), by trees or by any function that adds it, such as a fitted model's (``training.scorer``)."""
    return score_tree_ensemble(rows, model) if isinstance(model, Ensemble) else model(rows)


def score_features(
    features: DataFrame, users: DataFrame, items: DataFrame, model: Ensemble | Scorer = STARTER,
    hot_rows: int | None = None,
) -> DataFrame:
    """Enrich window features and add predict, popularity and final score."""
    enriched = join_item_popularity(join_user_features(features, users, hot_rows), items, hot_rows)
    scored = predict(enriched, model)
    return scored.withColumn("final_score", final_score(F.col("predict_score"), F.col("popularity_score")))


def best_predictions(
    windows: DataFrame, users: DataFrame, model: Ensemble | Scorer = STARTER, hot_rows: int | None = None
) -> DataFrame:
    """Highest P(buy) per (user, item) and when the pair was first scored."""
    scored = predict(join_user_features(windows, users, hot_rows), model)
    return scored.groupBy("user_id", "item_id").agg(
        F.max("predict_score").alias("predict_score"), F.min("window_end").alias("create_time")
    )


def recommend(
    behaviors: DataFrame,
    users: DataFrame,
    items: DataFrame,
    model: Ensemble | Scorer = STARTER,
    size: str = S.WINDOW_SIZE,
    slide: str = S.WINDOW_SLIDE,
    k: int = S.TOP_K,
    hot_rows: int | None = None,
) -> DataFrame:
    """The recommendations table: each user's k best items over all windows.

    ``create_time`` is the end of the window in which the pair was first scored. An item has one
    popularity here, so a pair's best final score is that of its best prediction: pairs are reduced
    to one row before popularity is joined and the final score is worked out.
    """
    windows = win_sliding_features(with_event_time(behaviors), size, slide)
    pairs = join_item_popularity(best_predictions(windows, users, model, hot_rows), items, hot_rows)
    scored = pairs.withColumn("final_score", final_score(F.col("predict_score"), F.col("popularity_score")))
    return top_per_user(scored, k).select(
        "user_id", "item_id", "predict_score", "popularity_score", "final_score", "rank_no",
        F.lit("realtime").alias("recommend_type"), "create_time",
    )
