"""Best-per-key, top-k and ordered lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.functions.labels import popularity_level


def best_per_pair(scored: DataFrame, time: str | None = None) -> DataFrame:
    """Highest final score ever seen per (user, item); of equals the higher predict score.

    Carries predict and popularity of that row. ``time`` adds ``create_time``: when the pair was
    first scored. An aggregate with a small buffer, so a heavy pair combines map-side.
    """
    kept = ["predict_score", "popularity_score"]
    order = F.struct(F.col("final_score"), F.col("predict_score"), F.col("popularity_score"))
    aggs = [F.max(order).alias("_b")]
    if time:
        aggs.append(F.min(time).alias("create_time"))
    best = scored.groupBy("user_id", "item_id").agg(*aggs)
    extra = ["create_time"] if time else []
    return best.select(
        "user_id", "item_id", *[F.col(f"_b.{c}") for c in kept], F.col("_b.final_score"), *extra
    )


def top_per_user(rows: DataFrame, k: int, rank: str = "rank_no") -> DataFrame:
    """The k highest final scores of each user, ranked from 1; ties go to the smaller item id.

    Spark prunes each task to k rows per user before the shuffle (window group limit), so a user
    with a third of all rows still sends at most k rows per task.
    """
    w = W.partitionBy("user_id").orderBy(F.desc("final_score"), F.asc("item_id"))
    return rows.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def topk_per_user(scored: DataFrame, k: int = S.TOP_K, time: str | None = None) -> DataFrame:
    return top_per_user(best_per_pair(scored, time), k)


def serving_top50(scored: DataFrame, size: int = S.SERVING_SIZE) -> DataFrame:
    """What the serving store keeps: the best ``size`` items of each user with their scores."""
    return top_per_user(best_per_pair(scored), size, "serving_rank").drop("popularity_score")


def latest_recommendations(
    recommendations: DataFrame, user_ids: Column | int | None = None, by: str = "score", k: int = S.TOP_K
) -> DataFrame:
    """Top items of one user (or of all users when none is named).

    ``score``: by final score, ranks counted anew, level taken from the final score.
    ``rank``: by stored rank, level taken from the popularity score.
    """
    rows = recommendations if user_ids is None else recommendations.filter(F.col("user_id") == user_ids)
    if by == "score":
        ranked = top_per_user(rows.drop("rank_no"), k)
        level = popularity_level(F.col("final_score"))
    else:
        w = W.partitionBy("user_id").orderBy("rank_no", "item_id")
        ranked = rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k)
        level = popularity_level(F.col("popularity_score"))
    zero = F.lit(0.0)
    return ranked.select(
        "user_id", "rank_no", "item_id",
        F.coalesce("final_score", zero.cast(S.SCORE12)).alias("final_score"),
        F.coalesce("predict_score", zero).alias("predict_score"),
        level.alias("popularity"),
    )


def served_or_stored(serving: DataFrame, recommendations: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """Each user's latest list: from the serving rows where the user has any, else from the stored ones.

    Served lists are ranked anew by score, stored ones come in their stored order. Serving rows have no popularity
    score; it does not count there.
    """
    rest = recommendations.join(serving.select("user_id").distinct(), "user_id", "left_anti")
    return latest_recommendations(serving, k=k).unionByName(latest_recommendations(rest, by="rank", k=k))
