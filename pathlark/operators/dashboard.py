"""Look-ups and trends behind the dashboard. Limits here are the feature: short sorted lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.functions.labels import behavior_type_desc
from pathlark.sources.feeds import in_range

_STAMP = "yyyy-MM-dd HH:mm:ss"


def top10_items(items: DataFrame, k: int = 10) -> DataFrame:
    return (
        items.select("item_id", "popularity_score", "pv_count")
        .orderBy(F.desc("popularity_score"), "item_id").limit(k)
    )


def item_list(items: DataFrame, keyword: str | None = None, size: int = 50) -> DataFrame:
    """Most viewed items, optionally those whose id contains ``keyword``."""
    rows = items.select("item_id", "category_id", "pv_count")
    if keyword and keyword.strip():
        rows = rows.filter(F.col("item_id").cast("string").contains(keyword))
    return rows.orderBy(F.desc("pv_count"), "item_id").limit(size)


def recent_behaviors(behaviors: DataFrame, user_id: int, size: int) -> DataFrame:
    """One user's newest rows with display names."""
    return (
        behaviors.filter(F.col("user_id") == user_id)
        .orderBy(F.desc("create_time"), F.desc("id")).limit(size)
        .select(
            "id", "user_id", "item_id", "category_id", "behavior_type", "create_time",
            F.coalesce(F.date_format("create_time", _STAMP), F.lit("")).alias("behavior_time_str"),
            behavior_type_desc(F.col("behavior_type")).alias("behavior_type_desc"),
        )
    )


def category_list(items: DataFrame) -> DataFrame:
    return items.select("category_id").distinct().orderBy("category_id")


def user_list(users: DataFrame) -> DataFrame:
    return users.select("user_id").distinct().orderBy("user_id")


def user_profile(users: DataFrame, wanted: DataFrame) -> DataFrame:
    """Six features for each wanted user, zeros for an unknown one."""
    names = ["pv_count", "buy_count", "cart_count", "fav_count", "buy_rate", "active_score"]
    joined = wanted.select("user_id").join(users.select("user_id", *names), "user_id", "left")
    return joined.select("user_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names])


def pr_auc_trend(metrics: DataFrame, n: int = 6) -> DataFrame:
    """Newest measured values; rows of other evaluations carry the not-measured mark."""
    measured = metrics.filter(F.col("pr_auc").isNotNull() & (F.col("pr_auc") != S.NOT_MEASURED))
    newest = measured.orderBy(F.desc("create_time"), F.desc("id")).limit(n)
    return newest.select("id", "pr_auc", "create_time")


def pr_auc_latest(metrics: DataFrame) -> DataFrame:
    return pr_auc_trend(metrics, 1)


def ctr_cvr_trend(metrics: DataFrame, start: str, end: str, exclude_sentinel: bool = True) -> DataFrame:
    """CTR and CVR of evaluations lying inside [start, end], oldest first."""
    rows = metrics.filter(
        (F.col("metric_start_time") >= F.lit(start).cast("timestamp"))
        & (F.col("metric_end_time") <= F.lit(end).cast("timestamp"))
    )
    if exclude_sentinel:
        rows = rows.filter(F.coalesce("ctr", F.lit(0.0)) != S.NOT_MEASURED)
    return rows.orderBy("create_time", "id").select(
        "id",
        F.coalesce(F.date_format("create_time", _STAMP), F.lit("")).alias("time"),
        F.coalesce("ctr", F.lit(0.0)).alias("ctr"),
        F.coalesce("cvr", F.lit(0.0)).alias("cvr"),
    )


def ctr_cvr_lookup(metrics: DataFrame, recommendations: DataFrame, start: str, end: str) -> DataFrame:
    """Newest evaluation of exactly this range, 0 when there is none, next to a fresh count of the
    range's recommendations. One row; the two one-row results meet in an aggregate."""
    s, e = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    found = metrics.filter((F.col("metric_start_time") == s) & (F.col("metric_end_time") == e))
    none = F.lit(None)
    newest = found.agg(F.max_by(F.struct("ctr", "cvr"), "id").alias("m")).select(
        F.col("m.ctr").alias("ctr"), F.col("m.cvr").alias("cvr"), none.cast("bigint").alias("n")
    )
    counted = in_range(recommendations, start, end).agg(F.count(F.lit(1)).alias("n")).select(
        none.cast("double").alias("ctr"), none.cast("double").alias("cvr"), "n"
    )
    return newest.unionByName(counted).agg(
        F.coalesce(F.max("ctr"), F.lit(0.0)).alias("ctr"),
        F.coalesce(F.max("cvr"), F.lit(0.0)).alias("cvr"),
        F.max("n").alias("recommend_count"),
    ).select("ctr", "cvr", "recommend_count", F.lit(start).alias("start_time"), F.lit(end).alias("end_time"))


def stamp(column: str) -> Column:
    return F.date_format(column, _STAMP)
