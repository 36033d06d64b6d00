"""Per-user, per-item and per-pair features, and whole-table summaries.

All are plain ``groupBy().agg()``: Spark combines map-side, so a key holding a large share of the
rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.functions.labels import cart_or_fav, category_match, label_buy
from pathlark.functions.numeric import active_score, clip_pv, half_up_ratio, popularity


def count_kind(name: str) -> Column:
    return F.count_if(F.col("behavior_type") == name)


def _four(suffix: str = "_count") -> list[Column]:
    return [count_kind(n).alias(f"{n}{suffix}") for n in ("pv", "buy", "cart", "fav")]


# --- per user, per item -------------------------------------------------------------------
def agg_user_behavior_counts(behaviors: DataFrame) -> DataFrame:
    return behaviors.groupBy("user_id").agg(*_four())


def agg_item_behavior_counts(behaviors: DataFrame) -> DataFrame:
    return behaviors.groupBy("item_id").agg(
        F.max("category_id").alias("category_id"),
        count_kind("pv").alias("pv_count"),
        count_kind("buy").alias("buy_count"),
    )


def _per_user_category(behaviors: DataFrame) -> DataFrame:
    return behaviors.groupBy("user_id", "category_id").agg(F.count(F.lit(1)).alias("n"), *_four())


def _favourite() -> Column:
    """Category with most behaviours; of equals, the smallest id."""
    return F.max_by("category_id", F.struct(F.col("n"), -F.col("category_id")))


def user_high_freq_category(behaviors: DataFrame) -> DataFrame:
    """An aggregate, not a window: nobody's categories are gathered and sorted."""
    counts = behaviors.groupBy("user_id", "category_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("user_id").agg(_favourite().alias("category_id"))


def user_category_counts(behaviors: DataFrame) -> DataFrame:
    """Counts per (user, category): all that user features are made of, and small enough to keep."""
    return _per_user_category(behaviors)


def user_features_from_counts(counts: DataFrame, as_of: Column | None = None) -> DataFrame:
    names = ["pv_count", "buy_count", "cart_count", "fav_count"]
    per_user = counts.groupBy("user_id").agg(
        *[F.sum(n).alias(n) for n in names],
        F.coalesce(_favourite(), F.lit(0).cast("bigint")).alias("high_freq_category"),
    )
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    out = per_user.select(
        "user_id", *names,
        half_up_ratio(F.col("buy_count"), F.col("pv_count")).alias("buy_rate"),
        active_score(total).alias("active_score"),
        "high_freq_category",
    )
    return out if as_of is None else out.withColumn("update_time", as_of)


def user_features(behaviors: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Counts, buy rate, activity and favourite category, in one pass over the behaviours."""
    return user_features_from_counts(user_category_counts(behaviors), as_of)


def item_features_from_counts(counts: DataFrame, as_of: Column | None = None) -> DataFrame:
    out = counts.withColumn("popularity_score", popularity(F.col("pv_count"), F.col("buy_count")))
    return out if as_of is None else out.withColumn("update_time", as_of)


def item_features(behaviors: DataFrame, as_of: Column | None = None) -> DataFrame:
    return item_features_from_counts(agg_item_behavior_counts(behaviors), as_of)


# --- per pair ------------------------------------------------------------------------------
def agg_interactions(history: DataFrame) -> DataFrame:
    """Interaction count (at most 20) and cart-or-fav flag per pair; ``history`` has no buys."""
    return history.groupBy("user_id", "item_id").agg(
        clip_pv(F.count(F.lit(1))).alias("pv_count_5min"),
        F.max(cart_or_fav(F.col("behavior_type"))).alias("is_cart_or_fav"),
    )


def agg_training_samples(behaviors: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """One training sample per (user, item): five features and the label.

    Behaviours shrink to one row per pair before they meet the feature tables. Both tables hold one
    row per key, so this equals joining first and grouping afterwards, and a heavy pair, user or
    item never travels as raw rows.
    """
    pairs = behaviors.groupBy("user_id", "item_id").agg(
        clip_pv(F.count(F.lit(1))).alias("pv_count_5min"),
        F.max(cart_or_fav(F.col("behavior_type"))).alias("is_cart_or_fav"),
        F.max(label_buy(F.col("behavior_type"))).alias("buy_label"),
    )
    u = users.select("user_id", "buy_rate", "active_score", "high_freq_category")
    i = items.select("item_id", "category_id")
    return pairs.join(u, "user_id").join(i, "item_id").select(
        "user_id", "item_id", "buy_rate", "active_score", "pv_count_5min", "is_cart_or_fav",
        category_match(F.col("category_id"), F.col("high_freq_category")).alias("category_match"),
        "buy_label",
    )


def project_features(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The model inputs as doubles, in model order, missing values as 0."""
    return rows.select(
        *keep,
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in S.MODEL_FEATURES],
    )


# --- whole-table summaries -------------------------------------------------------------------
def behavior_distribution(behaviors: DataFrame) -> DataFrame:
    return behaviors.agg(*[count_kind(n).alias(n) for n in S.BEHAVIOR_TYPES])


def behavior_funnel(behaviors: DataFrame) -> DataFrame:
    """Stage counts and step rates in percent; a step out of an empty stage has rate 0."""
    counts = behavior_distribution(behaviors)

    def rate(num: str, den: str) -> Column:
        whole = half_up_ratio(F.col(num), F.col(den)) * F.lit(100).cast("decimal(3,0)")
        return F.when(F.col("pv") > 0, whole.cast(S.RATIO)).otherwise(F.lit(0).cast(S.RATIO))

    return counts.select(
        *S.BEHAVIOR_TYPES,
        rate("cart", "pv").alias("pv_to_cart"),
        rate("fav", "cart").alias("cart_to_fav"),
        rate("buy", "fav").alias("fav_to_buy"),
        rate("buy", "pv").alias("pv_to_buy"),
    )


def behavior_share(behaviors: DataFrame) -> DataFrame:
    """Each stage as percent of all four, two decimals; one row per stage."""
    counts = behavior_distribution(behaviors)
    total = sum((F.col(n) for n in S.BEHAVIOR_TYPES[1:]), F.col(S.BEHAVIOR_TYPES[0]))
    rows = counts.withColumn("_total", F.greatest(total, F.lit(1))).select(
        "_total",
        F.explode(F.array(*[
            F.struct(F.lit(n).alias("behavior_type"), F.col(n).alias("cnt")) for n in S.BEHAVIOR_TYPES
        ])).alias("s"),
    )
    percent = half_up_ratio(F.col("s.cnt"), F.col("_total")) * F.lit(100).cast("decimal(3,0)")
    return rows.select("s.behavior_type", "s.cnt", percent.cast("decimal(18,2)").alias("share_pct"))


def behavior_type_counts(behaviors: DataFrame) -> DataFrame:
    return behaviors.groupBy("behavior_type").agg(F.count(F.lit(1)).alias("cnt"))


def _avg(name: str) -> Column:
    """Mean of exact values: summed as decimals, divided once."""
    return F.sum(F.col(name)).cast("double") / F.count(F.col(name)).cast("double")


_PROFILE = ("pv_count", "buy_count", "cart_count", "fav_count", "buy_rate", "active_score")


def _averages() -> list[Column]:
    return [
        F.when(F.count(F.col(c)) > 0, _avg(c)).otherwise(F.lit(0.0)).alias(f"avg_{c}") for c in _PROFILE
    ]


def avg_user_profile(users: DataFrame) -> DataFrame:
    return users.agg(*_averages())


def user_feature_summary(users: DataFrame) -> DataFrame:
    return users.agg(F.count(F.lit(1)).alias("total_users"), *_averages())


def dataset_profile(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, positives, distinct users and items.

    The exact distinct counts take one extra shuffle of pre-reduced keys each; ``approximate``
    replaces them by sketches.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        count_kind("buy").alias("positive_count"),
        distinct("user_id").alias("user_count"),
        distinct("item_id").alias("item_count"),
    )


def interaction_coverage(pairs: DataFrame) -> DataFrame:
    """Share of pairs with history (%), mean count, share of cart-or-fav (%)."""
    n = F.count(F.lit(1))
    has = F.count_if(F.col("pv_count_5min") > 0)
    flagged = F.coalesce(F.sum("is_cart_or_fav"), F.lit(0))

    def over(value: Column, times: float) -> Column:
        return F.when(n > 0, value.cast("double") * times / n.cast("double")).otherwise(F.lit(0.0))

    return pairs.agg(
        n.alias("pair_count"), has.alias("has_interaction"), over(has, 100.0).alias("coverage_pct"),
        over(F.coalesce(F.sum("pv_count_5min"), F.lit(0)), 1.0).alias("mean_pv_count"),
        over(flagged, 100.0).alias("cart_or_fav_pct"),
    )


def prediction_stats(recommendations: DataFrame, items: DataFrame) -> DataFrame:
    """Recommendation rows, and items beyond that number (never negative).

    Two counts brought together by a union of two one-row tables.
    """
    counted = recommendations.select(F.lit(1).alias("rec"), F.lit(0).alias("item")).unionAll(
        items.select(F.lit(0).alias("rec"), F.lit(1).alias("item"))
    )
    sums = counted.agg(
        F.coalesce(F.sum("rec"), F.lit(0)).alias("recommend"), F.coalesce(F.sum("item"), F.lit(0)).alias("_items")
    )
    rest = F.greatest(F.col("_items") - F.col("recommend"), F.lit(0).cast("bigint"))
    return sums.select("recommend", rest.alias("not_recommend"))


def recommend_count_trend(recommendations: DataFrame) -> DataFrame:
    """Recommendations per minute, oldest first."""
    minute = F.date_format("create_time", "yyyy-MM-dd HH:mm").alias("minute")
    return recommendations.groupBy(minute).agg(F.count(F.lit(1)).alias("cnt")).orderBy("minute")
