"""Joins of behaviours, features and recommendations.

Sizes decide the join: no side is broadcast by hint unless it is bounded by construction. For the
rest AQE broadcasts a side it has measured to be small, and splits skewed partitions. Keys known
to be heavy can also be salted (``hot_rows``), which needs no run-time statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.functions.labels import category_match


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """``left`` ⋈ ``right`` where single keys of ``left`` may hold a large share of its rows.

    Keys with at least ``hot_rows`` left rows get their rows spread over as many tasks as hold about
    ``hot_rows`` each (``salts`` fixes that number instead) and their right rows repeated that often; all
    other keys join once, as usual. There are at most rows / ``hot_rows`` such keys; whether their list is
    broadcast is decided by its measured size. The salt is a hash of the row, so a task that is run again
    sends every row to the same place. ``how`` is inner, left, left_semi or left_anti (a salted right row
    may not be emitted on its own).
    """
    on = list(on)
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"cannot salt a {how} join")
    if not hot_rows:
        return left.join(right, on, how)
    wanted = F.lit(salts) if salts else F.ceil(F.col("_n") / hot_rows).cast("int")
    hot = (
        left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= hot_rows).select(*on, wanted.alias("_salts"))
    )
    salted_left = left.join(hot, on, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    salted_right = right.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0))))).drop("_salts")
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


# --- enrichment ---------------------------------------------------------------------------
def join_user_features(rows: DataFrame, users: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Add buy_rate, active_score and category_match; unknown users get cold-start values."""
    known = users.select("user_id", "buy_rate", "active_score", "high_freq_category")
    joined = skew_join(rows, known, ["user_id"], "left", hot_rows)
    favourite = F.coalesce("high_freq_category", "category_id")
    return joined.select(
        *rows.columns,
        F.coalesce("buy_rate", F.lit(S.DEFAULT_BUY_RATE).cast(S.SCORE4)).cast(S.SCORE4).alias("buy_rate"),
        F.coalesce("active_score", F.lit(S.DEFAULT_ACTIVE_SCORE).cast(S.SCORE4)).cast(S.SCORE4).alias("active_score"),
        favourite.alias("high_freq_category"),
        category_match(F.col("category_id"), favourite).alias("category_match"),
    )


def join_item_popularity(rows: DataFrame, items: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Add popularity_score; an item without one gets the default."""
    known = items.select("item_id", "popularity_score")
    joined = skew_join(rows, known, ["item_id"], "left", hot_rows)
    default = F.lit(S.DEFAULT_POPULARITY).cast(S.SCORE4)
    return joined.select(
        *rows.columns,
        F.coalesce(F.col("popularity_score").cast(S.SCORE4), default).alias("popularity_score"),
    )


def join_training_samples(
    behaviors: DataFrame, users: DataFrame, items: DataFrame, hot_rows: int | None = None
) -> DataFrame:
    """Behaviours of known users on known items, row by row, with both feature sets."""
    u = users.select("user_id", "buy_rate", "active_score", "high_freq_category")
    i = items.select("item_id", F.col("category_id").alias("item_category"))
    with_users = skew_join(behaviors, u, ["user_id"], "inner", hot_rows)
    return skew_join(with_users, i, ["item_id"], "inner", hot_rows)


def join_exclude_cold_users(rows: DataFrame, users: DataFrame, hot_rows: int | None = None) -> DataFrame:
    known = users.select("user_id", "buy_rate", "active_score", "high_freq_category")
    return skew_join(rows, known, ["user_id"], "inner", hot_rows)


def count_cold_rows(rows: DataFrame, users: DataFrame) -> DataFrame:
    """How many rows belong to users without features. Rows are counted per user first."""
    per_user = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    cold = per_user.join(users.select("user_id"), "user_id", "left_anti")
    return cold.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("excluded_count"))


def distinct_pairs(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", "item_id").distinct()


def join_pairs_interactions(rows: DataFrame, interactions: DataFrame) -> DataFrame:
    """Distinct (user, item) pairs of ``rows`` with their history; none counts as zero.

    Both sides hold one row per pair, so no key can be heavy.
    """
    return distinct_pairs(rows).join(interactions, ["user_id", "item_id"], "left").fillna(
        0, subset=["pv_count_5min", "is_cart_or_fav"]
    )


# --- recommendations against what users did ------------------------------------------------
def join_rec_then_behavior(recs: DataFrame, behaviors: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Each recommendation with each later behaviour of the same user on the same item."""
    r = recs.select("user_id", "item_id", F.col("create_time").alias("rec_time"))
    b = behaviors.select(
        "user_id", "item_id", "behavior_type", F.col("create_time").alias("behavior_at")
    )
    # Behaviours are the long side of a pair, so they are the side that may be spread.
    return skew_join(b, r, ["user_id", "item_id"], "inner", hot_rows).filter(
        F.col("behavior_at") > F.col("rec_time")
    )


def semi_rec(recs: DataFrame, behaviors: DataFrame, kind: str) -> DataFrame:
    """Recommendations whose pair occurs among behaviours of ``kind``, whenever that was."""
    pairs = distinct_pairs(behaviors.filter(F.col("behavior_type") == kind))
    return recs.join(pairs, ["user_id", "item_id"], "left_semi")


def join_before_after(recs: DataFrame, behaviors: DataFrame) -> DataFrame:
    """Matches up to and after each recommendation, with their shares in percent.

    Behaviours are first counted per pair and stamp: copies do not reach the join.
    """
    r = recs.select("user_id", "item_id", F.col("create_time").alias("rec_time"))
    b = behaviors.groupBy("user_id", "item_id", "create_time").agg(F.count(F.lit(1)).alias("n"))
    hits = r.join(b, ["user_id", "item_id"])
    after = F.col("create_time") > F.col("rec_time")

    def total(cond=None):
        return F.coalesce(F.sum(F.col("n") if cond is None else F.when(cond, F.col("n"))), F.lit(0))

    out = hits.agg(
        total().alias("matches"), total(~after).alias("before_count"), total(after).alias("after_count")
    )

    def percent(name: str):
        return F.when(F.col("matches") > 0, F.col(name) * 100.0 / F.col("matches")).otherwise(0.0)

    return out.withColumn("before_pct", percent("before_count")).withColumn(
        "after_pct", percent("after_count")
    )
