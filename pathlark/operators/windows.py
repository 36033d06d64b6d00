"""Sliding-window features; the same functions serve batch tables and streams.

Windows are in event time and aligned to the epoch. On a stream give the rows a watermark first.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.functions.labels import cart_or_fav


def newest_first(seconds: str, tie: str) -> Column:
    """Order by epoch seconds, of equals the smaller ``tie`` first, as one decimal of full width.

    The upper part holds the stamp, the lower 64 bits the tie-breaker, so no id is cut. A decimal keeps
    the aggregate in the hash table, where a struct would force Spark to sort every row first.
    """
    wide = F.col(seconds).cast("decimal(19,0)") * F.lit(Decimal(2**64))
    return wide + (F.lit(Decimal(2**63 - 1)) - F.col(tie).cast("decimal(19,0)"))


def win_sliding_features(
    rows: DataFrame,
    size: str = S.WINDOW_SIZE,
    slide: str = S.WINDOW_SLIDE,
    time: str = "event_time",
) -> DataFrame:
    """Per (window, user, item): count of all behaviours, cart-or-fav flag, newest category."""
    newest = F.max_by("category_id", newest_first("behavior_time", "category_id"))
    grouped = rows.groupBy(F.window(time, size, slide), "user_id", "item_id").agg(
        F.count(F.lit(1)).alias("pv_count_5min"),
        F.max(cart_or_fav(F.col("behavior_type"))).alias("is_cart_or_fav"),
        newest.alias("category_id"),
    )
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "user_id", "item_id", "category_id", "pv_count_5min", "is_cart_or_fav",
    )


def _seconds(n: int) -> str:
    return f"{n} seconds"


def hot_items_two_phase(
    rows: DataFrame,
    size_seconds: int = S.HOT_SIZE_SECONDS,
    slide_seconds: int = S.HOT_SLIDE_SECONDS,
    salts: int = S.SALT_SLOTS,
    time: str = "event_time",
) -> DataFrame:
    """Views per item and sliding window, counted in two phases.

    Phase one counts tumbling panes as long as the slide, per salted item. Phase two adds the
    salted panes up over each sliding window. An event is touched once, and only the few pane rows
    are repeated for the windows they fall into; a hot item is spread over ``salts`` keys and over
    its panes. The salt is a hash of the event, so a repeated task gives the same rows.
    """
    if size_seconds % slide_seconds:
        raise ValueError("the window size must be a multiple of the slide")
    views = rows.filter(F.col("behavior_type") == "pv").select("item_id", "user_id", "behavior_time", time)
    salt = F.pmod(F.xxhash64("user_id", "behavior_time"), F.lit(salts)).alias("salt")
    panes = views.groupBy(F.window(time, _seconds(slide_seconds)), salt, "item_id").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    return _sum_panes(panes, size_seconds, slide_seconds)


def _sum_panes(panes: DataFrame, size: int, slide: int) -> DataFrame:
    # window_time is the last instant of a pane, which lies in exactly the windows holding the pane
    hot = panes.groupBy(
        F.window(F.window_time("window"), _seconds(size), _seconds(slide)), "item_id"
    ).agg(F.sum("cnt").alias("pv"))
    return hot.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "item_id", "pv"
    )


def hot_items_unsalted(
    rows: DataFrame,
    size_seconds: int = S.HOT_SIZE_SECONDS,
    slide_seconds: int = S.HOT_SLIDE_SECONDS,
    time: str = "event_time",
) -> DataFrame:
    """The one-phase form, as a yardstick for the salted one."""
    views = rows.filter(F.col("behavior_type") == "pv")
    hot = views.groupBy(F.window(time, _seconds(size_seconds), _seconds(slide_seconds)), "item_id").agg(
        F.count(F.lit(1)).alias("pv")
    )
    return hot.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "item_id", "pv"
    )


def watermarked(rows: DataFrame, delay: str, time: str = "event_time") -> DataFrame:
    """Rows later than ``delay`` behind the newest are dropped and counted in the query progress."""
    return rows.withWatermark(time, delay)
