"""Flags and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathlark import schemas as S


def label_buy(behavior_type: Column) -> Column:
    return (behavior_type == "buy").cast("int")


def cart_or_fav(behavior_type: Column) -> Column:
    return behavior_type.isin("cart", "fav").cast("int")


def category_match(item_category: Column, user_category: Column) -> Column:
    return item_category.eqNullSafe(user_category).cast("int")


def behavior_type_desc(behavior_type: Column) -> Column:
    """Display name; an unknown type shows as itself."""
    names = F.create_map(*[F.lit(x) for pair in S.BEHAVIOR_DISPLAY.items() for x in pair])
    return F.coalesce(F.element_at(names, behavior_type), behavior_type)


def popularity_level(score: Column) -> Column:
    """high / medium / low label; a missing score counts as low."""
    return (
        F.when(score >= F.lit(S.HIGH_FROM), F.lit(S.POPULARITY_DISPLAY["high"]))
        .when(score >= F.lit(S.MEDIUM_FROM), F.lit(S.POPULARITY_DISPLAY["medium"]))
        .otherwise(F.lit(S.POPULARITY_DISPLAY["low"]))
    )
