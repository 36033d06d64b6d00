"""Scheduled batch: recompute and replace the feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from pathlark.operators.features import item_features, user_features
from pathlark.operators.sinks import replace_table


def refresh_features(behaviors: DataFrame, users_path: str, items_path: str, as_of: Column) -> None:
    """User features first, then item features; both from the whole behaviour table."""
    replace_table(user_features(behaviors, as_of), users_path)
    replace_table(item_features(behaviors, as_of), items_path)
