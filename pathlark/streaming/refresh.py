"""Features kept current without state: partial counts of each micro-batch, folded into levelled snapshots.

A batch counts its own rows, one row for each (user, category) and item in it, and adds them to a log whose
levels are merged by adding up. Features are read from one snapshot and a bounded tail of batches, of one user
from one bucket; nothing is kept in a state store, and no batch reads what it does not change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from pathlark.operators.features import agg_item_behavior_counts, item_features_from_counts, user_category_counts, user_features_from_counts
from pathlark.operators.levels import Levels
from pathlark.streaming.jobs import Timing, batch_sink


def _counts(path: str, keys: list[str], added: list[str], largest: list[str], buckets: int, every: int) -> Levels:
    names = [*keys, *largest, *added, "batch_id"]

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(
            *(F.sum(c).alias(c) for c in added), *(F.max(c).alias(c) for c in (*largest, "batch_id"))).select(*names)

    bucket = F.pmod(F.xxhash64(keys[0]), F.lit(buckets))
    return Levels(path, StructType([StructField(c, LongType()) for c in names]), merge, bucket, every)


def user_counts(path: str, buckets: int = 256, every: int = 20) -> Levels:
    return _counts(path, ["user_id", "category_id"], ["n", "pv_count", "buy_count", "cart_count", "fav_count"], [], buckets, every)


def item_counts(path: str, buckets: int = 256, every: int = 20) -> Levels:
    return _counts(path, ["item_id"], ["pv_count", "buy_count"], ["category_id"], buckets, every)


def stream_counts(rows: DataFrame, users: Levels, items: Levels, checkpoint: str, timing: Timing) -> StreamingQuery:
    """Log the partial counts of each micro-batch. A batch that runs again replaces what it logged."""
    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # counted twice
        try:
            users.write(user_category_counts(batch), batch_id)
            items.write(agg_item_behavior_counts(batch), batch_id)
        finally:
            batch.unpersist()

    return batch_sink(rows.select("user_id", "item_id", "category_id", "behavior_type"), step, checkpoint, timing)


def read_features(spark: SparkSession, users: Levels, items: Levels) -> tuple[DataFrame, DataFrame]:
    """Current user and item features."""
    return (user_features_from_counts(users.read(spark).drop("batch_id")), item_features_from_counts(items.read(spark).drop("batch_id")))
