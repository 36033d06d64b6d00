"""Structured Streaming jobs. Each wraps the batch functions; only sources and sinks differ."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from pathlark import schemas as S
from pathlark.functions.trees import STARTER, Ensemble
from pathlark.operators.cleaning import clean_valid, parse_lines, with_event_time
from pathlark.operators.features import (
    agg_item_behavior_counts, item_features_from_counts, user_category_counts, user_features_from_counts,
)
from pathlark.operators.ranking import best_per_pair, topk_per_user
from pathlark.operators.sinks import CHANGES, read_changes, write_changes
from pathlark.operators.windows import hot_items_two_phase, watermarked, win_sliding_features
from pathlark.plans.recommend import Scorer, score_features

CLEAN_METRICS = "clean_metrics"
SNAPSHOT_EVERY = 50


@dataclass
class Timing:
    """How a job is triggered and how late a row may be."""

    every: str | None = None  # None: process what is there, then stop
    delay: str = "10 minutes"


def _start(writer, timing: Timing) -> StreamingQuery:
    trigger = {"processingTime": timing.every} if timing.every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def file_sink(rows: DataFrame, path: str, checkpoint: str, timing: Timing, by: list[str] | None = None) -> StreamingQuery:
    """Append to a folder; its commit log makes every batch count once."""
    writer = rows.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return _start(writer.partitionBy(*by) if by else writer, timing)


def batch_sink(rows: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, timing: Timing,
               mode: str = "append") -> StreamingQuery:
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return _start(writer.foreachBatch(step), timing)


def console_sink(rows: DataFrame, order: str, checkpoint: str, timing: Timing, shown: int = 20) -> StreamingQuery:
    """Print the top of every micro-batch. Only the rows shown reach the driver, which the built-in
    console format does not promise."""
    def step(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.orderBy(F.desc(order)).show(shown, truncate=False)

    return batch_sink(rows, step, checkpoint, timing)


def memory_sink(rows: DataFrame, name: str, timing: Timing, mode: str = "append") -> StreamingQuery:
    """For tests: results as a view of the driver."""
    return _start(rows.writeStream.format("memory").queryName(name).outputMode(mode), timing)


# --- cleaning and landing ---------------------------------------------------------------------
def clean_stream(lines: DataFrame, delay: str | None = None) -> DataFrame:
    """Typed rows with an event time; with ``delay`` also a watermark."""
    rows = with_event_time(clean_valid(lines))
    return watermarked(rows, delay) if delay else rows


def dedupe_stream(rows: DataFrame) -> DataFrame:
    """Drop replays of an event that arrive within the watermark; state stays bounded by it."""
    return rows.dropDuplicatesWithinWatermark(["user_id", "item_id", "behavior_type", "behavior_time"])


def stream_land_behavior(lines: DataFrame, path: str, checkpoint: str, timing: Timing) -> StreamingQuery:
    """Append cleaned rows, stamped with their arrival, in one folder per event day."""
    rows = clean_stream(lines)
    landed = rows.select(
        *S.LINE_FIELDS, F.current_timestamp().alias("create_time"), F.to_date("event_time").alias("day")
    )
    return file_sink(landed, path, checkpoint, timing, ["day"])


def observed_lines(lines: DataFrame) -> DataFrame:
    """Parsed lines whose totals appear in every progress report under ``clean_metrics``."""
    parsed = parse_lines(lines)
    return parsed.observe(
        CLEAN_METRICS,
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("filtered_count"),
    )


class CleanTotals(StreamingQueryListener):
    """Adds up the observed totals of running queries on the driver."""

    def __init__(self) -> None:
        self.total = 0
        self.filtered = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(CLEAN_METRICS)
        if row is not None:
            self.total += row["total_count"]
            self.filtered += row["filtered_count"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stream_clean_metrics(lines: DataFrame, path: str, checkpoint: str, timing: Timing) -> StreamingQuery:
    """One row of totals per micro-batch, replaced if the batch runs again."""
    parsed = parse_lines(lines)

    def step(batch: DataFrame, batch_id: int) -> None:
        totals = batch.agg(
            F.count(F.lit(1)).alias("total_count"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("filtered_count"),
        )
        write_changes(totals, path, batch_id)

    return batch_sink(parsed.select("reject_reason"), step, checkpoint, timing)


# --- windows ------------------------------------------------------------------------------------
def stream_features(rows: DataFrame, size: str = S.WINDOW_SIZE, slide: str = S.WINDOW_SLIDE) -> DataFrame:
    """Window features of watermarked rows; a window is emitted once, when it can no longer change."""
    return win_sliding_features(rows, size, slide)


def stream_hot_items(rows: DataFrame, size: int = S.HOT_SIZE_SECONDS, slide: int = S.HOT_SLIDE_SECONDS) -> DataFrame:
    """Hot items of watermarked rows; two chained aggregates, hence append mode."""
    return hot_items_two_phase(rows, size, slide)


# --- features kept up to date -------------------------------------------------------------------
def stream_refresh(rows: DataFrame, users_path: str, items_path: str, checkpoint: str,
                   timing: Timing) -> list[StreamingQuery]:
    """Keep feature counts current without reading the history again.

    The counts live in the state store, and each micro-batch logs only the keys it changed.
    Lifetime counts need every key, so there is no watermark and state grows with users × categories
    and items, not with behaviours.
    """
    def log_to(path: str):
        return lambda batch, batch_id: write_changes(batch, path, batch_id)

    return [
        batch_sink(user_category_counts(rows), log_to(users_path), f"{checkpoint}/users", timing, "update"),
        batch_sink(agg_item_behavior_counts(rows), log_to(items_path), f"{checkpoint}/items", timing, "update"),
    ]


def newest_per_key(log: DataFrame, *keys: str) -> DataFrame:
    """Last logged row of each key; all other columns are numbers."""
    rest = [c for c in log.columns if c not in keys and c != "batch_id"]
    return log.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in rest])


def read_refreshed(spark: SparkSession, users_path: str, items_path: str) -> tuple[DataFrame, DataFrame]:
    """Current user and item features from the logged counts."""
    users = newest_per_key(spark.read.parquet(users_path), "user_id", "category_id")
    items = newest_per_key(spark.read.parquet(items_path), "item_id")
    return user_features_from_counts(users), item_features_from_counts(items)


# --- scoring and ranking -----------------------------------------------------------------------
Tables = Callable[[SparkSession], tuple[DataFrame, DataFrame]]


def stream_score(features: DataFrame, tables: Tables, path: str, checkpoint: str, timing: Timing,
                 model: Ensemble | Scorer = STARTER) -> StreamingQuery:
    """Score closed windows. ``tables`` gives user and item features anew for each micro-batch, so
    a refresh is seen by the next one."""
    def step(batch: DataFrame, batch_id: int) -> None:
        users, items = tables(batch.sparkSession)
        write_changes(score_features(batch, users, items, model), path, batch_id)

    return batch_sink(features, step, checkpoint, timing)


def current_lists(log: DataFrame) -> DataFrame:
    """Each user's newest list in a log of whole lists."""
    newest = log.groupBy("user_id").agg(F.max("batch_id").alias("batch_id"))
    return log.join(newest, ["user_id", "batch_id"], "left_semi")


STAMPS = "user_id bigint, item_id bigint, create_time timestamp, batch_id bigint"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _log_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _first_scored(fresh: DataFrame, path: str, batch_id: int, full: int, every: int) -> DataFrame:
    """When each pair of this batch's users was first scored, also pairs that have left the lists.

    The stamps have a log of their own: a batch adds its pairs, and every ``every``-th one writes one
    row for each pair so far, so that a batch reads back one full set and the changes since.
    """
    spark = fresh.sparkSession
    log = _log_or_empty(spark, path, STAMPS).filter((F.col("batch_id") >= full) & (F.col("batch_id") < batch_id)).drop("batch_id")
    own = fresh.select("user_id", "item_id", "create_time")

    def first(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id", "item_id").agg(F.min("create_time").alias("create_time"))

    write_changes(first(log.unionByName(own)) if batch_id % every == 0 else own, path, batch_id)
    touched = log.join(own.select("user_id").distinct(), "user_id", "left_semi")
    return first(touched.unionByName(own))


def merge_topk(scored: DataFrame, path: str, batch_id: int, k: int = S.TOP_K, time: str = "window_end",
               every: int = SNAPSHOT_EVERY) -> None:
    """Fold one micro-batch of scores into the users' lists and log the changed lists.

    Scores need no more than the k entries of a list: an item's best score never falls, so neither
    does the k-th best, and whatever was pushed out must beat it with a new score to return. When an
    item that returns was first scored is kept in the log of stamps beside the lists. A batch rewrites
    only users it touched; every ``every``-th batch writes all lists, so a batch reads back one full
    set and fewer than ``every`` changes, however long the job has run; which batch that is follows
    from the batch number alone.
    """
    spark = scored.sparkSession
    # read several times below; a micro-batch should run its stateful part once
    fresh = best_per_pair(scored, time).persist()
    full = max(batch_id - 1, 0) // every * every
    stamps = _first_scored(fresh, f"{path.rstrip('/')}-first", batch_id, full, every)
    log = _log_or_empty(spark, path, CHANGES).filter((F.col("batch_id") >= full) & (F.col("batch_id") < batch_id))
    kept = current_lists(log).select(*fresh.columns)
    if batch_id % every:
        kept = kept.join(fresh.select("user_id").distinct(), "user_id", "left_semi")
    best = topk_per_user(kept.unionByName(fresh), k, time="create_time").withColumnRenamed("create_time", "_listed")
    best = best.join(stamps, ["user_id", "item_id"], "left").withColumn("create_time", F.least("_listed", "create_time"))
    rows = best.withColumn("recommend_type", F.lit("realtime")).select(*S.RECOMMENDATIONS.fieldNames())
    try:
        write_changes(rows, path, batch_id)
    finally:
        fresh.unpersist()


def stream_topk(features: DataFrame, tables: Tables, path: str, checkpoint: str, timing: Timing,
                model: Ensemble | Scorer = STARTER, k: int = S.TOP_K) -> StreamingQuery:
    """Closed windows to ranked lists, one merge per micro-batch."""
    def step(batch: DataFrame, batch_id: int) -> None:
        users, items = tables(batch.sparkSession)
        merge_topk(score_features(batch, users, items, model), path, batch_id, k)

    return batch_sink(features, step, checkpoint, timing)


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    return current_lists(read_changes(spark, path)).drop("batch_id")

