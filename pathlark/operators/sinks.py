"""Table writes and upkeep.

Recommendations are kept as a change log: every micro-batch overwrites the partition of its own
batch number, so a batch that is run again leaves the same rows, and only what changed is written.
Readers merge the log per key; ``compact`` folds it into a new folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathlark import schemas as S
from pathlark.operators.levels import Levels

REC_KEYS = ("user_id", "item_id", "recommend_type")
_REC_VALUES = ("predict_score", "popularity_score", "final_score", "rank_no")


# --- plain tables -----------------------------------------------------------------------------
def append_behavior(rows: DataFrame, path: str) -> None:
    """Append, one folder per day, so range reads skip days.

    Rows are brought together by day before writing (few files per day), and AQE splits a heavy day
    into several tasks.
    """
    _by_day(rows, "create_time").hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)


def _by_day(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn("day", F.to_date(column))


def append_jdbc(rows: DataFrame, url: str, dbtable: str, batch: int = 500, **options: str) -> None:
    writer = rows.write.format("jdbc").mode("append").option("url", url).option("dbtable", dbtable)
    for key, value in {"batchsize": str(batch), **options}.items():
        writer = writer.option(key, value)
    writer.save()


def replace_table(rows: DataFrame, path: str, keep: int = 2) -> None:
    """Replace a feature table by a full recompute; readers see the old or the new rows, never a mixture.

    Each replacement is a folder of its own; writing it ends with Spark's success marker, and the newest
    folder with one is the table. Folders older than the last ``keep`` are removed, so a reader that
    began before the replacement can finish. The rows may come from the table itself.
    """
    spark = rows.sparkSession
    past = versions(spark, path)
    rows.write.parquet(f"{path.rstrip('/')}/v={(past[-1] if past else 0) + 1:012d}")
    for old in past[: len(past) + 1 - keep]:
        where = _folder(spark, f"{path.rstrip('/')}/v={old:012d}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _folder(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished replacements, in order. A listing of a few folders."""
    found = _folder(spark, f"{path.rstrip('/')}/v=*/_SUCCESS")
    matches = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found)
    return sorted(int(m.getPath().getParent().getName().removeprefix("v=")) for m in matches or [])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest finished replacement."""
    past = versions(spark, path)
    if not past:
        raise FileNotFoundError(f"nothing has been written to {path} yet")
    return spark.read.parquet(f"{path.rstrip('/')}/v={past[-1]:012d}")


def rebuild_table(rows: DataFrame, path: str) -> DataFrame:
    """Replace a table and report rows expected, loaded and failed.

    The expected number is counted while writing, not in a second pass over the source.
    """
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    expected = seen.get["n"]
    loaded = rows.sparkSession.read.schema(rows.schema).parquet(path).agg(F.count(F.lit(1)).alias("loaded"))
    want = F.lit(expected).cast("bigint")
    return loaded.select(
        want.alias("expected"), "loaded", (want - F.col("loaded")).alias("failed")
    )


def append_metrics(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("append").parquet(path)


def export_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


# --- recommendations ---------------------------------------------------------------------------
def write_changes(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of changes; writing the same batch again replaces it."""
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id").parquet(path)
    )


def merge_recommendations(changes: DataFrame, prune_stale: bool = False) -> DataFrame:
    """Current rows of a change log with columns of ``RECOMMENDATIONS`` and ``batch_id``.

    Per (user, item, type): values of the newest batch, creation time of the oldest. An item that
    left a user's list keeps its last rank, unless ``prune_stale`` keeps only the newest batch of
    each user. ``batch_id`` orders the changes; within a batch a key occurs once.
    """
    merged = changes.groupBy(*REC_KEYS).agg(
        *[F.max_by(c, "batch_id").alias(c) for c in _REC_VALUES],
        F.max("batch_id").alias("batch_id"), F.min("create_time").alias("create_time"),
    )
    if prune_stale:
        newest = changes.groupBy("user_id", "recommend_type").agg(F.max("batch_id").alias("_last"))
        merged = merged.join(newest, ["user_id", "recommend_type"]).filter(
            F.col("batch_id") == F.col("_last")
        )
    return merged.select("user_id", "item_id", *_REC_VALUES, "recommend_type", "create_time")


def upsert_once(current: DataFrame, updates: DataFrame, prune_stale: bool = False) -> DataFrame:
    """One upsert of ``updates`` into ``current`` as a plain DataFrame."""
    log = current.withColumn("batch_id", F.lit(0).cast("bigint")).unionByName(
        updates.withColumn("batch_id", F.lit(1).cast("bigint"))
    )
    return merge_recommendations(log, prune_stale)


CHANGES = T.StructType([*S.RECOMMENDATIONS.fields, T.StructField("batch_id", T.LongType())])


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHANGES).parquet(path)


def read_recommendations(spark: SparkSession, path: str, prune_stale: bool = False) -> DataFrame:
    return merge_recommendations(read_changes(spark, path), prune_stale)


def upsert_log(path: str, buckets: int = 256, every: int = 20) -> Levels:
    """Recommendations as a change log whose reads stay cheap. ``read`` gives rows that ``merge_recommendations``
    makes current; ``write`` takes batches as ``write_changes`` does."""
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*REC_KEYS).agg(
            *[F.max_by(c, "batch_id").alias(c) for c in _REC_VALUES],
            F.max("batch_id").alias("batch_id"), F.min("create_time").alias("create_time"),
        ).select(*CHANGES.fieldNames())

    return Levels(path, CHANGES, merge, user_bucket(buckets), every)


def upserted(spark: SparkSession, log: Levels, prune_stale: bool = False, user: int | None = None, buckets: int = 256) -> DataFrame:
    """Current rows of such a log; of one user from one bucket."""
    if user is None:
        return merge_recommendations(log.read(spark), prune_stale)
    own = spark.range(1).select(F.lit(user).cast("bigint").alias("user_id")).select(user_bucket(buckets)).first()[0]
    return merge_recommendations(log.read(spark, own).filter(F.col("user_id") == user), prune_stale)


def compact(spark: SparkSession, path: str, new_path: str, batch_id: int) -> None:
    """Fold the log into ``new_path`` as batch ``batch_id`` (the newest number in the log)."""
    write_changes(read_recommendations(spark, path), new_path, batch_id)


def write_serving(rows: DataFrame, path: str, as_of: Column, buckets: int = 256) -> None:
    """Ranked serving rows, in folders by user hash so that a look-up reads one of them."""
    (
        rows.withColumn("updated_at", as_of)
        .withColumn("user_bucket", user_bucket(buckets))
        .hint("rebalance", "user_bucket")
        .sortWithinPartitions("user_id", "serving_rank")
        .write.mode("overwrite").partitionBy("user_bucket").parquet(path)
    )


def user_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")


def expire_serving(serving: DataFrame, now: Column, life_hours: int = S.SERVING_LIFE_HOURS,
                   spare_hours: int = 1) -> DataFrame:
    """Drop the lists of users with less than an hour left of their life.

    A user's life starts anew with every write to the list, so the newest row decides for all of it. The
    newest stamp is one row per task and user before its shuffle.
    """
    keep = life_hours - spare_hours
    newest = serving.groupBy("user_id").agg(F.max("updated_at").alias("_newest"))
    alive = newest.filter(F.col("_newest") > now - F.expr(f"INTERVAL {keep} HOURS"))
    return serving.join(alive.select("user_id"), "user_id", "left_semi")


def merge_serving(serving: DataFrame, updates: DataFrame, as_of: Column, size: int = S.SERVING_SIZE) -> DataFrame:
    """Served rows after some items got new scores: an item's row is replaced, lists are ranked and cut anew.

    Only the items in ``updates`` get the new stamp; what the stamp means for the list is up to
    ``expire_serving``. Of several rows for an item in ``updates`` the highest final score counts.
    """
    best = updates.groupBy("user_id", "item_id").agg(
        F.max_by("predict_score", F.struct("final_score", "predict_score")).alias("predict_score"), F.max("final_score").alias("final_score"))
    best = best.withColumn("updated_at", as_of)
    columns = ["user_id", "item_id", "predict_score", "final_score", "updated_at"]
    kept = serving.select(*columns).join(best.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    order = Window.partitionBy("user_id").orderBy(F.desc("final_score"), F.asc("item_id"))
    rows = kept.unionByName(best.select(*columns)).withColumn("serving_rank", F.row_number().over(order))
    return rows.filter(F.col("serving_rank") <= size)
