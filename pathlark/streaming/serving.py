"""Served lists kept from a stream: a batch rewrites only the buckets of users it touches.

A bucket's lists are a folder of the batch that wrote them and never change. A small manifest, a row for each
bucket, says which batch's folder counts; it is written last, as a version of its own, and the newest finished
one is the table. So a reader that took a manifest reads one state, whatever is being written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pathlark import schemas as S
from pathlark.operators.sinks import merge_serving, user_bucket, versions
from pathlark.session import stored
from pathlark.streaming.jobs import Timing, batch_sink

LISTS = "user_id bigint, item_id bigint, predict_score double, final_score decimal(38,12), updated_at timestamp, serving_rank int"
MANIFEST = "user_bucket int, batch bigint"
#: Newest versions whose folders stay, for readers that began before the last ones were written.
KEPT = 2


def _manifest(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    """Bucket to batch: as many rows as there are buckets at most."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/versions/v={version:012d}").collect()
    return {r["user_bucket"]: r["batch"] for r in rows}


def _lists(spark: SparkSession, path: str, folders: dict[int, int], schema) -> DataFrame:
    paths = [f"{path}/lists/user_bucket={b}/batch={n}" for b, n in sorted(folders.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _kind(rows: DataFrame) -> str:
    return LISTS.replace("decimal(38,12)", rows.schema["final_score"].dataType.simpleString())


def update_serving(updates: DataFrame, path: str, batch_id: int, as_of: Column, buckets: int = 256, size: int = S.SERVING_SIZE) -> int:
    """Give items their new scores and rank the lists of their users anew; returns how many buckets were written.

    Same lists as ``merge_serving`` on all of them. A batch that runs again starts from the manifest before it and
    writes the same folders and manifest.
    """
    spark = updates.sparkSession
    fresh = stored(updates.select("user_id", "item_id", "predict_score", "final_score", user_bucket(buckets).alias("user_bucket")), "updates")
    touched = [r[0] for r in fresh.select("user_bucket").distinct().collect()]
    if not touched:
        return 0
    past = [v for v in versions(spark, f"{path}/versions") if v <= batch_id]
    now = _manifest(spark, path, past[-1]) if past else {}
    kept = _lists(spark, path, {b: now[b] for b in touched if b in now}, _kind(fresh))
    merged = merge_serving(kept, fresh.drop("user_bucket"), as_of, size)
    merged = merged.withColumn("user_bucket", user_bucket(buckets)).withColumn("batch", F.lit(batch_id).cast("bigint"))
    merged.hint("rebalance", "user_bucket").sortWithinPartitions("user_id", "serving_rank").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("user_bucket", "batch").parquet(f"{path}/lists")
    now.update(dict.fromkeys(touched, batch_id))
    version = f"{path}/versions/v={batch_id + 1:012d}"
    spark.createDataFrame(sorted(now.items()), MANIFEST).coalesce(1).write.mode("overwrite").parquet(version)
    _remove_old(spark, path, past, now)
    return len(touched)


def _remove_old(spark: SparkSession, path: str, past: list[int], now: dict[int, int]) -> None:
    """Folders that the version going out of the kept ones names and no kept one does."""
    if len(past) < KEPT:
        return
    needed = set(now.items())
    for v in past[len(past) - KEPT + 1 :]:
        needed |= set(_manifest(spark, path, v).items())
    out = f"{path}/versions/v={past[-KEPT]:012d}"
    gone = [f"{path}/lists/user_bucket={b}/batch={n}" for b, n in set(_manifest(spark, path, past[-KEPT]).items()) - needed]
    for folder in (*gone, out):
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read_serving(spark: SparkSession, path: str, score: str = "decimal(38,12)") -> DataFrame:
    """All lists of the newest finished version; ``score`` is the type of the final scores."""
    past = versions(spark, f"{path}/versions")
    if not past:
        raise FileNotFoundError(f"nothing has been served at {path} yet")
    return _lists(spark, path, _manifest(spark, path, past[-1]), LISTS.replace("decimal(38,12)", score))


def read_user(spark: SparkSession, path: str, user: int, buckets: int = 256, score: str = "decimal(38,12)") -> DataFrame:
    """One user's list: the folder of one bucket is read."""
    own = spark.range(1).select(F.lit(user).cast("bigint").alias("user_id")).select(user_bucket(buckets)).first()[0]
    folders = _manifest(spark, path, versions(spark, f"{path}/versions")[-1])
    lists = _lists(spark, path, {b: n for b, n in folders.items() if b == own}, LISTS.replace("decimal(38,12)", score))
    return lists.filter(F.col("user_id") == user)


def stream_serving(scored: DataFrame, path: str, checkpoint: str, timing: Timing, as_of: Column | None = None,
                   buckets: int = 256, size: int = S.SERVING_SIZE) -> StreamingQuery:
    """Keep served lists from a stream of scores. A list's life starts anew with each write to it."""
    stamp = as_of if as_of is not None else F.current_timestamp()
    return batch_sink(scored, lambda batch, n: update_serving(batch, path, n, stamp, buckets, size), checkpoint, timing)
