"""Behaviours landed once, however old a replay is.

The key of a behaviour holds its time, so its repeats are all in its own day. Each landed day has a Bloom
filter: blocks of four 64-bit words, a key setting one bit in each word of one block. A batch asks the filters
of its days first; keys that no filter knows are new. Only the others, repeats and false positives, are
looked up among the landed rows, and only in the days that have such keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pathlark import schemas as S
from pathlark.session import stored
from pathlark.streaming.jobs import Timing, batch_sink, exists

KEY = ["user_id", "item_id", "behavior_type", "behavior_time"]
WORDS = 4
#: Keys a block should hold. With 16 about 0.3 % of new keys are looked up in vain.
PER_BLOCK = 16
FILTERS = "block bigint, w0 bigint, w1 bigint, w2 bigint, w3 bigint, day date, batch_id bigint"


def _bit(word: int) -> Column:
    return F.expr(f"shiftleft(1L, int(pmod(xxhash64({', '.join(KEY)}, {word + 1}), 64)))")


def with_bits(rows: DataFrame, blocks: int) -> DataFrame:
    """The day, block and bits of each row's key."""
    day = F.to_date(F.timestamp_seconds("behavior_time"))
    return rows.select("*", day.alias("day"), F.pmod(F.xxhash64(*KEY), F.lit(blocks)).alias("block"),
                       *(_bit(i).alias(f"b{i}") for i in range(WORDS)))


def _of_days(spark: SparkSession, path: str, schema: str, days: list, batch_id: int) -> DataFrame:
    """What earlier batches wrote for these days; folders of other days are not read."""
    if not days or not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path)
    return rows.filter(F.col("day").isin(days) & (F.col("batch_id") < batch_id))


def _write(rows: DataFrame, path: str, batch_id: int) -> None:
    """One folder per day and batch; the same batch again replaces its own."""
    rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(path)


def unseen(batch: DataFrame, path: str, batch_id: int, per_day: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the batch whose key no earlier batch landed, one for each key; and the keys that had to be looked up."""
    spark = batch.sparkSession
    blocks = max(1, per_day // PER_BLOCK)
    keyed = stored(with_bits(batch.dropDuplicates(KEY), blocks), "keyed")
    days = [r["day"] for r in keyed.select("day").distinct().collect()]  # the days a batch touches
    known = _of_days(spark, f"{path}/filters", FILTERS, days, batch_id).groupBy("day", "block").agg(
        *(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))
    hit = reduce(lambda a, b: a & b, (F.col(f"w{i}").bitwiseAND(F.col(f"b{i}")) != 0 for i in range(WORDS)))
    doubtful = stored(keyed.join(known, ["day", "block"]).filter(hit).select("day", *KEY), "doubtful")
    their_days = [r["day"] for r in doubtful.select("day").distinct().collect()]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.select(*KEY).schema)
    landed = _of_days(spark, f"{path}/rows", f"{fields}, day date, batch_id bigint", their_days, batch_id)
    repeats = doubtful.join(landed, ["day", *KEY], "left_semi")
    return keyed.join(repeats, ["day", *KEY], "left_anti"), doubtful


def land_once(batch: DataFrame, path: str, batch_id: int, per_day: int = 1_000_000) -> None:
    """Append rows with a new key, and the filters of their days.

    ``per_day`` is the number of keys a day is expected to have; more make the filters less sharp, and the result
    is exact all the same. A batch that runs again gives the same rows.
    """
    fresh, _ = unseen(batch, path, batch_id, per_day)
    fresh = stored(fresh, "fresh")
    _write(fresh.select(*batch.columns, "day"), f"{path}/rows", batch_id)
    words = fresh.groupBy("day", "block").agg(*(F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)))
    _write(words, f"{path}/filters", batch_id)


def stream_land_once(rows: DataFrame, path: str, checkpoint: str, timing: Timing, per_day: int = 1_000_000) -> StreamingQuery:
    """Land typed rows without repeats of any age. Needs no state, so nothing is given up by time."""
    return batch_sink(rows.select(*S.LINE_FIELDS), lambda batch, n: land_once(batch, path, n, per_day), checkpoint, timing)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").select(*S.LINE_FIELDS)
