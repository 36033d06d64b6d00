"""Click-through of two streams: recommendations, and what users did within a time bound after them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pathlark.operators.evaluation import rates
from pathlark.operators.sinks import write_changes
from pathlark.streaming.jobs import Timing, batch_sink

RECS = "user_id bigint, item_id bigint, create_time timestamp, batch_id bigint"
MATCHES = "user_id bigint, item_id bigint, rec_time timestamp, viewed boolean, bought boolean, batch_id bigint"


def join_rec_then_behavior_stream(recs: DataFrame, behaviors: DataFrame, bound: str, delay: str) -> DataFrame:
    """Each recommendation with each view or purchase of the same pair that comes after it, by ``bound`` at most.

    Both streams are watermarked by ``delay``. With the bound either side's rows can be given up by time: a
    recommendation once no behaviour in reach can come any more, a behaviour once no earlier
    recommendation can. So state holds about ``bound + delay`` of recommendations and ``delay`` of
    behaviours, however long the streams run.
    """
    r = recs.select("user_id", "item_id", F.col("create_time").alias("rec_time")).withWatermark("rec_time", delay)
    b = behaviors.filter(F.col("behavior_type").isin("pv", "buy")).select(
        F.col("user_id").alias("_user"), F.col("item_id").alias("_item"), "behavior_type", F.col("create_time").alias("behavior_at"),
    ).withWatermark("behavior_at", delay)
    pair = (F.col("user_id") == F.col("_user")) & (F.col("item_id") == F.col("_item"))
    after = (F.col("behavior_at") > F.col("rec_time")) & (F.col("behavior_at") <= F.col("rec_time") + F.expr(f"INTERVAL {bound}"))
    return r.join(b, pair & after).select("user_id", "item_id", "rec_time", "behavior_type", "behavior_at")


def stream_ctr_cvr(recs: DataFrame, behaviors: DataFrame, path: str, checkpoint: str, timing: Timing,
                   bound: str = "3 days", delay: str = "10 minutes") -> list[StreamingQuery]:
    """Log recommendations, and which of them were viewed or bought, batch by batch.

    A batch adds at most one row for each recommendation it has matches of; run again, it replaces its rows.
    ``read_ctr_cvr`` gives the rates so far at any time.
    """
    def outcomes(batch: DataFrame, batch_id: int) -> None:
        def some(kind: str):
            return F.max(F.col("behavior_type") == kind)

        write_changes(batch.groupBy("user_id", "item_id", "rec_time").agg(
            some("pv").alias("viewed"), some("buy").alias("bought")), f"{path}/matches", batch_id)

    def shown(batch: DataFrame, batch_id: int) -> None:
        write_changes(batch, f"{path}/recs", batch_id)

    matches = join_rec_then_behavior_stream(recs, behaviors, bound, delay)
    return [
        batch_sink(recs.select("user_id", "item_id", "create_time"), shown, f"{checkpoint}/recs", timing),
        batch_sink(matches, outcomes, f"{checkpoint}/matches", timing),
    ]


def read_ctr_cvr(spark: SparkSession, path: str) -> DataFrame:
    """The rates of all recommendations so far, by what followed within the bound. One row."""
    shown = spark.read.schema(RECS).parquet(f"{path}/recs").agg(F.count(F.lit(1)).alias("recommend_count"))
    once = spark.read.schema(MATCHES).parquet(f"{path}/matches").groupBy("user_id", "item_id", "rec_time").agg(
        F.max("viewed").alias("viewed"), F.max("bought").alias("bought"))
    hits = once.agg(F.count_if("viewed").alias("viewed_count"), F.count_if("bought").alias("bought_count"))
    counts = shown.select(F.lit(1).alias("_k"), "*").join(hits.select(F.lit(1).alias("_k"), "*"), "_k").drop("_k")
    return rates(counts)
