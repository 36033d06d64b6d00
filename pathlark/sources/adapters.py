"""The test tables seen as behaviours.

``events`` become single-user actions on numbered items; ``orders`` and ``lineitem`` become a
larger history of customers acting on parts. Both give the ``user_behavior`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark.functions.numeric import epoch_of_ntz
from pathlark.functions.rows import computed_once
from pathlark.operators.cleaning import valid_rows

# Fixed values of the mapping.
EVENT_KIND = {"view": "pv", "click": "cart", "signup": "fav", "purchase": "buy", "error": "error"}
ORDER_SHIFT_SECONDS = 9131 * 86400  # 25 years, so that ship dates fall into the valid range

EVENT_COLUMNS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1000) -> DataFrame:
    """``events`` as an unbounded file source (a glob, so one file or a folder will do)."""
    return (
        spark.readStream.schema(EVENT_COLUMNS)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(f"{sf_dir}/event[s].parquet")
    )


def _kind():
    names = F.create_map(*[F.lit(x) for pair in EVENT_KIND.items() for x in pair])
    return F.element_at(names, F.col("event_type"))


def _item_number():
    return F.get_json_object("props", "$.k").try_cast("bigint")


def behaviors_from_events(events: DataFrame) -> DataFrame:
    """Typed rows, ids moved up by one so that none is zero; ``error`` rows are still there."""
    k = F.col("k")
    return computed_once(events, k=_item_number()).select(
        F.col("event_id").alias("id"),
        (F.col("user_id") + 1).alias("user_id"),
        (k + 1).alias("item_id"),
        (k % 10 + 1).alias("category_id"),
        _kind().alias("behavior_type"),
        epoch_of_ntz(F.col("ts")).alias("behavior_time"),
        F.col("ts").cast("timestamp").alias("create_time"),
    )


def lines_from_events(events: DataFrame) -> DataFrame:
    """Raw lines as a careless producer would send them: ids not moved (zeros occur), clicks in
    capitals with blanks and empty fields at the end, sign-ups stamped in milliseconds."""
    k = _item_number()
    seconds = epoch_of_ntz(F.col("ts"))
    head = F.concat_ws(",", F.col("user_id"), k, k % 10)
    line = (
        F.when(F.col("event_type") == "click",
               F.concat(F.lit(" "), head, F.lit(", CART , "), seconds, F.lit(",,")))
        .when(F.col("event_type") == "signup",
              F.concat_ws(",", head, F.lit("fav"), seconds * 1000))
        .otherwise(F.concat_ws(",", head, _kind(), seconds))
    )
    return events.select(F.col("event_id").alias("line_no"), line.alias("value"))


def lines_from_documents(documents: DataFrame) -> DataFrame:
    """Every line of every whole text: junk a feed must survive."""
    lines = F.posexplode(F.split("text", "\n"))
    return documents.select("doc_id", lines.alias("pos", "value")).select(
        F.concat_ws(":", "doc_id", "pos").alias("line_no"), "value"
    )


def event_behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(behaviors_from_events(table(spark, sf_dir, "events")))


def order_behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers acting on parts: open lines are views, finished ones what the flag says."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    flag = F.col("l_returnflag")
    kind = (
        F.when(F.col("l_linestatus") == "O", "pv")
        .when(flag == "R", "cart")
        .when(flag == "A", "fav")
        .otherwise("buy")
    )
    seconds = epoch_of_ntz(F.col("l_shipdate")) + F.lit(ORDER_SHIFT_SECONDS)
    rows = items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        (F.col("o_custkey") + 1).alias("user_id"),
        (F.col("l_partkey") + 1).alias("item_id"),
        (F.col("l_partkey") % 25 + 1).alias("category_id"),
        kind.alias("behavior_type"),
        seconds.alias("behavior_time"),
        F.timestamp_seconds(seconds).alias("create_time"),
    )
    return valid_rows(rows)


def behaviors(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    return {"events": event_behaviors, "orders": order_behaviors}[source](spark, sf_dir)

