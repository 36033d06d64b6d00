"""Behaviour lines from a topic or a folder, and rows from CSV files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark import schemas as S


# --- streams of raw lines -----------------------------------------------------------------
def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str = "latest",
    per_trigger: int | None = None,
) -> DataFrame:
    """Values of a topic as text. Needs the Kafka connector package on the cluster."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def stream_folder(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Text files arriving in a folder: the same plan as the topic, for tests and replays."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def write_topic(lines: DataFrame, servers: str, topic: str) -> None:
    """Send lines to a topic. Needs the Kafka connector package on the cluster."""
    (
        lines.select("value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )


# --- CSV ----------------------------------------------------------------------------------
def _text_csv(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """All columns as text. Only the header is looked at up front, to check the columns."""
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*required)


def _number(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)).try_cast("double"), F.lit(0.0))


def _whole(name: str) -> Column:
    """Whole numbers keep all their digits; ``12.7`` becomes 12; what is no number becomes 0."""
    text = F.trim(F.col(name))
    exact = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
    loose = F.coalesce(text.try_cast("double"), F.lit(0.0)).try_cast("bigint")
    return F.coalesce(exact, loose, F.lit(0).cast("bigint")).alias(name)


def coerce_behaviors(text: DataFrame, create_time: Column) -> DataFrame:
    """Text columns to behaviour rows; rows without a user or an item are dropped."""
    rows = text.select(
        _whole("user_id"), _whole("item_id"), _whole("category_id"),
        "behavior_type", _whole("behavior_time"),
    )
    kept = rows.filter((F.col("user_id") != 0) & (F.col("item_id") != 0))
    return kept.withColumn("create_time", create_time)


def coerce_user_features(text: DataFrame, update_time: Column, order: str) -> DataFrame:
    """Text columns to user features, one row per user: the first in ``order``.

    "First" is a ``min`` over a struct led by the order column, so copies of one user are
    reduced map-side and never gathered.
    """
    whole = ["pv_count", "buy_count", "cart_count", "fav_count", "high_freq_category"]
    rows = text.select(
        F.col(order).alias("_order"), _whole("user_id"), *[_whole(c) for c in whole],
        _number("buy_rate").alias("buy_rate"), _number("active_score").alias("active_score"),
    ).filter(F.col("user_id") != 0)
    rest = ["_order", *whole, "buy_rate", "active_score"]
    first = rows.groupBy("user_id").agg(F.min(F.struct(*rest)).alias("_r"))
    return first.select(
        "user_id",
        *[F.col(f"_r.{c}") for c in whole[:4]],
        F.col("_r.buy_rate"), F.col("_r.active_score"), F.col("_r.high_freq_category"),
    ).withColumn("update_time", update_time)


def read_csv_behavior(spark: SparkSession, path: str, create_time: Column) -> DataFrame:
    return coerce_behaviors(_text_csv(spark, path, S.CSV_BEHAVIOR_COLUMNS), create_time)


def read_csv_user_features(spark: SparkSession, path: str, update_time: Column) -> DataFrame:
    """Source order is file name, then place in the file."""
    text = _text_csv(spark, path, S.CSV_USER_FEATURE_COLUMNS)
    place = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    return coerce_user_features(text.withColumn("_place", place), update_time, "_place")


MAX_COLUMNS = 64


def read_headered_or_not(
    spark: SparkSession, path: str, columns: Sequence[str] = S.LINE_FIELDS
) -> DataFrame:
    """Behaviour CSV files with or without a header line, each file by itself.

    A line naming a user column and not starting with a number is a header; it gives the order of that
    file's fields, and no file is opened on the driver to find out. Files without one have ``columns``.
    """
    text = spark.read.text(path).withColumn("_file", F.col("_metadata.file_path"))
    return split_headered_or_not(text, columns, file="_file")


def is_header(line: Column) -> Column:
    return F.lower(line).contains("user") & ~line.rlike(r"^\s*[+-]?[0-9\"]*[0-9]")


def split_headered_or_not(
    text: DataFrame, columns: Sequence[str] = S.LINE_FIELDS, line: str = "value", file: str | None = None
) -> DataFrame:
    """Typed rows of such lines; ``file`` names the column that tells files apart (none: all are one).

    A header without a required column fails the job, as nothing could be read from that file; category
    may be missing. So does a header of more than ``MAX_COLUMNS`` names; in files without one the fields that
    count come first. The first header of a file counts, others are skipped like blank lines.
    """
    value = F.col(line)
    rows = text.select(value.alias("_line"), (F.col(file) if file else F.lit("")).alias("_file")).filter(F.trim("_line") != "")
    kind = "struct<" + ",".join(f"c{i}:string" for i in range(MAX_COLUMNS + 1)) + ">"
    fields = F.from_csv("_line", kind, {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    cells = F.array(*(fields[f"c{i}"] for i in range(MAX_COLUMNS)))
    too_wide = F.raise_error(F.lit(f"a header names more than {MAX_COLUMNS} columns")).cast("array<string>")
    named_cells = F.when(fields[f"c{MAX_COLUMNS}"].isNotNull(), too_wide).otherwise(cells)
    headers = rows.filter(is_header(F.col("_line"))).withColumn("_names", F.transform(
        named_cells, lambda c: F.when(F.lower(c) == "timestamp", "behavior_time").otherwise(F.coalesce(F.lower(c), F.lit("")))))
    headers = headers.groupBy("_file").agg(F.min("_names").alias("_names"))  # a row per file
    body = rows.filter(~is_header(F.col("_line"))).withColumn("_cells", cells).join(headers, "_file", "left")
    required = [c for c in columns if c != "category_id"]
    lacking = F.filter(F.array(*map(F.lit, required)), lambda c: ~F.array_contains("_names", c))
    fails = F.raise_error(F.concat(F.lit("missing required columns: "), F.array_join(lacking, ", ")))
    place = {name: i for i, name in enumerate(columns)}

    def part(name: str) -> Column:
        named = F.get("_cells", F.array_position("_names", name).cast("int") - 1)
        plain = F.get("_cells", F.lit(place[name])) if name in place else F.lit(None).cast("string")
        return F.trim(F.when(F.col("_names").isNull(), plain).when(F.size(lacking) > 0, fails.cast("string"))
                      .when(F.array_contains("_names", name), named))

    def number(name: str) -> Column:
        exact = F.when(part(name).rlike(r"^[+-]?[0-9]+$"), part(name).try_cast("bigint"))
        return F.coalesce(exact, part(name).try_cast("double").try_cast("bigint"))  # 12.0 is 12

    return body.select(
        number("user_id").alias("user_id"),
        number("item_id").alias("item_id"),
        F.coalesce(number("category_id"), F.lit(0).cast("bigint")).alias("category_id"),
        F.lower(part("behavior_type")).alias("behavior_type"),
        number("behavior_time").alias("behavior_time"),
    )


# --- tables -------------------------------------------------------------------------------
def in_range(rows: DataFrame, start: str, end: str, column: str = "create_time") -> DataFrame:
    """Rows with a stamp in [start, end], both ends included; the filter reaches the scan."""
    return rows.filter(F.col(column).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def read_table_range(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    return in_range(spark.read.parquet(path), start, end)


def read_jdbc(
    spark: SparkSession, url: str, dbtable: str, partition_column: str | None = None,
    lower: int = 0, upper: int = 0, partitions: int = 1, **options: str,
) -> DataFrame:
    """A database table; with a partition column it is read by many tasks."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable)
    for key, value in options.items():
        reader = reader.option(key, value)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions)
        )
    return reader.load()
