"""Cleaning of raw behaviour lines, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.functions import lines as L
from pathlark.functions.labels import cart_or_fav, label_buy
from pathlark.functions.numeric import behavior_ts
from pathlark.functions.rows import computed_once


def parse_lines(raw: DataFrame, normalize_first: bool = True, line: str = "value") -> DataFrame:
    """Add the typed fields and ``reject_reason`` (NULL when the line is good).

    With ``normalize_first`` a millisecond stamp is repaired before its range is checked; without
    it such a line is out of range, as in a job that filters before it normalises.
    """
    split = raw.withColumn("_f", L.fields(F.col(line)))
    blank = F.coalesce(L.strip(F.col(line)) == "", F.lit(True))
    whole = F.size("_f") == 5  # junk of another shape is not looked at any further

    def part(i: int):
        return F.when(whole, F.get(F.col("_f"), F.lit(i)))

    stamp = L.to_long(part(4))
    once = computed_once(
        split,
        user_id=L.to_long(part(0)),
        item_id=L.to_long(part(1)),
        category_id=L.to_long(part(2)),
        behavior_type=F.lower(L.strip(part(3))),
        behavior_time=L.to_seconds(stamp) if normalize_first else stamp,
        _parts=F.when(blank, 0).otherwise(F.size("_f")),
    )
    reason = L.reject_reason(
        F.col(line), F.col("_parts"), F.col("user_id"), F.col("item_id"),
        F.col("category_id"), F.col("behavior_type"), F.col("behavior_time"),
    )
    return once.withColumn("reject_reason", reason).drop("_f", "_parts")


def clean_valid(raw: DataFrame, normalize_first: bool = True, line: str = "value") -> DataFrame:
    """Typed rows of the good lines."""
    parsed = parse_lines(raw, normalize_first, line)
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", line)


def clean_reject_reasons(raw: DataFrame, normalize_first: bool = True, line: str = "value") -> DataFrame:
    """The rejected lines with their reason, for a quarantine table."""
    parsed = parse_lines(raw, normalize_first, line)
    extra = [c for c in raw.columns if c != line]
    return parsed.filter(F.col("reject_reason").isNotNull()).select(*extra, line, "reject_reason")


def clean_stats(parsed: DataFrame) -> DataFrame:
    """Total, filtered and filtered % (one decimal) of parsed lines."""
    bad = F.count_if(F.col("reject_reason").isNotNull())
    total = F.count(F.lit(1))
    percent = F.when(total > 0, F.round(bad * 100.0 / total, 1)).otherwise(F.lit(0.0))
    return parsed.agg(
        total.alias("total_count"),
        bad.alias("filtered_count"),
        percent.cast("double").alias("filtered_percent"),
    )


def time_normalize(rows: DataFrame, stamp: str = "behavior_time") -> DataFrame:
    return rows.withColumn(stamp, L.to_seconds(F.col(stamp)))


def normalize_lines(raw: DataFrame, line: str = "value") -> DataFrame:
    split = raw.withColumn("_f", L.fields(F.col(line)))
    read = split.withColumn("_t", F.when(F.size("_f") == 5, L.to_long(F.get(F.col("_f"), F.lit(4)))))
    return read.withColumn(line, L.normalized_line(F.col(line), F.col("_f"), F.col("_t"))).drop("_f", "_t")


def valid_rows(rows: DataFrame) -> DataFrame:
    """The line rules for rows that are typed already."""
    return rows.filter(
        (F.col("user_id") > 0)
        & (F.col("item_id") > 0)
        & (F.col("category_id") > 0)
        & F.col("behavior_type").isin(*S.BEHAVIOR_TYPES)
        & F.col("behavior_time").between(S.TS_LOWER, S.TS_UPPER)
    )


def format_lines(rows: DataFrame) -> DataFrame:
    """Behaviour rows as the lines a producer sends."""
    kind = F.lower(F.trim("behavior_type"))
    fields = [kind if c == "behavior_type" else F.col(c).cast("string") for c in S.LINE_FIELDS]
    return rows.select(F.concat_ws(",", *fields).alias("value"))


def filter_pv(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("behavior_type") == "pv").select("item_id", F.lit(1).alias("cnt"))


def history_behavior(rows: DataFrame) -> DataFrame:
    """Behaviours that may feed a feature without leaking the label: no purchases."""
    return rows.filter(F.col("behavior_type").isin("pv", "cart", "fav"))


def with_event_time(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_time", behavior_ts(F.col("behavior_time")))


def with_labels(rows: DataFrame) -> DataFrame:
    kind = F.col("behavior_type")
    return rows.withColumn("label", label_buy(kind)).withColumn("is_cart_or_fav", cart_or_fav(kind))


def dedupe_behavior(rows: DataFrame) -> DataFrame:
    """One row per (user, item, type, time): the one with the smallest id.

    An aggregate rather than ``dropDuplicates``, so copies meet map-side and the survivor does
    not depend on arrival order.
    """
    keys = ["user_id", "item_id", "behavior_type", "behavior_time"]
    rest = [c for c in rows.columns if c not in keys and c != "id"]
    best = rows.groupBy(*keys).agg(F.min("id").alias("id"), *[F.min_by(c, "id").alias(c) for c in rest])
    return best.select(*rows.columns)
