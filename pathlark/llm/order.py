"""Positions in a total order, without a sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathlark.llm.common import partitions_of
from pathlark.session import stored


def numbered(rows: DataFrame, group: str, order: list, name: str = "numbered") -> DataFrame:
    """Adds ``pos``, each row's place from 0 in its group under ``order``, and ``total``, the group's rows.

    Rows are dealt by ranges of (group, order), so a group of any size spreads over the tasks; a row's place is
    its place in its range, plus the sizes of the group's ranges before. The sizes are one row for each range and
    group in it. ``group`` names a column without nulls. Rows equal in group and order come in any order among
    themselves; the place written with a row stays its place, whichever task reads it again.
    """
    parts = partitions_of(rows.sparkSession)
    dealt = rows.repartitionByRange(parts, F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the row's number in its partition
    dealt = stored(dealt.select("*", F.spark_partition_id().alias("_range"), at.alias("_at")), name)
    own = Window.partitionBy(group)
    sizes = dealt.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(
        group, "_range", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(own).alias("total"))
    return dealt.join(sizes, [group, "_range"]).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "total")
