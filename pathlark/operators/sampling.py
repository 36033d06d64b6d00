"""Exact, repeatable sampling, splitting and re-weighting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathlark.session import stored

RANGE_DIGITS = 5  # hex digits: at most 1,048,576 hash ranges, however many rows there are


def seeded_hash(keys: Sequence[str], seed: int) -> Column:
    """Hex digest of seed and key: uniform, the same on every run, machine and partitioning.

    A null is told apart from its neighbours: it takes a place of its own in the key.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def mark_smallest(
    rows: DataFrame, keys: Sequence[str], wanted: Column, among: Column, seed: int, out: str
) -> DataFrame:
    """Flag exactly N rows of those satisfying ``among``: the ones with the smallest seeded hash.

    ``wanted`` is N as an aggregate over all ``rows``. The N-th smallest hash is found without sorting
    the rows: they are counted per hash range (a table of bounded size), and only the one range the N-th
    falls into, a millionth of the rows, is ranked. The rows themselves then pass a plain comparison.
    Rows that share the hash of the N-th, as repeated keys do, are numbered on (all columns decide, so the
    choice does not depend on row order) until N are flagged.

    The rows are stored with their hash first, since each of these steps reads them; most read the hash alone.
    """
    names = rows.columns
    rows = stored(rows.select("*", F.coalesce(among, F.lit(False)).alias("_in"), seeded_hash(keys, seed).alias("_h")), "hashed")
    inside, digest = F.col("_in"), F.col("_h")
    target = F.coalesce(rows.agg(wanted.cast("bigint").alias("t")).scalar(), F.lit(0))
    hashed = rows.filter(inside).select("_h", F.substring("_h", 1, RANGE_DIGITS).alias("_range"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ranges = (
        hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_left", target - F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )
    cut = ranges.filter((F.col("_left") > 0) & (F.col("_left") <= F.col("_n"))).select("_range", "_left")
    # at most one range satisfies the condition; copies of a key are one row with their number here
    counted = hashed.join(F.broadcast(cut.limit(1)), "_range").groupBy("_range", "_left", "_h").agg(F.count(F.lit(1)).alias("_n"))
    up_to = W.partitionBy("_range").orderBy("_h").rowsBetween(W.unboundedPreceding, -1)
    counted = counted.withColumn("_before", F.coalesce(F.sum("_n").over(up_to), F.lit(0)))
    nth = counted.filter((F.col("_before") < F.col("_left")) & (F.col("_before") + F.col("_n") >= F.col("_left")))
    last = nth.agg(F.max("_h").alias("h")).scalar()
    # digests are hex, so all are above "" (nothing wanted) and below "g" (everything wanted)
    limit = F.coalesce(last, F.when(target <= 0, F.lit("")).otherwise(F.lit("g")))
    # the rows of the N-th key (one, unless keys repeat), numbered in the order of their other columns
    own = inside & (digest == limit)
    room = F.coalesce(nth.agg(F.max(F.col("_left") - F.col("_before")).alias("r")).scalar(), F.lit(0))
    order = W.partitionBy(*keys).orderBy(*(F.col(c) for c in names))
    tied = rows.filter(own).withColumn("_k", F.row_number().over(order)).select(*names, (F.col("_k") <= room).alias(out))
    return rows.filter(~own).select(*names, (inside & (digest < limit)).alias(out)).unionByName(tied)


def downsample_negatives(
    samples: DataFrame, keys: Sequence[str] = ("user_id", "item_id"), label: str = "buy_label",
    ratio: int = 3, seed: int = 42,
) -> DataFrame:
    """All positives and at most ``ratio`` negatives for each: exactly that many if there are more."""
    negative = F.col(label) == 0
    wanted = F.coalesce(F.sum(F.when(F.col(label) == 1, F.lit(ratio))), F.lit(0))
    marked = mark_smallest(samples, keys, wanted, negative, seed, "_keep")
    return marked.filter(F.col("_keep") | (F.col(label) == 1)).drop("_keep")


def union_pos_neg(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """Both sets together. Row order carries no meaning here, so nothing is shuffled for it."""
    return positives.unionByName(negatives)


def train_test_split(
    samples: DataFrame, keys: Sequence[str] = ("user_id", "item_id"), test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: exactly ⌈share·n⌉ rows, chosen by key and seed only."""
    wanted = F.ceil(F.count(F.lit(1)) * F.lit(test_share))
    return mark_smallest(samples, keys, wanted, F.lit(True), seed, "is_test")


def class_balance_weight(samples: DataFrame, label: str = "buy_label", out: str = "weight") -> DataFrame:
    """n / (2 · rows of the class). Both counts are one scalar each, so nothing is joined."""
    def scalar(value: Column) -> Column:
        return samples.agg(value.cast("double").alias("v")).scalar()

    total = scalar(F.count(F.lit(1)))
    positive = scalar(F.count_if(F.col(label) == 1))
    rows = F.when(F.col(label) == 1, positive).otherwise(total - positive)
    return samples.withColumn(out, total / (rows * 2))


def with_folds(samples: DataFrame, keys: Sequence[str] = ("user_id", "item_id"), folds: int = 3,
               seed: int = 42) -> DataFrame:
    """Cross-validation fold per row, by key, so a row keeps its fold in every evaluation."""
    number = F.conv(F.substring(seeded_hash(keys, seed + 1), 1, 8), 16, 10).cast("bigint")
    return samples.withColumn("fold", (number % folds).cast("int"))


def impute_zero(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.fillna(0.0, subset=list(columns))
