"""Offline and online quality measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.functions.numeric import safe_ratio
from pathlark.operators.joins import semi_rec
from pathlark.session import stored

CUT_LEVELS = 10  # the running sums are split into 2**10 score ranges


def score_summary(scored: DataFrame, score: str = "predict_score") -> DataFrame:
    return scored.agg(
        F.min(score).alias("min_score"), F.max(score).alias("max_score"), F.avg(score).alias("mean_score")
    )


# --- average precision ----------------------------------------------------------------------
def score_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Rows and positives per distinct score: all average precision needs to know."""
    return scored.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos")
    )


def _score_ranges(counts: DataFrame, levels: int) -> DataFrame:
    """Number the scores' quantile ranges from the top score down.

    The position among the sorted cuts is found by halving, one small projection per level.
    """
    cuts = 2**levels
    at = [i / cuts for i in range(1, cuts)]
    bounds = counts.agg(F.percentile_approx("s", at, 10_000).alias("b")).scalar()
    found = counts.withColumn("_cuts", bounds).withColumn("_at", F.lit(0))
    for level in reversed(range(levels)):
        step = 2**level
        right = F.get(F.col("_cuts"), F.col("_at") + (step - 1)) <= F.col("s")
        found = found.withColumn("_at", F.when(right, F.col("_at") + step).otherwise(F.col("_at")))
    return found.select("s", "n", "pos", (F.lit(cuts - 1) - F.col("_at")).alias("range"))


def precision_recall_points(counts: DataFrame, levels: int = CUT_LEVELS) -> DataFrame:
    """Running rows and positives from the highest score down, one row per distinct score.

    The running sum is split by score range, so no task sees all scores: quantiles of the distinct
    scores cut them into ``2**levels`` ranges, ranges are summed up one after another (at most one
    row each), and each range adds what lies above it to its own running sum. A range is a function
    of the score alone, so a repeated task gives the same answer.
    """
    ranged = _score_ranges(counts, levels)
    totals = ranged.groupBy("range").agg(F.sum("n").alias("rn"), F.sum("pos").alias("rpos"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("rn").over(before), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("rpos").over(before), F.lit(0)).alias("pos_above"),
    )
    inside = W.partitionBy("range").orderBy(F.desc("s")).rowsBetween(W.unboundedPreceding, 0)
    return ranged.join(F.broadcast(offsets), "range").select(
        "s", "n", "pos",
        (F.sum("n").over(inside) + F.col("n_above")).alias("cum_n"),
        (F.sum("pos").over(inside) + F.col("pos_above")).alias("cum_pos"),
    )


def average_precision(counts: DataFrame, levels: int = CUT_LEVELS) -> DataFrame:
    """Σ (recall step) · precision over descending distinct scores; 0 without positives.

    Equal scores form one step, and nothing is interpolated. The steps add up to Σ pos·precision,
    divided by all positives once at the end. The counts are stored first: the cuts, the range
    totals and the running sums each read them.
    """
    points = precision_recall_points(stored(counts, "score_counts"), levels)
    step = F.col("pos").cast("double") * (F.col("cum_pos").cast("double") / F.col("cum_n").cast("double"))
    out = points.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positive_count"),
        F.coalesce(F.sum(step), F.lit(0.0)).alias("_area"),
    )
    return out.select(
        "row_count", "positive_count", safe_ratio(F.col("_area"), F.col("positive_count")).alias("pr_auc")
    )


def pr_auc_average_precision(
    scored: DataFrame, score: str = "predict_score", label: str = "label", levels: int = CUT_LEVELS
) -> DataFrame:
    return average_precision(score_counts(scored, score, label), levels)


def classification_report(
    scored: DataFrame, score: str = "predict_score", label: str = "label", threshold: float = 0.5
) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    said = (F.col(score) > threshold).cast("int")
    confusion = scored.groupBy(F.col(label).cast("int").alias("y"), said.alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # each cell is a row of its true class and a row of its predicted class
    cells = confusion.select(
        F.explode(F.array(
            F.struct(F.col("y").alias("label"), F.lit(True).alias("is_truth")),
            F.struct(F.col("p").alias("label"), F.lit(False).alias("is_truth")),
        )).alias("c"),
        (F.col("y") == F.col("p")).alias("hit"), "n",
    ).select("c.*", "hit", "n")

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    truth = F.col("is_truth")
    per = cells.groupBy("label").agg(
        total(truth & F.col("hit")).alias("tp"), total(truth).alias("support"), total(~truth).alias("predicted")
    )
    precision, recall = safe_ratio(F.col("tp"), F.col("predicted")), safe_ratio(F.col("tp"), F.col("support"))
    f1 = safe_ratio(F.col("tp") * 2, F.col("support") + F.col("predicted"))
    return per.select(
        "label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
    )


# --- recommendations -----------------------------------------------------------------------
def rec_outcomes(recommendations: DataFrame, behaviors: DataFrame) -> DataFrame:
    """Per recommendation: was the pair viewed / bought strictly after it?

    "Some later behaviour exists" means the pair's last behaviour is later, so behaviours shrink to
    one row per pair before the join and no pair can be heavy in it.
    """
    def last(kind: str):
        return F.max(F.when(F.col("behavior_type") == kind, F.col("create_time")))

    ends = behaviors.filter(F.col("behavior_type").isin("pv", "buy")).groupBy("user_id", "item_id").agg(
        last("pv").alias("last_pv"), last("buy").alias("last_buy")
    )
    joined = recommendations.join(ends, ["user_id", "item_id"], "left")

    def later(column: str):
        return F.coalesce(F.col(column) > F.col("create_time"), F.lit(False))

    return joined.select(
        "user_id", "item_id", "create_time", later("last_pv").alias("viewed"), later("last_buy").alias("bought")
    )


def ctr_cvr_after_rec(recommendations: DataFrame, behaviors: DataFrame) -> DataFrame:
    """Click-through = viewed later / recommended; conversion = bought later / viewed later.

    Buyers need not have viewed, so conversion can exceed 1.
    """
    counts = rec_outcomes(recommendations, behaviors).agg(
        F.count(F.lit(1)).alias("recommend_count"),
        F.count_if("viewed").alias("viewed_count"),
        F.count_if("bought").alias("bought_count"),
    )
    return rates(counts)


def ctr_cvr_naive(recommendations: DataFrame, behaviors: DataFrame) -> DataFrame:
    """The same without looking at time: behaviours before the recommendation count too."""
    def tagged(kind: str):
        return semi_rec(recommendations, behaviors, kind).select(F.lit(kind).alias("k"))

    rows = recommendations.select(F.lit("rec").alias("k")).unionAll(tagged("pv")).unionAll(tagged("buy"))
    counts = rows.agg(
        F.count_if(F.col("k") == "rec").alias("recommend_count"),
        F.count_if(F.col("k") == "pv").alias("viewed_count"),
        F.count_if(F.col("k") == "buy").alias("bought_count"),
    )
    return rates(counts)


def rates(counts: DataFrame) -> DataFrame:
    return counts.select(
        "*",
        safe_ratio(F.col("viewed_count"), F.col("recommend_count")).alias("ctr"),
        safe_ratio(F.col("bought_count"), F.col("viewed_count")).alias("cvr"),
    )


def eval_row(values: DataFrame, start: str, end: str, created: str, row_id: int) -> DataFrame:
    """A row of the metrics table from a one-row result; what was not measured is marked -1."""
    def have(name: str, kind: str):
        column = F.col(name) if name in values.columns else F.lit(S.NOT_MEASURED)
        return F.round(column.cast("double"), 4).cast(kind).alias(name)

    return values.select(
        F.lit(row_id).cast("bigint").alias("id"),
        F.lit(start).cast("timestamp").alias("metric_start_time"),
        F.lit(end).cast("timestamp").alias("metric_end_time"),
        have("pr_auc", "double"), have("ctr", "double"), have("cvr", "double"),
        have("recommend_count", "bigint"),
        F.lit(created).cast("timestamp").alias("create_time"),
    )
