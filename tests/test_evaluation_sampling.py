import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from pathlark.operators import evaluation as E
from pathlark.operators import sampling as P
from tests.helpers import rows


def average_precision(pairs):
    pos = sum(y for _, y in pairs)
    area = tp = n = 0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        step = [y for t, y in pairs if t == s]
        n, tp = n + len(step), tp + sum(step)
        area += sum(step) / pos * (tp / n) if pos else 0
    return area


CASES = {
    "continuous": [(random.Random(n).random(), int(random.Random(-n).random() < 0.2)) for n in range(1, 800)],
    "ties": [(n % 7 / 7, int(n % 5 == 0)) for n in range(300)],
    "one score": [(0.5, int(n % 4 == 0)) for n in range(40)],
    "no positives": [(n / 10, 0) for n in range(10)],
    "a third share one score": [(0.1 if n % 3 == 0 else n / 900, int(n % 2)) for n in range(900)],
    "crowded near zero": [(math.exp(-n / 3), int(n % 9 == 0)) for n in range(400)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("levels", [1, 10])
def test_average_precision(spark, name, levels):
    df = spark.createDataFrame(CASES[name], "predict_score DOUBLE, label INT").repartition(5)
    got = E.pr_auc_average_precision(df, levels=levels).first()
    assert got["row_count"] == len(CASES[name]) and got["positive_count"] == sum(y for _, y in CASES[name])
    assert got["pr_auc"] == pytest.approx(average_precision(CASES[name]), abs=1e-12)


def test_nothing_to_evaluate(spark):
    none = spark.createDataFrame([], "predict_score DOUBLE, label INT")
    assert tuple(E.pr_auc_average_precision(none).first()) == (0, 0, 0.0)


def test_running_sums_use_many_tasks(spark):
    df = spark.createDataFrame(CASES["continuous"], "s DOUBLE, y INT")
    points = E.precision_recall_points(E.score_counts(df, "s", "y"), 6)
    ranges = points.groupBy((F.col("cum_n") - F.col("cum_n")).alias("z")).count()
    assert ranges.first()["count"] == points.count()
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "hashpartitioning(range" in plan


def test_classification_report(spark):
    data = [(0.9, 1), (0.8, 0), (0.7, 1), (0.4, 1), (0.3, 0), (0.2, 0)]
    got = rows(E.classification_report(spark.createDataFrame(data, "predict_score DOUBLE, label INT")))
    assert got == [(0, 2 / 3, 2 / 3, 2 / 3, 3), (1, 2 / 3, 2 / 3, 2 / 3, 3)]
    one_sided = spark.createDataFrame([(0.1, 1), (0.2, 0)], "predict_score DOUBLE, label INT")
    assert rows(E.classification_report(one_sided)) == [(0, 0.5, 1.0, 2 / 3, 1), (1, 0.0, 0.0, 0.0, 1)]


def test_eval_rows_mark_what_was_not_measured(spark):
    row = E.eval_row(spark.createDataFrame([(0.123456,)], "pr_auc DOUBLE"), "2024-01-01", "2024-01-02", "2024-01-03", 5).first()
    assert (row["pr_auc"], row["ctr"], row["cvr"], row["recommend_count"], row["id"]) == (0.1235, -1.0, -1.0, -1, 5)


@pytest.fixture(scope="module")
def samples(spark):
    return spark.range(1000).select(
        F.col("id").alias("user_id"), (F.col("id") % 7).alias("item_id"), (F.col("id") % 10 == 0).cast("int").alias("buy_label"))


def digest(u, i, seed=42):
    return hashlib.md5(f"{seed}|{u}|{i}".encode()).hexdigest()


@pytest.mark.parametrize("digits", [1, 5])
def test_downsample_takes_the_smallest_hashes(samples, monkeypatch, digits):
    monkeypatch.setattr(P, "RANGE_DIGITS", digits)
    data = [tuple(r) for r in samples.collect()]
    negatives = sorted((r for r in data if not r[2]), key=lambda r: digest(*r[:2]))[:300]
    want = sorted(negatives + [r for r in data if r[2]])
    assert rows(P.downsample_negatives(samples)) == want
    assert rows(P.downsample_negatives(samples.repartition(13).orderBy(F.rand()))) == want


@pytest.mark.parametrize("wanted", [1, 3])
def test_downsample_repeated_keys(spark, wanted):
    data = [(0, 0, 1, n) for n in range(wanted)] + [(5, 6, 0, n) for n in range(10)] + [(None, 6, 0, 1), (6, None, 0, 1)]
    few = spark.createDataFrame(data, "user_id BIGINT, item_id BIGINT, buy_label INT, n INT")
    got = P.downsample_negatives(few, ratio=1)
    assert got.filter("buy_label = 0").count() == wanted
    assert rows(got) == rows(P.downsample_negatives(few.repartition(7).orderBy(F.rand()), ratio=1))
    digest = P.seeded_hash(["user_id", "item_id"], 1)
    assert few.filter("user_id is null or item_id is null").select(digest).distinct().count() == 2


def test_downsample_edges(samples):
    few = samples.filter("user_id < 30")
    assert P.downsample_negatives(few, ratio=100).count() == 30  # fewer negatives than allowed
    assert P.downsample_negatives(samples.filter("buy_label = 0")).count() == 0  # no positives, no negatives
    assert P.downsample_negatives(samples.filter("buy_label = 1")).count() == 100
    assert P.downsample_negatives(samples.limit(0)).count() == 0


@pytest.mark.parametrize("n,test_rows", [(1000, 200), (11, 3), (1, 1), (0, 0)])
def test_split_is_exact(samples, n, test_rows):
    part = P.train_test_split(samples.filter(F.col("user_id") < n))
    assert part.filter("is_test").count() == test_rows
    assert part.count() == n


def test_split_does_not_depend_on_partitioning(samples):
    assert rows(P.train_test_split(samples)) == rows(P.train_test_split(samples.repartition(9)))


def test_class_weights(samples):
    got = {r["buy_label"]: r["w"] for r in P.class_balance_weight(samples).groupBy("buy_label").agg(F.max("weight").alias("w")).collect()}
    assert got == {0: 1000 / 1800, 1: 1000 / 200}


def test_folds_are_stable_and_even(samples):
    sizes = [r["count"] for r in P.with_folds(samples).groupBy("fold").count().collect()]
    assert len(sizes) == 3 and min(sizes) > 280
    assert rows(P.with_folds(samples)) == rows(P.with_folds(samples.repartition(5)))


def test_union_and_impute(spark):
    a, b = spark.createDataFrame([(1, 2.0)], "x INT, y DOUBLE"), spark.createDataFrame([(None, 3)], "y DOUBLE, x INT")
    assert rows(P.impute_zero(P.union_pos_neg(a, b), ["y"])) == [(1, 2.0), (3, 0.0)]
