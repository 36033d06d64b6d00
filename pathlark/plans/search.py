"""The search over every option of every family, with as few fits as the options need.

Boosting adds tree after tree, so the first 50 of 100 trees are the model that 50 trees would have given: of
options that differ in the number of trees only the largest is fitted, and scored at each number. Fitted
boosters are scored as column expressions. The rows of a fold are kept while all options are fitted to them.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathlark.functions.trees import score_tree_ensemble
from pathlark.operators.evaluation import pr_auc_average_precision
from pathlark.plans import training as TR
from pathlark.session import fresh_path, stored

#: Rows that a task of a fit handles at least: small data is not dealt out to many tasks of every tree level.
ROWS_PER_TASK = 100_000
SCORES = "family string, params string, fold int, score double"


@dataclass(frozen=True)
class Stage:
    """One fit, and the options it answers for: parameters, and how to fit them on their own."""

    family: str
    fit: Callable[[], Pipeline]
    options: tuple[tuple[str, Callable[[], Pipeline]], ...]
    sizes: tuple[int, ...] = ()  # numbers of trees, one for each option


def _named(**params) -> str:
    return json.dumps(params, sort_keys=True)


def stages(rows: int, folds: int = TR.FOLDS) -> list[Stage]:
    """All 15 options. ``rows`` as in ``train_logreg``: the strength of its penalty depends on them."""
    out = []
    for depth, rate in product(TR.GBT_DEPTH, TR.GBT_RATE):
        own = tuple((_named(trees=t, depth=depth, rate=rate), lambda t=t, depth=depth, rate=rate: TR.train_gbt(t, depth, rate)) for t in TR.GBT_TREES)
        out.append(Stage("GradientBoosting", lambda depth=depth, rate=rate: TR.train_gbt(max(TR.GBT_TREES), depth, rate), own, TR.GBT_TREES))
    for trees, depth in product(TR.FOREST_TREES, TR.FOREST_DEPTH):
        fit = lambda trees=trees, depth=depth: TR.train_rf(trees, depth)
        out.append(Stage("RandomForest", fit, ((_named(trees=trees, depth=depth), fit),)))
    for c in TR.LOGREG_C:
        of_fold, of_all = (lambda c=c, n=n: TR.train_logreg(c, n) for n in (TR.fold_rows(rows, folds), rows))
        out.append(Stage("LogisticRegression", of_fold, ((_named(c=c), of_all),)))
    return out


def _area(scored: DataFrame) -> float:
    return float(pr_auc_average_precision(scored, label=TR.LABEL).first()["pr_auc"])


def _areas(stage: Stage, model: PipelineModel, rows: DataFrame) -> list[float]:
    if not stage.sizes:
        return [_area(TR.score_with(model, rows))]
    whole = TR.ensemble_from_gbt(model.stages[-1], fresh_path(rows.sparkSession, "booster"))
    out = []
    for n in stage.sizes:
        first = replace(whole, trees=whole.trees[:n], weights=whole.weights[:n])
        out.append(_area(score_tree_ensemble(rows, first, float32=False)))
    return out


def search(prepared: TR.Prepared, folds: int = TR.FOLDS, parallel: int = TR.PARALLEL, grid: list[Stage] | None = None) -> DataFrame:
    """``family, params, fold, score`` of every option and fold, as a stored table: the average precision on the
    fold of what was fitted on the others."""
    train, spark = prepared.train, prepared.train.sparkSession
    grid = grid if grid is not None else stages(prepared.train_rows, folds)
    tasks = -(-prepared.train_rows // ROWS_PER_TASK)
    seen = [train.filter(F.col(TR.FOLD) != k).coalesce(tasks).persist() for k in range(folds)]
    kept = [train.filter(F.col(TR.FOLD) == k).coalesce(tasks).persist() for k in range(folds)]

    def one(job: tuple[Stage, int]) -> list[tuple[str, str, int, float]]:
        stage, k = job
        areas = _areas(stage, stage.fit().fit(seen[k]), kept[k])
        return [(stage.family, name, k, area) for (name, _), area in zip(stage.options, areas, strict=True)]

    try:
        with ThreadPool(parallel) as pool:  # one row for each option and fold comes back
            rows = sum(pool.map(one, [(stage, k) for stage in grid for k in range(folds)], chunksize=1), [])
    finally:
        for part in (*seen, *kept):
            part.unpersist()
    return stored(spark.createDataFrame(rows, SCORES), "fold_scores")


def ranked_options(scores: DataFrame) -> DataFrame:
    """One row for each option: folds, mean score, and its place among all and in its family."""
    each = scores.groupBy("family", "params").agg(F.count(F.lit(1)).alias("folds"), F.avg("score").alias("score"))
    order = [F.col("score").desc(), F.col("family"), F.col("params")]
    return each.select("*", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).alias("place"),
                       F.row_number().over(Window.partitionBy("family").orderBy(*order)).alias("family_place"))


def best_models(prepared: TR.Prepared, scores: DataFrame, parallel: int = TR.PARALLEL, grid: list[Stage] | None = None) -> list[TR.Candidate]:
    """The best option of each family, fitted on all training rows, best first."""
    grid = grid if grid is not None else stages(prepared.train_rows)
    fits = {(stage.family, name): fit for stage in grid for name, fit in stage.options}
    train = prepared.train.coalesce(-(-prepared.train_rows // ROWS_PER_TASK)).persist()

    def one(row) -> TR.Candidate:
        model = fits[row["family"], row["params"]]().fit(train)
        return TR.Candidate(row["family"], float(row["score"]), json.loads(row["params"]), model)

    try:
        best = ranked_options(scores).filter("family_place = 1").collect()  # one row for each family
        with ThreadPool(parallel) as pool:
            return TR.rank_models(pool.map(one, best, chunksize=1))
    finally:
        train.unpersist()
