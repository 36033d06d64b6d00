"""Training of purchase models on Spark ML and the choice of a champion."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import PolynomialExpansion, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.functions.trees import Ensemble, ensemble_from_nodes
from pathlark.operators.evaluation import classification_report, pr_auc_average_precision
from pathlark.operators.features import agg_training_samples, item_features, project_features, user_features
from pathlark.operators.sampling import class_balance_weight, downsample_negatives, train_test_split, with_folds
from pathlark.session import stored, use_utc

# --- Fixed values: the search grid ---------------------------------------------------------
GBT_TREES, GBT_DEPTH, GBT_RATE = (50, 100), (3, 5), (0.05, 0.1)
FOREST_TREES, FOREST_DEPTH = (50, 100), (5, 10)
LOGREG_C = (0.1, 1.0, 10.0)
FOLDS, PARALLEL, SEED = 3, 2, 42
FALLBACK_DEPTH = 3
# -------------------------------------------------------------------------------------------

LABEL, WEIGHT, FOLD = "buy_label", "weight", "fold"


def build_training_set(behaviors: DataFrame) -> DataFrame:
    """One sample per (user, item) from the behaviours alone."""
    return agg_training_samples(behaviors, user_features(behaviors), item_features(behaviors))


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    train_rows: int


def prepare(samples: DataFrame, seed: int = SEED) -> Prepared:
    """Split 80/20, thin out the negatives of the training part, add weights and folds.

    Models are fitted in a session of their own: a fitted logistic regression carries its session
    along, and one in which rows were ever observed cannot be sent to executors.
    """
    own = use_utc(samples.sparkSession.newSession())
    split = stored(train_test_split(samples, seed=seed), "split", own)
    keys = ("user_id", "item_id")
    train = stored(downsample_negatives(split.filter(~F.col("is_test")), seed=seed), "thinned")
    ready = with_folds(class_balance_weight(train), seed=seed)
    train = stored(project_features(ready, keep=(*keys, LABEL, WEIGHT, FOLD)), "train")
    test = project_features(split.filter("is_test"), keep=(*keys, LABEL))
    return Prepared(train, test, train.count())


# --- candidates -------------------------------------------------------------------------------
def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(S.MODEL_FEATURES), outputCol="raw_features")


def train_gbt(trees: int = 50, depth: int = 3, rate: float = 0.1, seed: int = SEED) -> Pipeline:
    learner = GBTClassifier(
        featuresCol="raw_features", labelCol=LABEL, maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed
    )
    return Pipeline(stages=[_assembler(), learner])


def train_rf(trees: int = 50, depth: int = 5, seed: int = SEED) -> Pipeline:
    learner = RandomForestClassifier(
        featuresCol="raw_features", labelCol=LABEL, weightCol=WEIGHT, numTrees=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[_assembler(), learner])


def interaction_positions(n: int) -> list[int]:
    """Where a degree-2 expansion of n features holds single features and products of two different
    ones; each feature's block ends with its square, which is left out."""
    kept, start = [], 0
    for j in range(n):
        kept += range(start, start + j + 1)
        start += j + 2
    return kept


def train_logreg(c: float = 1.0, rows: int = 1) -> Pipeline:
    """Standardised inputs with pairwise products. The weights add up to ``rows``, so a strength C
    per row sum is 1/(C·rows) per mean."""
    learner = LogisticRegression(
        featuresCol="features", labelCol=LABEL, weightCol=WEIGHT, maxIter=1000, regParam=1.0 / (c * max(rows, 1)),
        standardization=False,  # the inputs are scaled already, and the penalty is on the weights as they are
    )
    return Pipeline(stages=[
        _assembler(),
        StandardScaler(inputCol="raw_features", outputCol="scaled", withMean=True, withStd=True),
        PolynomialExpansion(degree=2, inputCol="scaled", outputCol="expanded"),
        VectorSlicer(inputCol="expanded", outputCol="features",
                     indices=interaction_positions(len(S.MODEL_FEATURES))),
        learner,
    ])


def train_fallback_tree(seed: int = SEED) -> Pipeline:
    learner = DecisionTreeClassifier(
        featuresCol="raw_features", labelCol=LABEL, weightCol=WEIGHT, maxDepth=FALLBACK_DEPTH, seed=seed
    )
    return Pipeline(stages=[_assembler(), learner])


# --- scoring and search --------------------------------------------------------------------------
def score_with(model: PipelineModel, rows: DataFrame, out: str = "predict_score") -> DataFrame:
    """P(buy) for every row, computed where the rows are."""
    scored = model.transform(project_features(rows, keep=[c for c in rows.columns if c not in S.MODEL_FEATURES]))
    return scored.withColumn(out, vector_to_array("probability")[1]).select(*rows.columns, out)


def scorer(path: str) -> Callable[[DataFrame], DataFrame]:
    """A saved champion as a function that adds P(buy): for batch scoring, ranking and streams alike."""
    model = PipelineModel.load(path)
    return lambda rows: score_with(model, rows)


def held_out(model: PipelineModel, test: DataFrame) -> tuple[float, DataFrame]:
    """Average precision and classification report on rows no fit has seen."""
    scored = score_with(model, test)
    area = pr_auc_average_precision(scored, label=LABEL).first()["pr_auc"]
    return float(area), classification_report(scored, label=LABEL)


class AveragePrecision(Evaluator):
    """Average precision of a probability column, for cross-validation."""

    def __init__(self, label: str = LABEL):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(vector_to_array("probability")[1].alias("predict_score"), self.label)
        return float(pr_auc_average_precision(scored, label=self.label).first()["pr_auc"])

    def isLargerBetter(self) -> bool:
        return True


@dataclass
class Candidate:
    name: str
    score: float
    params: dict
    model: PipelineModel


def full_grid(rows: int) -> dict[str, list[tuple[dict, Pipeline]]]:
    """All options of all families, for a search over ``rows`` rows in total."""
    return {
        "GradientBoosting": [
            ({"trees": t, "depth": d, "rate": r}, train_gbt(t, d, r))
            for t, d, r in product(GBT_TREES, GBT_DEPTH, GBT_RATE)
        ],
        "RandomForest": [
            ({"trees": t, "depth": d}, train_rf(t, d)) for t, d in product(FOREST_TREES, FOREST_DEPTH)
        ],
        "LogisticRegression": [({"c": c}, train_logreg(c, fold_rows(rows))) for c in LOGREG_C],
    }


def fold_rows(rows: int, folds: int = FOLDS) -> int:
    """Rows that a fit of the search sees; a strength per row sum depends on them."""
    return rows * (folds - 1) // folds


def grid_search_cv(
    train: DataFrame, name: str, options: Sequence[tuple[dict, Pipeline]], folds: int = FOLDS,
    parallel: int = PARALLEL,
) -> tuple[Candidate, list[float]]:
    """Cross-validate the options on the stored folds, refit the best on all rows."""
    holder = Pipeline(stages=[])
    grid = ParamGridBuilder().addGrid(holder.stages, [p.getStages() for _, p in options]).build()
    search = CrossValidator(
        estimator=holder, estimatorParamMaps=grid, evaluator=AveragePrecision(), numFolds=folds,
        parallelism=parallel, foldCol=FOLD,
    ).fit(train)
    scores = [float(v) for v in search.avgMetrics]
    best = max(range(len(scores)), key=scores.__getitem__)
    params, model = options[best][0], search.bestModel
    if name == "LogisticRegression":  # the last fit sees all rows
        model = train_logreg(params["c"], train.count()).fit(train)
    return Candidate(name, scores[best], params, model), scores


def rank_models(candidates: Sequence[Candidate]) -> list[Candidate]:
    return sorted(candidates, key=lambda c: (-c.score, c.name))


def select_champion(
    prepared: Prepared, path: str,
    grid: Callable[[int], dict[str, list[tuple[dict, Pipeline]]]] = full_grid,
) -> tuple[Candidate, list[Candidate]]:
    """Search every family, save the best model that can be saved, else a small tree.

    ``search.search`` and ``save_best`` do the same with fewer fits.
    """
    found = []
    for name, options in grid(prepared.train_rows).items():
        found.append(grid_search_cv(prepared.train, name, options)[0])
    ranked = rank_models(found)
    return save_best(prepared, ranked, path), ranked


def save_best(prepared: Prepared, ranked: Sequence[Candidate], path: str) -> Candidate:
    """Save the first of the ranked models that can be saved, else a small tree."""
    for candidate in ranked:
        try:
            candidate.model.write().overwrite().save(path)
            return candidate
        except Exception as failure:  # the next best takes its place
            print(f"could not save {candidate.name}: {failure}")
    fallback = train_fallback_tree().fit(prepared.train)
    fallback.write().overwrite().save(path)
    return Candidate("DecisionTree", 0.0, {"depth": FALLBACK_DEPTH}, fallback)


def ensemble_from_gbt(model: GBTClassificationModel, path: str) -> Ensemble:
    """The fitted booster as a column expression. ``path`` receives the saved model."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(path)
    nodes = SparkSession.active().read.parquet(f"{path}/data")
    return ensemble_from_nodes(nodes, model.treeWeights, S.MODEL_FEATURES)
