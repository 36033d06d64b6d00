import pytest
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pathlark.functions.trees import score_tree_ensemble
from pathlark.plans import search as SE
from pathlark.plans import training as TR
from pathlark.session import fresh_path
from tests.helpers import rows


@pytest.fixture(scope="module")
def prepared(spark, sf):
    from checks.queries import samples

    return TR.prepare(samples(spark, sf))


def test_preparation(prepared):
    total = {r["buy_label"]: r["count"] for r in prepared.train.groupBy("buy_label").count().collect()}
    assert total[0] <= 3 * total[1]
    weights = prepared.train.agg(F.sum("weight")).first()[0]
    assert weights == pytest.approx(prepared.train_rows)
    pairs = ["user_id", "item_id"]
    assert prepared.train.join(prepared.test, pairs, "left_semi").count() == 0


def test_interaction_positions(spark):
    df = spark.createDataFrame([(Vectors.dense([2.0, 3.0, 5.0]),)], ["v"])
    out = PolynomialExpansion(degree=2, inputCol="v", outputCol="e").transform(df).first()["e"]
    assert [out[i] for i in TR.interaction_positions(3)] == [2.0, 3.0, 6.0, 5.0, 10.0, 15.0]


def test_booster_as_expression(spark, prepared):
    model = TR.train_gbt(trees=5, depth=3).fit(prepared.train)
    want = TR.score_with(model, prepared.test)
    booster = TR.ensemble_from_gbt(model.stages[-1], fresh_path(spark, "gbt"))
    got = score_tree_ensemble(prepared.test, booster, out="p", float32=False)
    both = want.join(got.select("user_id", "item_id", "p"), ["user_id", "item_id"])
    assert both.filter(F.abs(F.col("p") - F.col("predict_score")) > 1e-12).count() == 0
    assert both.count() == prepared.test.count()


def test_champion(spark, prepared):
    from pyspark.ml import PipelineModel

    path = fresh_path(spark, "champion")
    best, ranked = TR.select_champion(prepared, path, lambda n: {k: v[:1] for k, v in TR.full_grid(n).items()})
    assert [c.score for c in ranked] == sorted((c.score for c in ranked), reverse=True)
    assert best is ranked[0]
    again = TR.score_with(PipelineModel.load(path), prepared.test)
    assert rows(again, "predict_score") == rows(TR.score_with(best.model, prepared.test), "predict_score")


def test_champion_scores_windows_and_is_measured(spark, sf, prepared):
    from checks.queries import tables, windows
    from pathlark.plans.recommend import recommend, score_features

    path = fresh_path(spark, "champion")
    TR.train_fallback_tree().fit(prepared.train).write().overwrite().save(path)
    behaviors, users, items = tables(spark, sf)
    scored = score_features(windows(spark, sf), users, items, TR.scorer(path))
    assert scored.count() == windows(spark, sf).count() and "final_score" in scored.columns
    assert scored.filter(~F.col("predict_score").between(0, 1)).count() == 0
    assert recommend(behaviors, users, items, TR.scorer(path), size="1 day", slide="8 hours").count() > 0
    area, report = TR.held_out(TR.train_fallback_tree().fit(prepared.train), prepared.test)
    assert 0 < area <= 1 and report.count() >= 2


def test_first_trees_of_a_booster_are_the_smaller_booster(spark, prepared):
    """Why one fit answers for several numbers of trees."""
    rows_of = prepared.train.coalesce(1)
    large, small = (TR.train_gbt(n, 3, 0.1).fit(rows_of) for n in (6, 3))
    whole = TR.ensemble_from_gbt(large.stages[-1], fresh_path(spark, "gbt"))
    first = TR.Ensemble(whole.trees[:3], rate=1.0, link=2.0, weights=whole.weights[:3])
    got = score_tree_ensemble(prepared.test, first, out="p", float32=False).select("user_id", "item_id", "p")
    both = TR.score_with(small, prepared.test).join(got, ["user_id", "item_id"])
    assert both.count() == prepared.test.count()
    assert both.filter(F.abs(F.col("p") - F.col("predict_score")) > 1e-12).count() == 0


def test_staged_search_scores_like_cross_validation(spark, prepared):
    """Fewer fits, the same scores and the same choice."""
    grid = [SE.Stage("GradientBoosting", lambda: TR.train_gbt(4, 3, 0.1), tuple(
        (SE._named(trees=t), lambda t=t: TR.train_gbt(t, 3, 0.1)) for t in (2, 4)), (2, 4)), SE.stages(prepared.train_rows)[-1]]
    scores = SE.search(prepared, grid=grid, parallel=3)
    assert scores.count() == 9
    _, boosted = TR.grid_search_cv(prepared.train.coalesce(1), "GradientBoosting", [({"trees": t}, TR.train_gbt(t, 3, 0.1)) for t in (2, 4)])
    options = {(r["family"], r["params"]): r for r in SE.ranked_options(scores).collect()}
    for t, want in zip((2, 4), boosted, strict=True):
        assert options["GradientBoosting", SE._named(trees=t)]["score"] == pytest.approx(want, abs=1e-9)
    assert sorted(r["place"] for r in options.values()) == [1, 2, 3] and {r["folds"] for r in options.values()} == {3}
    best = SE.best_models(prepared, scores, grid=grid)
    assert [c.score for c in best] == sorted((r["score"] for r in options.values() if r["family_place"] == 1), reverse=True)
    path = fresh_path(spark, "champion")
    assert TR.save_best(prepared, best, path) is best[0] and TR.scorer(path)(prepared.test).count() == prepared.test.count()


def test_search_covers_the_grid():
    plan = SE.stages(100)
    assert len(plan) == 11 and sum(len(x.options) for x in plan) == 15
    assert len({(x.family, name) for x in plan for name, _ in x.options}) == 15


def test_grid_is_complete():
    sizes = {name: len(options) for name, options in TR.full_grid(100).items()}
    assert sizes == {"GradientBoosting": 8, "RandomForest": 4, "LogisticRegression": 3}


def test_training_after_observing(spark, sf, workdir):
    """An observation leaves the session in a state fitted models must not drag along."""
    from checks.queries import samples
    from pathlark.operators.sinks import rebuild_table

    rebuild_table(spark.range(5).toDF("x"), f"{workdir}/t").collect()
    data = TR.prepare(samples(spark, sf))
    model = TR.train_logreg(1.0, data.train_rows).fit(data.train)
    assert TR.score_with(model, data.test).filter("predict_score > 0").count() == data.test.count()
