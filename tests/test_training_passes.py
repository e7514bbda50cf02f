"""What the passes of a fit cost, and that the cut of the input doesn't matter to them."""

import time
from threading import Barrier, Event

import pytest
from pyspark.sql import functions as F

from riskweave.operators import training
from riskweave.plans import domains, inference
from riskweave.session import side_by_side
from riskweave.sources.views import Views

FEW = [training.ModelSpec("logistic_regression", "logistic", {"maxIter": 5}),
       training.ModelSpec("random_forest", "forest", {"numTrees": 5, "maxDepth": 4})]


def test_the_cut_of_the_input_changes_no_model_and_scores_are_kept(spark):
    cards = Views(spark, "/root/testdata/sf0.01").card_transactions
    runs = [domains.transaction_fraud_run(rows, "vec_id", models=FEW) for rows in (cards.coalesce(1), cards.repartition(5, F.rand(3)))]
    seen = [{r["vec_id"]: round(r["probability"], 9) for r in run.scored.collect()} for run in runs]
    assert seen[0] == seen[1] and runs[0].best_model == runs[1].best_model
    first, again = ([r.asDict() for r in run.metrics.orderBy("model").collect()] for run in runs)
    assert [{k: round(v, 9) if isinstance(v, float) else v for k, v in r.items()} for r in first] == [
        {k: round(v, 9) if isinstance(v, float) else v for k, v in r.items()} for r in again]
    for kept in (runs[0].scored, runs[0].metrics):
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" in plan and "UDF" not in plan


def test_rows_of_one_file_are_trained_on_by_several_tasks(spark):
    assert [training.tasks_for(n) for n in (0, 1, 12_000, 480_000, 29_000_000)] == [1, 1, 3, 12, 580]
    dealt = training.spread(spark.range(100).coalesce(1).withColumnRenamed("id", "k"), "k", 3)
    assert dealt.rdd.getNumPartitions() == 3 and dealt.count() == 100


def test_rows_of_one_file_are_scored_by_several_tasks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(training, "score_candidates", lambda fitted, validation, keep, score=training.score_candidates: (
        seen.append((validation.rdd.getNumPartitions(), validation.count())), score(fitted, validation, keep))[1])
    monkeypatch.setattr(training, "SCORED_ROWS_WORTH_A_TASK", 40)
    cards = Views(spark, "/root/testdata/sf0.01").card_transactions.coalesce(1)
    run = domains.transaction_fraud_run(cards, "vec_id", models=FEW)
    (tasks, rows), = seen
    assert tasks == -(-rows // 40) > 1
    scored = inference.transaction_fraud_inference(cards, run.preprocessing, run.models[run.best_model], "vec_id", run.threshold)
    assert scored.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert scored.select("vec_id").distinct().count() == scored.count() == cards.count()


def test_forests_keep_the_nodes_of_rows_between_passes(spark):
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=["a"], outputCol="features").transform(
        spark.range(60).selectExpr("id % 7 * 1.0 AS a", "CAST(id % 7 > 3 AS INT) AS label"))
    assert training.train_model(FEW[1], rows).getOrDefault("cacheNodeIds")


@pytest.mark.parametrize("domain", ["credit", "fraud"])
def test_candidates_beside_boosting_share_the_usual_tasks(spark, monkeypatch, domain):
    published = training.default_models(domain)
    assert [training.tasks_for_fits(n, published) for n in (0, 1, 10_500, 63_000, 630_000, 29_000_000)] == [1, 1, 3, 4, 12, 290]
    assert [training.tasks_for_fits(n, FEW) for n in (63_000, 480_000)] == [training.tasks_for(n) for n in (63_000, 480_000)]
    seen = []
    monkeypatch.setattr(training.tasks_for, "__defaults__", (50,))
    monkeypatch.setattr(training, "train_model", lambda spec, train, target="label", fit=training.train_model: (
        seen.append(train.rdd.getNumPartitions()), fit(spec, train, target))[1])
    few = [*FEW, training.ModelSpec("gradient_boosting", "boosting", {"maxIter": 2, "maxDepth": 2}, balanced=False)]
    run = getattr(domains, f"{domain}_run")(Views(spark, "/root/testdata/sf0.01").applicants, models=few)
    assert seen == [4, 4, 4] and set(run.models) == {m.name for m in few}


def test_a_fitted_candidate_is_scored_while_another_is_still_fitted(spark, monkeypatch):
    scored, waited = Event(), []

    def fit(spec, train, target="label", fit=training.train_model):
        if spec.name == "random_forest":
            waited.append(scored.wait(60))
        return fit(spec, train, target)

    monkeypatch.setattr(training, "train_model", fit)
    monkeypatch.setattr(training, "materialise", lambda df, kept=training.materialise: (kept(df), scored.set())[0])
    cards = Views(spark, "/root/testdata/sf0.001").card_transactions
    run = domains.transaction_fraud_run(cards, "vec_id", models=FEW)
    assert waited == [True]
    assert set(run.models) == {"logistic_regression", "random_forest"} == {r["model"] for r in run.metrics.collect()}


def test_no_fit_outlives_a_failed_run(spark, monkeypatch):
    ended, failed = [], Event()

    def fit(spec, train, target="label"):
        if spec.name == "logistic_regression":
            failed.set()
            raise ValueError("no fit")
        failed.wait(60)
        time.sleep(1)
        ended.append(spec.name)

    monkeypatch.setattr(training, "train_model", fit)
    with pytest.raises(ValueError, match="no fit"):
        training.train_and_select(spark.range(2), spark.range(2), "credit", FEW)
    assert ended == ["random_forest"]


def test_a_candidate_is_compared_while_another_is_still_fitted(spark, monkeypatch):
    compared, waited = Event(), []

    def fit(spec, train, target="label", fit=training.train_model):
        if spec.name == "logistic_regression":  # first in the list, last to end
            waited.append(compared.wait(90))
        return fit(spec, train, target)

    monkeypatch.setattr(training, "train_model", fit)
    monkeypatch.setattr(training, "compare_models", lambda *a, compare=training.compare_models, **k: (compare(*a, **k), compared.set())[0])
    run = domains.transaction_fraud_run(Views(spark, "/root/testdata/sf0.001").card_transactions, "vec_id", models=FEW)
    assert waited == [True]
    assert sorted(r["model"] for r in run.metrics.collect()) == ["logistic_regression", "random_forest"]
    assert run.scored.columns == ["vec_id", "label", "probability"] and run.scored.count() > 0


def test_importance_waits_for_no_threshold_and_starts_no_python(spark, monkeypatch):
    searched = []
    monkeypatch.setattr(domains.metrics, "threshold_sweep", lambda *a, sweep=domains.metrics.threshold_sweep: (
        searched.append(1), sweep(*a))[1])
    run = domains.fraud_run(Views(spark, "/root/testdata/sf0.001").applicants, models=FEW)
    ranked = run.importance.collect()
    assert [r["rank"] for r in ranked] == list(range(1, len(run.preprocessing.feature_names) + 1)) and not searched
    assert "RDD" not in run.importance._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < run.threshold < 1 and {r["operating_threshold"] for r in run.decided.collect()} == {run.threshold}
    assert searched == [1]


def test_the_label_is_checked_while_the_rows_are_split(spark, monkeypatch):
    met = Barrier(2)

    def meet(*a, do, **k):
        met.wait(60)
        return do(*a, **k)

    for module, name in ((domains.quality, "require_binary_target"), (domains.preprocess, "stratified_split")):
        monkeypatch.setattr(module, name, lambda *a, do=getattr(module, name), **k: meet(*a, do=do, **k))
    run = domains.transaction_fraud_run(Views(spark, "/root/testdata/sf0.001").card_transactions, "vec_id", models=FEW)
    assert run.metrics.count() == 2


def test_steps_side_by_side_all_end_before_the_first_failure_is_raised(spark):
    ended = []

    def fail():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        side_by_side(spark, fail, lambda: (time.sleep(1), ended.append(1)))
    assert ended == [1]
    assert side_by_side(spark, lambda: spark.range(3).count(), lambda: "b") == [3, "b"]
