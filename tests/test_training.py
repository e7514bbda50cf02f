"""Models: probabilities, repeatability, better than chance; never equality with other libraries."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskweave.operators import explain, features, metrics, training
from riskweave.operators.preprocess import FittedColumns
from riskweave.plans import domains, inference
from riskweave.sources.views import Views

FOLDER = "/root/testdata/sf0.01"
SMALL = {"logistic": {"maxIter": 25}, "forest": {"numTrees": 10, "maxDepth": 5}, "boosting": {"maxIter": 5, "maxDepth": 3}}


def small_models(domain):
    """Candidates with fewer iterations and trees, where a test is not about the model."""
    return [training.ModelSpec(m.name, m.kind, {**m.params, **SMALL[m.kind]}, m.balanced) for m in training.default_models(domain)]


@pytest.fixture(scope="module")
def run(spark):
    return domains.credit_run(Views(spark, FOLDER).applicants, models=small_models("credit"))


def test_run_reports_every_candidate(run):
    table = run.metrics.collect()
    assert {r["model"] for r in table} == {"logistic_regression", "random_forest", "gradient_boosting"}
    best = max(table, key=lambda r: r["pr_auc"])
    assert best["pr_auc"] == {r["model"]: r["pr_auc"] for r in table}[run.best_model]


def test_scores_are_probabilities_and_beat_chance(run):
    low, high = run.scored.agg(F.min("probability"), F.max("probability")).first()
    assert 0.0 <= low <= high <= 1.0
    assert metrics.rank_metrics(run.scored).first()["roc_auc"] > 0.6
    assert run.segments.agg(F.sum("count")).first()[0] == run.scored.count()


def test_same_seed_same_scores(spark, run):
    again = domains.credit_run(Views(spark, FOLDER).applicants, models=small_models("credit"))
    assert again.best_model == run.best_model
    assert sorted(map(tuple, again.decided.select("applicant_id", "prediction").collect())) == sorted(
        map(tuple, run.decided.select("applicant_id", "prediction").collect()))


def test_importance_and_row_explanations(spark, run):
    ranked = run.importance.orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1))
    assert sum(r["importance_normalized"] for r in ranked) == pytest.approx(1.0)
    rows = Views(spark, FOLDER).applicants
    explained = explain.explain_features(rows, run.importance, "applicant_id", k=3)
    assert explained.count() == 3 * rows.count()
    assert not explained.where("feature like 'numeric\\\\_\\\\_%'").count()


def test_importance_of_nothing_is_zero(spark):
    rows = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "feature string, importance double")
    assert {r["importance_normalized"] for r in training.rank_importance(rows).collect()} == {0.0}


def test_models_can_be_saved_and_loaded(spark, run, tmp_path):
    model = run.models[run.best_model]
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model")).stages[0]
    assert loaded.uid == model.uid


def test_new_rows_are_scored_with_the_saved_preprocessing(spark, run, tmp_path):
    run.preprocessing.save(spark, str(tmp_path / "columns"))
    fitted = FittedColumns.load(spark, str(tmp_path / "columns"))
    assert fitted == run.preprocessing
    rows = Views(spark, FOLDER).applicants
    scored, rejected = inference.credit_inference(rows, fitted, run.models[run.best_model])
    assert scored.count() + rejected.count() == rows.count()
    assert rejected.count() == rows.where("age < 18 or age > 120").count()
    with pytest.raises(ValueError, match="missing: DebtRatio"):
        inference.predict(features.fraud_features(rows).drop("DebtRatio"), fitted, run.models[run.best_model], ["applicant_id"])


def test_transfers_are_scored_with_training_formats(spark):
    transfers = Views(spark, "/root/testdata/sf0.001").aml_transfers
    trained = domains.aml_run(transfers, models=small_models("aml")[:1])
    cash = transfers.where("payment_format = 'Cash'")
    scored = inference.aml_inference(cash, trained.preprocessing, trained.models[trained.best_model], 80000.0)
    assert scored.count() == cash.count()
    assert set(scored.columns) == {"record_key", "aml_probability", "risk_segment", "aml_decision", "aml_prediction", "explanation"}


def test_the_published_candidates_are_fitted_and_the_best_one_scores(spark):
    v = Views(spark, "/root/testdata/sf0.001")
    run = domains.transaction_fraud_run(v.card_transactions, "vec_id")
    forest = run.models["random_forest"]
    assert forest.getNumTrees == 300 and forest.getOrDefault("maxDepth") == 12
    assert run.models["logistic_regression"].getOrDefault("maxIter") == 1000
    assert run.best_model == metrics.select_model(run.metrics, "transaction_fraud").first()["model"]
    scored = inference.transaction_fraud_inference(v.card_transactions, run.preprocessing, run.models[run.best_model], "vec_id", run.threshold)
    assert scored.count() == v.card_transactions.count()


def test_published_candidates():
    credit = {m.name: m for m in training.default_models("credit")}
    assert credit["random_forest"].params["numTrees"] == 300 and credit["gradient_boosting"].params["stepSize"] == 0.05
    assert [m.name for m in training.default_models("aml")] == ["logistic_regression", "random_forest"]


def test_selection_order(spark):
    rows = spark.createDataFrame(
        [("a", 0.5, 0.9, 0.1, 0.2), ("b", 0.5, 0.9, 0.3, 0.1), ("c", 0.4, 0.99, 0.9, 0.9)],
        "model string, pr_auc double, roc_auc double, f1_score double, recall double")
    assert metrics.select_model(rows, "fraud").first()["model"] == "b"
    assert metrics.select_model(rows, "credit").first()["model"] == "a"
    assert metrics.select_model(rows, "transaction_fraud").first()["model"] == "a"
    assert metrics.select_model(rows, "aml").first()["model"] == "c"


def test_models_score_after_alerts_were_appended_and_rows_observed(spark, tmp_path):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import Observation

    from riskweave.sources import sinks

    alerts = spark.createDataFrame([(1, "RULES", 0.5)], "transaction_id long, detection_source string, fraud_score double")
    assert sinks.append_alerts(alerts, str(tmp_path / "alerts"), buckets=2)["created"] == 1
    seen = Observation("seen")
    alerts.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 1
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.range(200).selectExpr("id", "id % 7 * 1.0 AS a", "id % 3 * 1.0 AS b", "CAST(id % 7 > 3 AS INT) AS label"))
    for kind, params in (("logistic", {"maxIter": 20}), ("forest", {"numTrees": 3}), ("boosting", {"maxIter": 2})):
        model = training.train_model(training.ModelSpec(kind, kind, params), rows)
        assert not getattr(model, "hasSummary", False)
        scored = training.score_batch(model, rows, ["id", "label"])
        assert scored.groupBy("label").agg(F.avg("probability").alias("p")).orderBy("label").collect()[1]["p"] > 0.5
