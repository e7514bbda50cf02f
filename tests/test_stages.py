"""Feature building, encoding and model as one saved pipeline."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.operators import features, preprocess, training
from riskweave.operators.stages import ColumnEncoder, DomainFeatures
from riskweave.sources.views import Views

NUMERIC = [V.UTILIZATION, "age", "DebtRatio", "MonthlyIncome"]


def test_one_pipeline_scores_new_rows_as_before(spark, tmp_path):
    rows = Views(spark, "/root/testdata/sf0.001").applicants
    train, fresh = rows.where("applicant_id % 4 != 0"), rows.where("applicant_id % 4 = 0")
    regression = LogisticRegression(labelCol=V.APPLICANT_TARGET, maxIter=20, regParam=0.01)
    encoder = ColumnEncoder(numericCols=NUMERIC, categoricalCols=["AgeBand"])
    Pipeline(stages=[DomainFeatures(domain="fraud"), encoder, regression]).fit(train).write().save(str(tmp_path / "pipeline"))
    loaded = PipelineModel.load(str(tmp_path / "pipeline"))
    found = loaded.transform(fresh).select("applicant_id", F.round(vector_to_array("probability")[1], 9).alias("p"))

    fitted = preprocess.fit_columns(features.fraud_features(train), NUMERIC, ["AgeBand"])
    assert loaded.stages[1].fitted == fitted
    model = regression.fit(fitted.vectors(features.fraud_features(train), [V.APPLICANT_TARGET]))
    by_hand = training.score_batch(model, fitted.vectors(features.fraud_features(fresh), ["applicant_id"]), ["applicant_id"])
    want = {r["applicant_id"]: r["probability"] for r in by_hand.collect()}
    got = {r["applicant_id"]: r["p"] for r in found.collect()}
    assert got.keys() == want.keys() and len(got) > 10
    assert all(got[k] == pytest.approx(want[k], abs=1e-6) for k in got)


def test_params_are_saved_with_an_unfitted_pipeline(spark, tmp_path):
    encoder = ColumnEncoder(numericCols=["x"], categoricalCols=["c"], missingCategory=True, mostCategories=3, outputCol="v")
    Pipeline(stages=[encoder]).write().save(str(tmp_path / "unfitted"))
    loaded = Pipeline.load(str(tmp_path / "unfitted")).getStages()[0]
    rows = spark.createDataFrame([(1.0, "a"), (3.0, None), (None, "b")], "x double, c string")
    vectors = [list(map(float, r[0])) for r in loaded.fit(rows).transform(rows).select("v").collect()]
    assert [v[1:] for v in vectors] == [[1.0, 0.0, 0.0], [0.0, 0.0, 1.0], [0.0, 1.0, 0.0]]
    assert loaded.copy({loaded.missingCategory: False}).fit(rows).fitted.categories == {"c": ["a", "b"]}
    with pytest.raises(ValueError, match="more than 3 categories"):
        loaded.fit(spark.range(9).select(F.col("id").cast("double").alias("x"), F.col("id").cast("string").alias("c")))


def test_unseen_values_nulls_and_clashing_names(spark):
    rows = spark.createDataFrame([(1.0, "a"), (3.0, "b")], "x double, c string")
    model = ColumnEncoder(numericCols=["x"], categoricalCols=["c"]).fit(rows)
    fresh = spark.createDataFrame([(None, "z", 7)], "x double, c string, extra int")
    row = model.transform(fresh).first()
    assert row["extra"] == 7 and list(map(float, row["features"])) == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError, match="already have a column features"):
        model.transform(fresh.withColumn("features", F.lit(1)))
    with pytest.raises(ValueError, match="No features of domain"):
        DomainFeatures(domain="other").transform(rows)
