"""What a logistic fit and its preparation read, and how often."""

import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskweave.operators import preprocess, quality, quantiles, training


def test_a_logistic_fit_takes_few_tasks_and_counts_its_rows_once(spark, monkeypatch):
    rows = VectorAssembler(inputCols=["a"], outputCol="features").transform(
        spark.range(600).selectExpr("id % 7 * 1.0 AS a", "CAST(id % 6 = 0 AS INT) AS label")).repartition(40)
    seen = []
    monkeypatch.setattr(training.LogisticRegression, "fit", lambda self, train, fit=training.LogisticRegression.fit: (
        seen.append((train.rdd.getNumPartitions(), self.getRegParam(), {(r["label"], r["weight"]) for r in train.collect()})), fit(self, train))[1])
    training.train_model(training.ModelSpec("l", "logistic", {"maxIter": 2}), rows)
    weights = {(r["label"], r["weight"]) for r in preprocess.add_class_weights(rows, "label").collect()}
    assert seen == [(training.USUAL_TASKS, 1 / 600, weights)]


def test_equal_rows_meet_whatever_the_sign_of_their_zeros(spark):
    rows = [("b", "x", 0.0, None), ("a", "x", -0.0, None), ("c", "x", math.nan, 1), ("d", "x", math.nan, 1), ("e", None, 0.0, 1)]
    kept = quality.deduplicate_keyed(spark.createDataFrame(rows, "key string, t string, v double, n int"), "key")
    assert kept.columns == ["key", "t", "v", "n"] and sorted(r["key"] for r in kept.collect()) == ["a", "c", "e"]


def test_ranks_where_values_are_few_take_two_passes_and_no_stacking(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: pytest.fail("values were counted again"))
    flags = spark.range(4000).select(*[(F.col("id") % (i + 2) == 0).cast("int").alias(f"f{i}") for i in range(60)])
    found = quantiles.exact_quantiles(flags, flags.columns, [0.1])
    assert all(v == {0.1: 0.0} for v in found.values())


def test_moments_of_more_columns_than_a_pass_holds(spark):
    wide = spark.range(50).select(*[(F.col("id") * (i + 1) % 17).cast("double").alias(f"c{i}") for i in range(2 * preprocess.MOMENTS_A_PASS + 1)])
    fitted = preprocess.fit_columns(wide, wide.columns, [])
    exact = wide.agg(*[F.avg(c).alias(c) for c in wide.columns]).first()
    assert fitted.means == pytest.approx(exact.asDict()) and len(fitted.deviations) == len(wide.columns)
