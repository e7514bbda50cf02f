import math

import pytest

from riskweave.operators import explain, features, integrated, training


def test_report_features_under_any_name(spark):
    rows = [("b", "0.5"), ("a", "0.5"), ("c", "n/a"), ("d", None), ("e", "1.23456789"), (None, "0.1")]
    given = spark.createDataFrame(rows, "Name string, Coefficient string")
    assert [tuple(r) for r in explain.report_features(given, 3).collect()] == [("e", 1.234568), ("a", 0.5), ("b", 0.5)]
    assert explain.report_features(given.withColumnRenamed("Name", "other")).count() == 0
    assert explain.report_features(given.limit(0)).count() == 0


def test_rate_gaps_against_plain_counting(spark):
    rows = [(True, 1, 0), (True, 0, 0), (False, 1, 1), (False, 1, None), (False, 0, 1), (None, 1, 0)]
    found = {r["feature"]: r["importance"] for r in explain.rate_gaps(
        spark.createDataFrame(rows, "y boolean, f int, `g.h` int"), "y", ["f", "g.h"]).collect()}
    assert found == {"f": pytest.approx(abs(1 / 2 - 3 / 4)), "g.h": pytest.approx(abs(0 / 2 - 2 / 4))}
    one_sided = spark.createDataFrame([(False, 1)], "y boolean, f int")
    assert explain.rate_gaps(one_sided, "y", ["f"]).first()["importance"] == 1.0


def test_scorecard_equals_the_formula(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (2, 0, None), (3, None, -400.0)], "id int, a int, b double")
    found = {r["id"]: r["probability"] for r in training.score_card(df, {"a": 0.5, "b": -1.0}, 0.25, ["id"]).collect()}
    assert found == {1: round(1 / (1 + math.exp(1.25)), 10), 2: None, 3: None}
    with pytest.raises(ValueError):
        training.score_card(df, {"missing": 1.0}, 0.0, ["id"])


def test_feature_summary_counts_missing_values_and_targets(spark):
    df = spark.createDataFrame(
        [("18-25", 1, 0, None), (None, 0, 1, float("nan")), (None, 0, 1, 2.0)], "AgeBand string, RiskIndicator int, SeriousDlqin2yrs int, x double")
    found = {(r["feature"], r["value"]): r["count"] for r in features.feature_summary(df).collect()}
    assert found == {("AgeBand", "18-25"): 1, ("AgeBand", "(missing)"): 2, ("RiskIndicator", "1"): 1, ("RiskIndicator", "0"): 2,
                     ("SeriousDlqin2yrs", "0"): 1, ("SeriousDlqin2yrs", "1"): 2, ("missing_values", "AgeBand"): 2, ("missing_values", "x"): 2}


def test_laundering_deliveries_bring_their_alert(spark):
    aml = spark.createDataFrame([(1, 0.9, None, "AML_ALERT"), (2, 0.1, "OPEN", "AML_ALERT"), (3, 0.1, None, None)],
                                "customer_id int, probability double, alert_status string, alert string")
    other = spark.createDataFrame([(4, 0.1)], "customer_id int, probability double")
    found = {r["customer_id"]: r["aml_alert_status"] for r in integrated.combine_domains(other, other, aml).collect()}
    assert found == {1: "AML_ALERT", 2: "OPEN", 3: "NO_ALERT", 4: "NO_ALERT"}
    assert "credit_alert_status" not in integrated.extract_domain(other, "credit").columns
