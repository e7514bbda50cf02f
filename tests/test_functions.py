"""Band edges, null rules and normalisation, row by row."""

import json
import random

import pytest
from pyspark.sql import functions as F

from riskweave.functions import bands, conditions, normalise, privacy
from riskweave.operators import integrated


def one(spark, values, column, dtype="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["out"] for r in df.select("i", column(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("column, values, expected", [
    (bands.rule_level, [29, 30, 49, 50, 69, 70, 200], ["Low", "Medium", "Medium", "High", "High", "Critical", "Critical"]),
    (bands.credit_segment, [0.1799, 0.18, 0.24, 0.5], ["Low Risk", "Moderate Risk", "High Risk", "Very High Risk"]),
    (bands.credit_segment_closed_right, [0.18, 0.24, 0.5, 0.51], ["Low Risk", "Moderate Risk", "High Risk", "Very High Risk"]),
    (bands.credit_explain_segment, [0.04, 0.05, 0.10, 0.18], ["Low Risk", "Moderate Risk", "High Risk", "Very High Risk"]),
    (bands.credit_category, [0.39, 0.40, 0.70], ["LOW", "MEDIUM", "HIGH"]),
    (bands.credit_decision, [0.17, 0.18], ["LOW_RISK", "REVIEW"]),
    (bands.fraud_segment, [0.049, 0.05, 0.15, 0.30], ["Low Risk", "Moderate Risk", "High Risk", "Very High Risk"]),
    (bands.fraud_decision, [0.19, 0.20], ["LOW_RISK", "FRAUD_REVIEW"]),
    (bands.transaction_fraud_level, [0.39, 0.40, 0.75, 0.90], ["Low", "Medium", "High", "Critical"]),
    (bands.aml_business_risk, [0.29, 0.30, 0.80], ["LOW_RISK", "MEDIUM_RISK", "HIGH_RISK"]),
    (lambda p: bands.aml_assessment(p)["aml_decision"], [0.19, 0.20, 0.50], ["LOW_RISK", "REVIEW", "AML_ALERT"]),
    (integrated.tier, [24.9, 25.0, 50.0, 75.0], ["LOW", "MEDIUM", "HIGH", "CRITICAL"]),
])
def test_band_edges(spark, column, values, expected):
    assert one(spark, [float(v) for v in values], column) == expected


def test_age_bands_of_both_domains(spark):
    ages = [16, 17, 25, 26, 65, 66, 120, 121, None]
    assert one(spark, ages, lambda a: bands.age_band(a, 17, 120), "int") == [
        None, "18-25", "18-25", "26-35", "51-65", "66+", "66+", None, None]
    assert one(spark, ages, lambda a: bands.age_band(a, 0, None), "int") == [
        "18-25", "18-25", "18-25", "26-35", "51-65", "66+", "66+", "66+", None]


def test_probability_and_score_normalisation(spark):
    texts = ["25%", "0.25", "25", "0.25%", None, "abc", "-1", "250", "1", "1e-3"]
    assert one(spark, texts, normalise.normalize_probability, "string") == [
        0.25, 0.25, 0.25, 0.25, 0.0, 0.0, 0.0, 1.0, 1.0, 0.001]
    assert one(spark, [1.0, 1.0001, 0.5, None, 130.0, -3.0], normalise.normalize_score) == [100.0, 1.0001, 50.0, 0.0, 100.0, 0.0]


def test_labels(spark):
    assert one(spark, [" High ", "critical risk", "Odd", None], normalise.normalize_segment, "string") == [
        "HIGH RISK", "CRITICAL RISK", "Odd", "UNKNOWN"]
    record = "{'fraud_probability': 0.01, 'fraud_decision': 'REVIEW'}"
    assert one(spark, [record, "AML_ALERT", None, "{'credit_decision': 'OTHER'}"], normalise.clean_decision, "string") == [
        "REVIEW", "AML_ALERT", "UNKNOWN", "{'credit_decision': 'OTHER'}"]


def test_threshold_lookup_ignores_case_and_separators(spark):
    texts = ['{"a": {"Business Threshold": 0.3}}', '{"x": [{"BUSINESS-threshold": "0.4"}]}', '{"business_threshold": "n/a"}',
             '{"business_threshold": null, "z": {"recall_threshold": 0.7}}', None]
    assert one(spark, texts, lambda t: normalise.threshold_in(t, ["business_threshold", "recall_threshold"], 0.2), "string") == [
        0.3, 0.4, 0.2, 0.7, 0.2]


def reference_threshold(text, names, default):
    """The lookup as a recursive walk over the parsed text."""
    def walk(node):
        for key, value in node.items() if isinstance(node, dict) else enumerate(node) if isinstance(node, list) else ():
            if isinstance(key, str) and key.strip().lower().replace("-", "_").replace(" ", "_") in names:
                try:
                    return float(value)
                except (TypeError, ValueError):
                    pass
            deeper = walk(value)
            if deeper is not None:
                return deeper
        return None

    try:
        found = walk(json.loads(text))
    except ValueError:
        return default
    return default if found is None else found


def test_threshold_lookup_reads_json_as_a_walk_does(spark):
    names = ["business_threshold", "recall_threshold"]
    texts = [
        r'{"note": "\"business_threshold\": 0.9, ", "recall threshold": 0.4}', '{"a": ["business_threshold", 0.1, {"b": [{"Recall-Threshold": 5}]}]}',
        '{"recall_threshold": 0.1, "business_threshold": 0.2}', '{"business_threshold": {"recall_threshold": 0.3}}',
        '{"business_threshold": [0.1], "x": {"business_threshold": "  .5e1 "}}', r'{"b\u0075siness_threshold": 0.6}', '{" BUSINESS threshold ": -7}',
        '{"business_threshold": true}', '{"business_threshold": 0.5', "[]", '{"a": 1} trailing', '{"business_threshold_2": 1, "my_business_threshold": 2}',
        '{"business_threshold": "1d"}', '{"x":{"y":{"z":{"recall-threshold":1e-3}}}}', '"business_threshold"', '{"k": "v:", "recall_threshold" : 2}']
    rng = random.Random(6)

    def node(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.4:
            return rng.choice([1, 0.25, "0.5", "x", None, "business_threshold", 'a"b', [], {}])
        if kind < 0.6:
            return [node(depth - 1) for _ in range(rng.randint(0, 3))]
        keys = rng.sample(["business_threshold", "Recall Threshold", "a", "b\\", 'c"', ":", "BUSINESS-THRESHOLD"], rng.randint(0, 4))
        return {k: node(depth - 1) for k in keys}

    texts += [json.dumps(node(4)) for _ in range(300)]
    got = one(spark, texts, lambda t: normalise.threshold_in(t, names, 0.2), "string")
    assert got == [reference_threshold(t, names, 0.2) for t in texts]


def test_unknown_is_equal_to_nothing(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "x string, y string")
    rows = df.select(conditions.same(F.col("x"), F.col("y")).alias("s"), conditions.differs(F.col("x"), F.col("y")).alias("d")).collect()
    assert [(r["s"], r["d"]) for r in rows] == [(True, False), (False, True), (False, True), (False, True)]


def test_grid_position_counts_reached_entries(spark):
    grid = [i / 100 for i in range(1, 100)]
    values = [0.0, 0.01, 0.07, 0.28, 0.29, 0.57, 0.58, 0.99, 1.0, 0.0999]
    assert one(spark, values, lambda v: conditions.grid_position(v, grid)) == [sum(v >= g for g in grid) for v in values]


def test_masking_shows_no_personal_data(spark):
    df = spark.createDataFrame([("Ann", "a@b", "ABCDE1234F", "AC0000001234", "Low")],
                               "first_name string, email string, pan_number string, account_number string, risk_category string")
    masked = privacy.mask_personal_data(df, key="k")
    assert masked.columns == ["pan_number", "account_number", "risk_category"]
    row = masked.first()
    assert row["account_number"] == "****1234" and len(row["pan_number"]) == 64
    assert privacy.mask_personal_data(df, key="k").first() == row != privacy.mask_personal_data(df, key="other").first()


def test_padding_never_cuts(spark):
    keys = [1, 9999, 10000, 999999, 1000000]
    got = one(spark, [str(k) for k in keys], lambda v: normalise.padded(v, 4), "string")
    assert got == ["0001", "9999", "10000", "999999", "1000000"]
