from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import fixed_values as V
from riskweave.operators import features, integrated, quality
from riskweave.sources import schemas

INF, NAN = float("inf"), float("nan")


def applicants(spark, *rows):
    schema = schemas.table_schema("applicants")
    base = {"SeriousDlqin2yrs": 0, V.UTILIZATION: 0.1, "age": 40, V.LATE_30_59: 0, "DebtRatio": 0.1, "MonthlyIncome": 1000.0,
            V.OPEN_LINES: 3, V.LATE_90: 0, V.REAL_ESTATE_LINES: 1, V.LATE_60_89: 0, V.DEPENDENTS: 1.0}
    full = [{"Unnamed: 0": i, **base, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in full], schema)


def test_quarantine_keeps_unknown_age_and_marks_the_rest(spark):
    df = applicants(spark, *[{"age": a} for a in (17, 18, 100, 101, 0, None)])
    valid, bad = quality.quarantine_split(df, source_file="in.csv")
    assert sorted(str(r["age"]) for r in valid.collect()) == ["100", "18", "None"]
    assert sorted(r["age"] for r in bad.collect()) == [0, 17, 101]
    row = bad.first()
    assert (row["quarantine_rule"], row["source_file"]) == ("age_range", "in.csv") and row["quarantined_at_utc"]
    audit = quality.quarantine_audit(df).first()
    assert (audit["source_rows"], audit["valid_rows"], audit["quarantined_rows"]) == (6, 3, 3)


def test_same_age_fails_one_report_and_passes_the_other(spark):
    df = applicants(spark, {"age": 101}, {"SeriousDlqin2yrs": None}, {"SeriousDlqin2yrs": None})
    report = {r["rule"]: r for r in quality.credit_quality_report(df.drop("Unnamed: 0")).collect()}
    assert (report["age_range"]["status"], report["age_range"]["failed_rows"]) == ("FAIL", 1)
    assert report["target_values"]["failed_rows"] == 2  # copies count
    assert report["duplicate_rows"]["failed_rows"] == 1
    assert len(report) == 12 and report["debt_ratio"]["overall_status"] == "FAIL"
    checks = {r["rule"]: r["status"] for r in quality.sanity_checks(df).collect()}
    assert checks["age_range"] == "PASS"
    missing = quality.credit_quality_report(df, expected=V.APPLICANT_COLUMNS + ["Other"])
    assert {r["rule"]: r["message"] for r in missing.collect()}["required_columns"] == "Missing columns: ['Other']"


def test_missing_and_infinite_values(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (NAN, None), (INF, "c"), (-INF, "d")], "x double, s string")
    assert [(r["column"], r["missing_count"]) for r in quality.missing_values(df).collect()] == [("x", 2), ("s", 1)]
    assert quality.infinite_values(df).first()["infinite_count"] == 2
    cleaned = [r["x"] for r in quality.fill_numeric(quality.infinite_to_null(df)).collect()]
    assert cleaned == [1.0, 0.0, 0.0, 0.0, 0.0]
    assert quality.numeric_gate(df.limit(1)).count() == 1
    with pytest.raises(Exception, match="remain after feature engineering"):
        quality.numeric_gate(df).collect()


def test_column_checks(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="missing: c"):
        quality.require_columns(df, ["a", "c"])
    assert quality.unexpected_columns(df, ["a"]) == ["b"]
    with pytest.raises(ValueError, match="aligned"):
        quality.check_aligned(df, df.select("b", "a"))
    with pytest.raises(ValueError, match="outside 0/1"):
        quality.require_binary_target(df, "b")


def test_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,), (1.0,)], "x double")
    row = quality.profile_columns(df).first()
    assert (row["null_count"], row["null_percentage"], row["unique_count"], row["row_count"]) == (2, 50.0, 1, 4)
    empty = quality.profile_numeric(spark.createDataFrame([(None,)], "x double")).first()
    assert (empty["mean"], empty["minimum"], empty["missing"]) == (None, None, 1)


def test_unknown_checks_are_no_violation(spark):
    df = spark.createDataFrame([("Male", "k1"), (None, "k1"), ("X", None), ("Female", None)], "gender string, customer_code string")
    found = {r["constraint_name"]: r["violations"] for r in quality.check_constraints(
        df, "customers", schemas.table_checks("customers", df.columns), schemas.table_unique("customers", df.columns)).collect()}
    assert found == {"allowed_gender": 1, "unique_customer_code": 1}


def test_credit_and_fraud_edges_differ(spark):
    df = applicants(spark, {V.UTILIZATION: 0.80, "DebtRatio": 0.50, V.LATE_30_59: 1},
                    {V.UTILIZATION: 0.81, "DebtRatio": 0.51, V.LATE_30_59: 1, V.LATE_90: 1, "MonthlyIncome": None, V.DEPENDENTS: None},
                    {V.DEPENDENTS: -1.0, "MonthlyIncome": 3000.0})
    order = [F.col("age"), F.col(V.UTILIZATION).desc()]
    high, edge, plain = features.credit_features(df).orderBy(*order).collect()
    assert (edge["HighCreditUtilization"], edge["HighDebtRatio"], edge["RiskIndicator"]) == (0, 0, 1)
    assert (high["RiskIndicator"], high["MonthlyIncome"], high[V.DEPENDENTS], high["IncomePerDependent"]) == (4, 2000.0, 0.0, 2000.0)
    assert plain["IncomePerDependent"] is None
    high, edge, plain = features.fraud_features(df).orderBy(*order).collect()
    assert (edge["HighCreditUtilization"], edge["HighDebtRatio"], edge["RiskIndicator"]) == (1, 1, 2)  # one event is not two
    assert (high["RiskIndicator"], high["MonthlyIncome"], high["IncomePerDependent"]) == (4, None, 0.0)
    assert plain["IncomePerDependent"] == 3000.0


def test_nan_is_missing_not_large(spark):
    df = applicants(spark, {V.UTILIZATION: NAN, "DebtRatio": NAN, "MonthlyIncome": NAN}, {"MonthlyIncome": 700.0})
    for build in (features.credit_features, features.fraud_features):
        row = build(df).where(F.col(V.UTILIZATION).isNull()).first()
        assert (row["HighCreditUtilization"], row["HighDebtRatio"]) == (0, 0)
    assert {r["MonthlyIncome"] for r in features.credit_features(df).collect()} == {700.0}


def test_income_median_can_come_from_training_rows_only(spark):
    df = applicants(spark, {"MonthlyIncome": None}, {"MonthlyIncome": 10.0})
    train = applicants(spark, {"MonthlyIncome": 500.0})
    assert {r["MonthlyIncome"] for r in features.credit_features(df, fit_on=train).collect()} == {500.0, 10.0}


def test_time_parts(spark):
    df = spark.createDataFrame([("2024-06-01 13:00:00",), ("2024-06-02 00:00:00",), ("2024-06-03 23:59:59",), ("soon",)], "timestamp string")
    rows = features.time_features(df).collect()
    assert [(r["transaction_day_of_week"], r["is_weekend"]) for r in rows] == [(5, 1), (6, 1), (0, 0), (None, 0)]
    assert rows[0]["transaction_hour"] == 13


def test_amount_features_guard_zero_and_negative(spark):
    df = spark.createDataFrame([(10.0, 0.0), (0.0, 5.0), (-3.0, 2.0)], "amount_received double, amount_paid double")
    rows = features.amount_features(df).collect()
    assert [r["amount_ratio"] for r in rows] == [0.0, 0.0, -1.5]
    assert rows[2]["log_amount_received"] == 0.0


def test_relations_with_unknown_sides(spark):
    df = spark.createDataFrame([("A", "A"), ("A", None), (None, None)], "from_country string, to_country string").selectExpr(
        "*", "'USD' as payment_currency", "'USD' as receiving_currency", "'1' as from_bank", "'1' as to_bank", "'x' as from_account", "'y' as to_account")
    rows = features.relation_flags(df).collect()
    assert [(r["cross_border_transaction"], r["same_country"]) for r in rows] == [(0, 1), (1, 0), (1, 0)]


def requests(spark, *rows):
    schema = "request_id long, customer_id string, transaction_amount string, country_from string, country_to string, currency string"
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def test_request_cases(spark):
    """Low risk, high value abroad, plain transfer abroad, negative amount, text amount, all defaults."""
    checked = quality.validate_requests(requests(
        spark, ("C1", "1000", "US", "US", "USD"), ("C1", "15000", " us ", "HK", "usd"), ("C1", "5000", "US", "GB", "USD"),
        ("C1", "-100", "US", "US", "USD"), ("C1", "invalid", "US", "US", "USD"), (None, None, None, None, None)))
    assert [r["is_valid"] for r in checked.orderBy("request_id").collect()] == [True, True, True, False, False, True]
    stored = spark.createDataFrame(
        [("C1", 0.02, "Low Risk", "LOW_RISK", 0.01, "Low Risk", "LOW_RISK", 0.001, "LOW RISK", "LOW_RISK")],
        "customer_id string, " + ", ".join(f"{d}_probability double, {d}_segment string, {d}_decision string" for d in V.DRIVER_ORDER))
    rows = integrated.assess_requests(checked.where("is_valid"), stored).orderBy("request_id").collect()
    low, abroad_high, abroad, default = rows
    assert (low["risk_tier"], low["alert_status"], low["approved"]) == ("LOW", "NO_ALERT", True)
    assert (abroad_high["high_value"], abroad_high["cross_border"], abroad_high["country_from"], abroad_high["currency"]) == (True, True, "US", "USD")
    assert abroad_high["aml_score"] == pytest.approx(15.1) and abroad_high["top_risk_driver"] == "aml_risk"
    assert (abroad["high_value"], abroad["cross_border"]) == (False, True)
    assert (default["customer_id"], default["transaction_amount"], default["credit_segment"], default["overall_score"]) == (
        "DEMO-CUSTOMER", 1000.0, "UNKNOWN", 0.0)


def test_integrated_priorities_and_ties(spark):
    rows = [(1, 1.0, 1.0, 1.0), (2, 0.0, 0.0, 0.0), (3, 0.0, 0.5, 0.0), (4, 0.0, 0.0, 0.5), (5, 0.5, 0.0, 0.0), (6, 0.0, 0.6, 0.6)]
    domains = spark.createDataFrame(rows, "customer_id long, credit double, fraud double, aml double").select(
        "customer_id", *[(F.col(d) * 100).alias(f"{d}_score") for d in V.DRIVER_ORDER])
    found = integrated.integrated_assessment(domains).orderBy("customer_id").collect()
    assert [r["alert_status"] for r in found] == [
        "CRITICAL_ALERT", "NO_ALERT", "FRAUD_ALERT", "AML_ALERT", "CREDIT_RISK_ALERT", "FRAUD_ALERT"]
    assert [r["top_risk_driver"] for r in found] == [
        "credit_risk", "credit_risk", "fraud_risk", "aml_risk", "credit_risk", "fraud_risk"]


def test_derived_scores_are_not_scaled_twice(spark):
    tiny = spark.createDataFrame([(1, 0.005)], "customer_id long, default_probability double")
    assert integrated.extract_domain(tiny, "credit").first()["credit_score"] == pytest.approx(0.5)
    given = spark.createDataFrame([(1, "12%", "0.4")], "customer_id long, pd string, risk_score string")
    row = integrated.extract_domain(given, "credit").first()
    assert (row["credit_probability"], row["credit_score"], row["credit_decision"]) == (0.12, 40.0, "UNKNOWN")


def test_duplicates_are_counted_exactly_whatever_the_fingerprints(spark):
    rows = [(1, None, 0.0), (1, None, -0.0), (1, "a", None), (None, "a", None), (None, None, None), (None, None, None), (None, None, None), (2, "b", 1.0)]
    df = spark.createDataFrame(rows, "x int, y string, z double").repartition(3)
    for fingerprint in (quality.row_fingerprint, lambda d: [F.lit(1), F.lit(2)], lambda d: [F.col("x"), F.lit(2)]):
        found = quality.duplicate_count(df.na.fill({"x": 0}), fingerprint).first()
        assert tuple(found) == (8, 3)
    assert tuple(quality.duplicate_count(df.limit(0)).first()) == (0, 0)
    assert {r["duplicate_rows"] for r in quality.profile_columns(df).collect()} == {3}


def test_defaults_reach_left_out_columns(spark):
    schema = T._parse_datatype_string("card_id long, card_status string, daily_transaction_limit decimal(18,2), contactless_enabled boolean, issue_date date")
    given = spark.createDataFrame([(1, None), (2, "Blocked")], "card_id long, card_status string")
    defaults = {"card_status": "Active", "daily_transaction_limit": 50000, "contactless_enabled": True}
    filled = quality.apply_defaults(given, defaults, schema)
    assert [tuple(r) for r in filled.orderBy("card_id").collect()] == [
        (1, "Active", Decimal("50000.00"), True, None), (2, "Blocked", Decimal("50000.00"), True, None)]
    assert dict(filled.dtypes)["issue_date"] == "date"
    assert quality.apply_defaults(given, defaults).columns == ["card_id", "card_status"]


def test_unexpected_columns_are_reported_with_their_values(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, float("nan"), "x")], "a int, `b.c` double, d string")
    assert {tuple(r) for r in quality.unexpected_report(df, ["a"]).collect()} == {("b.c", 1), ("d", 1)}
    none = quality.unexpected_report(df, df.columns)
    assert none.count() == 0 and none.columns == ["column", "filled"]


def test_kinds_of_columns(spark):
    df = spark.createDataFrame([(1, None, True, [1])], "n int, s string, b boolean, l array<int>")
    assert {tuple(r) for r in quality.column_types(df).collect()} == {
        ("n", "numeric", 1), ("s", "categorical", 0), ("b", "boolean", 1), ("l", "other", 1)}
    assert {r["filled"] for r in quality.column_types(df.limit(0)).collect()} == {0}


def test_alignment_names_shifted_and_absent_columns(spark):
    left, right = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), spark.createDataFrame([(1, 2)], "a int, c int")
    found = {r["column"]: (r["train_position"], r["validation_position"], r["aligned"]) for r in quality.alignment_report(left, right).collect()}
    assert found == {"a": (0, 0, True), "b": (1, None, False), "c": (2, 1, False)}
    with pytest.raises(ValueError):
        quality.check_aligned(left, right)
