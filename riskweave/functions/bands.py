"""Risk bands and decisions derived from a probability or a score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.conditions import band, flag


def rule_level(score: Column) -> Column:
    return band(score, V.RULE_LEVELS, V.RULE_LEVEL_ELSE)


def credit_segment(p: Column) -> Column:
    return band(p, V.CREDIT_BANDS, V.SEGMENTS[0])


def credit_decision(p: Column, threshold: float = V.CREDIT_BUSINESS_THRESHOLD, label: str = "REVIEW") -> Column:
    return F.when(p >= threshold, F.lit(label)).otherwise(F.lit("LOW_RISK"))


def credit_segment_closed_right(p: Column) -> Column:
    """Evaluation view of the credit bands: a probability on an edge stays in the lower band."""
    return (
        F.when(p <= V.CREDIT_BUSINESS_THRESHOLD, F.lit(V.SEGMENTS[0]))
        .when(p <= V.CREDIT_BEST_F1_THRESHOLD, F.lit(V.SEGMENTS[1]))
        .when(p <= V.DEFAULT_THRESHOLD, F.lit(V.SEGMENTS[2]))
        .when(p.isNotNull(), F.lit(V.SEGMENTS[3]))
    )


def credit_explain_segment(p: Column) -> Column:
    return band(p, V.CREDIT_EXPLAIN_BANDS, V.SEGMENTS[0])


def credit_category(p: Column) -> Column:
    return band(p, V.CREDIT_CATEGORIES, "LOW")


def fraud_segment(p: Column) -> Column:
    return band(p, V.FRAUD_BANDS, V.SEGMENTS[0])


def fraud_decision(p: Column, threshold=V.FRAUD_BUSINESS_THRESHOLD, label: str = "FRAUD_REVIEW") -> Column:
    """``label`` is FRAUD_REVIEW when scoring and REVIEW_REQUIRED when evaluating."""
    return F.when(p >= threshold, F.lit(label)).otherwise(F.lit("LOW_RISK"))


def transaction_fraud_level(p: Column) -> Column:
    return band(p, V.TXN_FRAUD_BANDS, "Low")


def prediction_at(p: Column, threshold) -> Column:
    return flag(p >= threshold)


def aml_assessment(p: Column, threshold: float = V.DEFAULT_THRESHOLD) -> Column:
    """Struct of segment, decision, prediction and explanation for a laundering probability."""

    def outcome(segment: str, decision: str, prediction: int) -> Column:
        return F.struct(
            F.lit(segment).alias("risk_segment"),
            F.lit(decision).alias("aml_decision"),
            F.lit(prediction).alias("aml_prediction"),
            F.lit(V.AML_EXPLANATIONS[segment]).alias("explanation"),
        )

    return (
        F.when(p >= threshold, outcome("HIGH RISK", "AML_ALERT", 1))
        .when(p >= V.AML_REVIEW_THRESHOLD, outcome("MEDIUM RISK", "REVIEW", 0))
        .otherwise(outcome("LOW RISK", "LOW_RISK", 0))
    )


def aml_business_risk(p: Column) -> Column:
    return band(p, V.AML_BUSINESS_BANDS, "LOW_RISK")


def aml_business_alert(p: Column, threshold: float = V.AML_BUSINESS_THRESHOLD) -> Column:
    return F.when(p >= threshold, F.lit("AML_ALERT")).otherwise(F.lit(V.NO_ALERT))


def age_band(age: Column, lowest: float, highest: float | None) -> Column:
    """Right-closed age bands; ages outside [lowest, highest] get null."""
    inside = age >= lowest
    if highest is not None:
        inside = inside & (age <= highest)
    chain = F.when(~F.coalesce(inside, F.lit(False)), F.lit(None).cast("string"))
    for edge, label in zip(V.AGE_UPPER_EDGES, V.AGE_LABELS):
        chain = chain.when(age <= edge, F.lit(label))
    return chain.otherwise(F.lit(V.AGE_LABELS[-1]))


def modulo_risk(key: Column) -> Column:
    """High for every 20th key, Medium for every other 5th, Low for the rest."""
    return F.when(key % 20 == 0, F.lit("High")).when(key % 5 == 0, F.lit("Medium")).otherwise(F.lit("Low"))
