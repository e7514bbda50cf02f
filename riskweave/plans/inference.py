"""Batch scoring of new rows with trained models, one function per domain."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions import bands
from riskweave.operators import features, quality, training
from riskweave.operators.preprocess import FittedColumns


def predict(prepared: DataFrame, fitted: FittedColumns, model: Model, keep: list[str]) -> DataFrame:
    """Kept columns, the key first, and probability. Missing feature columns raise, extra ones are dropped."""
    quality.require_columns(prepared, [*keep, *fitted.numeric, *fitted.categorical])
    return training.score_batch(model, fitted.vectors(training.dealt_out(prepared, keep[0]), keep), keep)


def credit_inference(applicants: DataFrame, fitted: FittedColumns, model: Model, key: str = "applicant_id",
                     fit_on: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected): valid applicants with segment and decision, the others with their reasons."""
    checked = quality.validate_applicants(features.credit_features(applicants, fit_on))
    scored = predict(checked.where("is_valid"), fitted, model, [key])
    p = F.col("probability")
    return scored.select(
        key, F.round(p, 6).alias("default_probability"), bands.credit_segment(p).alias("risk_segment"),
        bands.credit_decision(p).alias("credit_decision"), F.lit(V.CREDIT_BUSINESS_THRESHOLD).alias("business_threshold"),
        bands.prediction_at(p, V.CREDIT_BUSINESS_THRESHOLD).alias("default_prediction"),
    ), rejected_applicants(applicants, key, fit_on)


def rejected_applicants(applicants: DataFrame, key: str = "applicant_id", fit_on: DataFrame | None = None) -> DataFrame:
    """Applicants that are not scored, with their reasons."""
    checked = quality.validate_applicants(features.credit_features(applicants, fit_on))
    return checked.where(~F.col("is_valid")).select(key, "rejection_reasons")


def fraud_inference(applicants: DataFrame, fitted: FittedColumns, model: Model, key: str = "applicant_id",
                    threshold: float = V.FRAUD_BUSINESS_THRESHOLD) -> DataFrame:
    scored = predict(features.fraud_features(applicants), fitted, model, [key])
    p = F.col("probability")
    return scored.select(
        key, F.round(p, 6).alias("fraud_probability"), bands.fraud_segment(p).alias("risk_segment"),
        bands.fraud_decision(p, threshold).alias("fraud_decision"), F.lit(threshold).alias("business_threshold"),
        bands.prediction_at(p, threshold).alias("fraud_prediction"))


def transaction_fraud_inference(cards: DataFrame, fitted: FittedColumns, model: Model, key: str, threshold: float) -> DataFrame:
    scored = predict(cards, fitted, model, [key, V.CARD_TARGET])
    p = F.col("probability")
    return scored.select(
        key, p.alias("fraud_probability"), bands.prediction_at(p, threshold).alias("fraud_prediction"),
        bands.transaction_fraud_level(p).alias("risk_level"), F.col(V.CARD_TARGET).alias("actual_class"),
        F.lit(threshold).alias("operating_threshold"))


def aml_inference(transfers: DataFrame, fitted: FittedColumns, model: Model, high_value_limit: float,
                  key: str = "record_key", threshold: float = V.DEFAULT_THRESHOLD) -> DataFrame:
    """Transfers are encoded with the formats and the high-value limit of the training data."""
    prefix = "payment_format_"
    formats = [c[len(prefix):] for c in fitted.numeric if c.startswith(prefix)]
    prepared = features.aml_features(transfers, formats=formats, high_value_limit=high_value_limit)
    scored = predict(prepared, fitted, model, [key])
    assessed = scored.withColumn("a", bands.aml_assessment(F.col("probability"), threshold))
    return assessed.select(key, F.col("probability").alias("aml_probability"), "a.*")
