"""The four risk domains end to end: features, split, encode, train, choose, evaluate, explain."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions import bands
from riskweave.operators import features, metrics, preprocess, quality, training
from riskweave.operators.lineage import materialise
from riskweave.session import side_by_side


@dataclass
class DomainRun:
    """What a domain leaves behind; what follows from the best model's scores is worked out when it is first asked for."""

    best_model: str
    models: dict[str, Model]
    metrics: DataFrame
    scored: DataFrame
    preprocessing: preprocess.FittedColumns
    key: str
    grid: list[float]
    choose: Callable[[DataFrame], DataFrame]
    segment: Callable[[Column], Column]
    segment_order: list[str]

    @cached_property
    def sweep(self) -> DataFrame:
        return metrics.threshold_sweep(self.scored, self.grid)

    @cached_property
    def threshold(self) -> float:
        return self.choose(self.sweep).first()["threshold"]

    @cached_property
    def decided(self) -> DataFrame:
        return self.scored.select(
            self.key, F.col("label").cast("int").alias("actual_class"), "probability",
            bands.prediction_at(F.col("probability"), self.threshold).alias("prediction"),
            self.segment(F.col("probability")).alias("risk_segment"),
            F.lit(self.best_model).alias("model_name"), F.lit(self.threshold).alias("operating_threshold"))

    @cached_property
    def segments(self) -> DataFrame:
        return metrics.segment_distribution(self.scored, self.segment(F.col("probability")), self.segment_order)

    @cached_property
    def importance(self) -> DataFrame:
        return training.feature_importance(
            self.scored.sparkSession, self.models[self.best_model], self.preprocessing.feature_names)


def run_domain(
    prepared: DataFrame, domain: str, target: str, key: str, numeric: list[str], categorical: list[str],
    grid: list[float], choose, segment, models: list[training.ModelSpec] | None, missing_category: bool = False,
    segment_order: list[str] = V.SEGMENTS,
) -> DomainRun:
    """Train on the training side only and report on the validation side."""
    spark = prepared.sparkSession
    models = models or training.default_models(domain)
    prepared = materialise(prepared)
    _, split = side_by_side(
        spark, lambda: quality.require_binary_target(prepared, target), lambda: preprocess.stratified_split(prepared, target, key))
    train, validation = split.where("split = 'train'"), split.where("split = 'validation'")
    fitted, counts = side_by_side(
        spark, lambda: preprocess.fit_columns(train, numeric, categorical, missing_category=missing_category),
        lambda: {r["split"]: r["count"] for r in split.groupBy("split").count().collect()})

    def encode(side: DataFrame, tasks: int) -> DataFrame:
        dealt = training.spread(side, key, tasks)
        return materialise(fitted.vectors(dealt, [key, target]).withColumn("label", F.col(target).cast("double")))

    scored_tasks = training.tasks_for(counts.get("validation", 0), training.SCORED_ROWS_WORTH_A_TASK)
    train_vectors, validation_vectors = side_by_side(
        spark, lambda: encode(train, training.tasks_for_fits(counts.get("train", 0), models)),
        lambda: encode(validation, scored_tasks))
    quality.check_aligned(train_vectors, validation_vectors)
    best, trained, table, scored = training.train_and_select(train_vectors, validation_vectors, domain, models, keep=[key])
    return DomainRun(best, trained, table, scored, fitted, key, grid, choose, segment, segment_order)


APPLICANT_NUMERIC = [c for c in V.APPLICANT_COLUMNS if c != V.APPLICANT_TARGET] + [
    c for c in V.APPLICANT_ENGINEERED if c != "AgeBand"]


def credit_run(applicants: DataFrame, key: str = "applicant_id", models=None) -> DomainRun:
    valid, _ = quality.quarantine_split(applicants)
    prepared = features.credit_features(quality.require_columns(valid, V.APPLICANT_COLUMNS))
    return run_domain(
        prepared, "credit", V.APPLICANT_TARGET, key, APPLICANT_NUMERIC, ["AgeBand"], V.CREDIT_GRID,
        lambda sweep: metrics.recall_floor_threshold(sweep, ties="high"), bands.credit_segment_closed_right, models)


def fraud_run(applicants: DataFrame, key: str = "applicant_id", models=None) -> DomainRun:
    prepared = features.fraud_features(quality.require_columns(applicants, V.APPLICANT_COLUMNS))
    return run_domain(
        prepared, "fraud", V.APPLICANT_TARGET, key, APPLICANT_NUMERIC, ["AgeBand"], V.FINE_GRID,
        metrics.fraud_business_threshold, bands.fraud_segment, models)


def transaction_fraud_run(cards: DataFrame, key: str, models=None) -> DomainRun:
    columns = V.CARD_FEATURES + [V.CARD_TARGET]
    prepared = quality.deduplicate_keyed(quality.require_columns(cards, columns).select(key, *columns), key)
    return run_domain(
        prepared, "transaction_fraud", V.CARD_TARGET, key, V.CARD_FEATURES, [], V.COARSE_GRID,
        metrics.recall_floor_threshold, bands.transaction_fraud_level, models,
        segment_order=["Low", "Medium", "High", "Critical"])


def aml_run(transfers: DataFrame, key: str = "record_key", models=None) -> DomainRun:
    # every fit of the features reads them, and their join and grouping cost more than the features
    transfers = materialise(quality.deduplicate_keyed(quality.require_columns(transfers, V.AML_COLUMNS), key))
    prepared = features.aml_features(transfers, strict=True)
    identifiers = [c for c in V.AML_IDENTIFIERS if c != key]
    prepared = preprocess.require_positives(prepared.drop(*identifiers), "is_laundering")
    numeric = [c for c in quality.numeric_columns(prepared) if c != "is_laundering"]
    categorical = [c for c in quality.categorical_columns(prepared) if c != key]
    return run_domain(
        prepared, "aml", "is_laundering", key, numeric, categorical, V.FINE_GRID,
        metrics.aml_business_threshold, lambda p: bands.aml_assessment(p)["risk_segment"], models, missing_category=True,
        segment_order=["LOW RISK", "MEDIUM RISK", "HIGH RISK"])
