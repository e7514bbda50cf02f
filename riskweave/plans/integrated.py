"""Integrated risk end to end: domain deliveries to assessment, dashboard and request answers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators import integrated, quality, reports


@dataclass
class IntegratedRun:
    assessed: DataFrame
    summary: DataFrame
    components: DataFrame
    alerts: DataFrame


def integrated_run(credit: DataFrame, fraud: DataFrame, aml: DataFrame) -> IntegratedRun:
    """``credit``, ``fraud`` and ``aml`` hold one row per ``customer_id`` under their usual names."""
    assessed = integrated.integrated_assessment(integrated.combine_domains(credit, fraud, aml))
    return IntegratedRun(
        assessed, reports.executive_summary(assessed), integrated.risk_components(assessed), reports.alert_distribution(assessed))


def answer_requests(raw: DataFrame, assessed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers, rejected requests)."""
    checked = quality.validate_requests(raw)
    stored = assessed.withColumn("customer_id", F.col("customer_id").cast("string"))
    return integrated.assess_requests(checked.where("is_valid"), stored), checked.where(~F.col("is_valid"))
