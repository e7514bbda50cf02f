"""The transaction rule engine: score, level, reason, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.bands import rule_level
from riskweave.functions.conditions import band, flag, same
from riskweave.functions.reasons import transaction_reason


def rule_score(c=F.col) -> Column:
    """Sum of ten rule terms; anything unknown adds nothing."""

    def rated(name: str) -> Column:
        points = F.lit(0)
        for level, value in reversed(V.RISK_POINTS):
            points = F.when(c(name) == level, value).otherwise(points)
        return points

    return (
        band(c("transaction_amount"), V.AMOUNT_POINTS, 0)
        + rated("merchant_risk")
        + rated("customer_risk")
        + rated("kyc_risk")
        + flag(same(c("trusted_device"), F.lit(False))) * V.UNTRUSTED_DEVICE_POINTS
        + flag(c("card_status") == "Blocked") * V.BLOCKED_CARD_POINTS
        + flag(c("pep_flag")) * V.PEP_POINTS
        + flag(c("sanctions_flag")) * V.SANCTIONS_POINTS
        + flag(c("transaction_status").isin(V.BAD_STATUSES)) * V.BAD_STATUS_POINTS
        + flag(c("transaction_type").isin(V.SENSITIVE_TYPES)) * V.SENSITIVE_TYPE_POINTS
    )


def score_transactions(enriched: DataFrame) -> DataFrame:
    """Row-local, so the same call serves batch and stream."""
    return enriched.withColumn("risk_score", rule_score()).withColumn("risk_level", rule_level(F.col("risk_score")))


def rule_alerts(scored: DataFrame) -> DataFrame:
    """Alert rows of the transactions rated Critical or High.

    The filter asks for the score those levels start at: pushed below the projection, it
    evaluates the rules once, where a filter on the level would repeat them per band.
    """
    least_score = min(edge for edge, level in V.RULE_LEVELS if level in V.ALERT_LEVELS)
    return scored.where(F.col("risk_score") >= least_score).select(
        "transaction_id",
        F.lit(V.ALERT_SOURCE).alias("detection_source"),
        F.least(F.col("risk_score") / F.lit(100.0), F.lit(1.0)).cast("decimal(5,4)").alias("fraud_score"),
        "risk_level",
        F.lit(V.ALERT_OPEN).alias("alert_status"),
        transaction_reason().alias("investigation_notes"),
    )


ALERT_KEY = ["transaction_id", "detection_source"]


def new_alerts(alerts: DataFrame, existing: DataFrame) -> DataFrame:
    """Alerts whose transaction and source are not on record yet."""
    return alerts.join(existing.select(*ALERT_KEY), ALERT_KEY, "left_anti")


def alert_summary(alerts: DataFrame, existing: DataFrame) -> DataFrame:
    """How many alerts of a run are created, by level, and how many are skipped as known."""
    known = existing.select(*ALERT_KEY).distinct().withColumn("_known", F.lit(True))
    marked = alerts.join(known, ALERT_KEY, "left")
    fresh = F.col("_known").isNull()
    return marked.agg(
        F.coalesce(F.sum(flag(fresh & (F.col("risk_level") == "Critical"))), F.lit(0)).alias("critical_created"),
        F.coalesce(F.sum(flag(fresh & (F.col("risk_level") == "High"))), F.lit(0)).alias("high_created"),
        F.coalesce(F.sum(flag(fresh)), F.lit(0)).alias("total_created"),
        F.coalesce(F.sum(flag(~fresh)), F.lit(0)).alias("skipped"),
    )
