"""Reporting tables: KPIs, trends, distributions, dashboards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.conditions import flag, rate
from riskweave.operators.integrated import risk_components


def _sum(cell) -> F.Column:
    return F.coalesce(F.sum(cell), F.lit(0))


def transaction_kpis(transactions: DataFrame) -> DataFrame:
    amount, status = F.col("transaction_amount"), F.col("transaction_status")
    return transactions.agg(
        F.count("*").alias("total_transactions"),
        F.sum(amount).alias("transaction_value"),
        F.avg(amount.cast("double")).alias("average_amount"),
        F.min(amount).alias("minimum_amount"),
        F.max(amount).alias("maximum_amount"),
        _sum(flag(status == "Success")).alias("successful_transactions"),
        _sum(flag(status == "Failed")).alias("failed_transactions"),
        _sum(flag(status == "Pending")).alias("pending_transactions"),
    ).withColumn("success_rate", rate(F.col("successful_transactions"), F.col("total_transactions")))


def transactions_by(transactions: DataFrame, column: str) -> DataFrame:
    """Count, value and share of transactions per value of a reporting attribute."""
    grouped = transactions.groupBy(column).agg(
        F.count("*").alias("transaction_count"), F.sum("transaction_amount").alias("transaction_value"))
    total = F.sum("transaction_count").over(Window.partitionBy())  # one row per status or channel
    return grouped.withColumn("transaction_share", rate(F.col("transaction_count"), total))


def alert_kpis(alerts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Alert counts, scores and levels; the alert rate relates them to all transactions."""
    total = transactions.agg(F.count("*").alias("n")).scalar()
    score = F.col("fraud_score").cast("double")
    return alerts.agg(
        F.count("*").alias("fraud_alerts"),
        F.avg(score).alias("average_fraud_score"),
        F.min(score).alias("minimum_fraud_score"),
        F.max(score).alias("maximum_fraud_score"),
        _sum(flag(F.col("alert_status") == "Open")).alias("open_alerts"),
        _sum(flag(F.col("risk_level") == "High")).alias("high_alerts"),
        _sum(flag(F.col("risk_level") == "Critical")).alias("critical_alerts"),
    ).withColumn("total_transactions", total).withColumn(
        "alert_rate", rate(F.col("fraud_alerts"), F.col("total_transactions")))


def kyc_kpis(kyc: DataFrame) -> DataFrame:
    return kyc.agg(
        F.count("*").alias("kyc_records"),
        *[_sum(flag(F.col(c))).alias(c) for c in ("pan_verified", "aadhaar_verified", "pep_flag", "sanctions_flag")])


def risk_mix(customers: DataFrame, merchants: DataFrame) -> DataFrame:
    """Customers and merchants per risk class."""
    parts = [
        customers.select(F.lit("customer").alias("entity"), F.col("risk_category").alias("risk")),
        merchants.select(F.lit("merchant").alias("entity"), F.col("risk_level").alias("risk")),
    ]
    return reduce(DataFrame.unionByName, [p.groupBy("entity", "risk").agg(F.count("*").alias("count")) for p in parts])


def transaction_trend(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(F.to_date("transaction_timestamp").alias("transaction_date")).agg(
        F.count("*").alias("transaction_count"), F.sum("transaction_amount").alias("transaction_value"))


def alert_trend(alerts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Alerts and average score per day of the alerted transaction."""
    dated = alerts.join(transactions.select("transaction_id", F.to_date("transaction_timestamp").alias("alert_date")),
                        "transaction_id")
    return dated.groupBy("alert_date").agg(
        F.count("*").alias("fraud_alerts"), F.avg(F.col("fraud_score").cast("double")).alias("average_fraud_score"))


def alert_matrix(alerts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Alerts by level, status and source with subtotals; ``depth`` tells how many keys are set."""
    valued = alerts.join(transactions.select("transaction_id", "transaction_amount"), "transaction_id")
    totals = valued.rollup("risk_level", "alert_status", "detection_source").agg(
        F.count("*").alias("alert_count"),
        F.avg(F.col("fraud_score").cast("double")).alias("average_fraud_score"),
        F.sum("transaction_amount").alias("fraud_amount"),
        F.grouping_id().alias("_grouping"),
    )
    depth = F.when(F.col("_grouping") == 0, 3).when(F.col("_grouping") == 1, 2).when(F.col("_grouping") == 3, 1).otherwise(0)
    everything = F.lit("(all)")
    return totals.select(
        *[F.coalesce(F.col(c), everything).alias(c) for c in ("risk_level", "alert_status", "detection_source")],
        depth.alias("depth"), "alert_count", "average_fraud_score", "fraud_amount")


def channel_risk(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Value, count, alerts and alert rate per channel."""
    alerted = alerts.groupBy("transaction_id").agg(F.count("*").alias("_alerts"))
    return (
        transactions.join(alerted, "transaction_id", "left")
        .groupBy("transaction_channel")
        .agg(F.count("*").alias("transaction_count"), F.sum("transaction_amount").alias("transaction_value"),
             _sum("_alerts").alias("fraud_alerts"))
        .withColumn("alert_rate", rate(F.col("fraud_alerts"), F.col("transaction_count")))
    )


def transaction_risk_view(scored: DataFrame) -> DataFrame:
    """The curated reporting view: one row per transaction, risk attributes, no personal data."""
    return scored.select(
        "transaction_id", "account_id", "transaction_timestamp", "transaction_type", "transaction_channel",
        "transaction_status", "transaction_amount", "customer_type", "customer_risk", "kyc_risk", "pep_flag",
        "sanctions_flag", "card_status", "merchant_risk", "merchant_country", "trusted_device", "risk_score", "risk_level")


def date_dimension(facts: DataFrame, column: str) -> DataFrame:
    """Every calendar day from the first to the last fact with its parts."""
    span = facts.agg(F.to_date(F.min(column)).alias("first"), F.to_date(F.max(column)).alias("last"))
    day = F.col("date")
    return span.select(F.explode(F.sequence("first", "last")).alias("date")).select(
        day,
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.date_format(day, "MMMM").alias("month"),
        F.month(day).alias("month_number"), F.weekofyear(day).alias("week"), F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"))


def aml_dashboard(transfers: DataFrame, model_type: str, default_threshold: float, best_f1_threshold: float,
                  business_threshold: float) -> DataFrame:
    laundering = flag(F.col("is_laundering").cast("int") == 1)
    return transfers.agg(
        F.count("*").alias("dataset_rows"),
        F.lit(len(transfers.columns)).alias("dataset_columns"),
        _sum(1 - laundering).alias("legitimate_transactions"),
        _sum(laundering).alias("laundering_transactions"),
    ).select(
        "*", (rate(F.col("laundering_transactions"), F.col("dataset_rows")) * 100).alias("laundering_rate_percent"),
        F.lit(model_type).alias("model_type"), F.lit(default_threshold).alias("default_threshold"),
        F.lit(best_f1_threshold).alias("best_f1_threshold"), F.lit(business_threshold).alias("business_threshold"))


SUMMARY_COLUMNS = [
    "customer_id", "overall_risk_score", "risk_tier", "alert_status", "alert_triggered", "top_risk_driver",
    "credit_score", "fraud_score", "aml_score", "credit_probability", "fraud_probability", "aml_probability",
]


def executive_summary(assessed: DataFrame) -> DataFrame:
    return assessed.select(*SUMMARY_COLUMNS)


def integrated_dashboard(assessed: DataFrame) -> DataFrame:
    """Summary and component rows of every customer in one long table."""
    summary = executive_summary(assessed).select("customer_id", F.lit("summary").alias("section"), *SUMMARY_COLUMNS[1:6])
    parts = risk_components(assessed).withColumn("section", F.lit("component"))
    return summary.unionByName(parts, allowMissingColumns=True)


def alert_distribution(assessed: DataFrame) -> DataFrame:
    """Customers per tier and alert status with the average overall score."""
    return assessed.groupBy("risk_tier", "alert_status").agg(
        F.count("*").alias("customers"), _sum(flag(F.col("alert_triggered"))).alias("alerts_triggered"),
        F.avg("overall_risk_score").alias("average_score"))


def stack_reports(reports: dict[str, DataFrame], key: str = "domain") -> DataFrame:
    """Report tables of several domains under each other; columns a domain lacks are null."""
    named = [df.withColumn(key, F.lit(name)) for name, df in reports.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
