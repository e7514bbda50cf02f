"""Row-level explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.bands import aml_assessment, aml_business_alert, aml_business_risk
from riskweave.functions.bands import credit_decision, credit_segment, fraud_segment
from riskweave.functions.conditions import flag, rate
from riskweave.functions.normalise import to_number
from riskweave.functions.reasons import aml_reasons, credit_reasons, fraud_reasons


def explain_credit(scored: DataFrame, probability: str = "probability") -> DataFrame:
    p = F.col(probability)
    labelled = scored.withColumns({"risk_segment": credit_segment(p), "credit_decision": credit_decision(p)})
    return labelled.withColumn("reasons", credit_reasons(p, F.col("risk_segment"), F.col("credit_decision")))


def explain_fraud(scored: DataFrame, probability: str = "probability") -> DataFrame:
    p = F.col(probability)
    return scored.withColumn("risk_segment", fraud_segment(p)).withColumn("reasons", fraud_reasons(p, F.col("risk_segment")))


def explain_aml(features: DataFrame) -> DataFrame:
    return features.withColumn("reasons", aml_reasons())


def explain_features(rows: DataFrame, importance: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The row's own value for each of the model's ``k`` most important features.

    Model names lose their ``numeric__`` or ``categorical__`` prefix; an encoded category is no
    column of the row, so its value is null.
    """
    top = [r for r in importance.orderBy("rank").limit(k).collect()]

    def clean(name: str) -> str:
        for prefix in ("numeric__", "categorical__"):
            if name.startswith(prefix):
                return name[len(prefix):]
        return name

    entries = [
        F.struct(
            F.lit(clean(r["feature"])).alias("feature"),
            F.lit(r["feature"]).alias("model_feature"),
            (F.col(f"`{clean(r['feature'])}`").cast("string") if clean(r["feature"]) in rows.columns
             else F.lit(None).cast("string")).alias("row_value"),
            F.round(F.lit(r["importance"]), 6).alias("importance"),
            F.lit(r["rank"]).alias("rank"),
        ) for r in top
    ]
    return rows.select(key, F.inline(F.array(*entries)))


def aml_report(scored: DataFrame, key: str = "record_key", probability: str = "probability",
               default_threshold: float = 0.50, best_f1_threshold: float = 0.01, business_threshold: float = 0.01,
               model_type: str = "logistic_regression") -> DataFrame:
    """Business report with one row per transfer: segment, risk, alert, thresholds, explanation."""
    p = F.col(probability)
    assessed = scored.withColumn("_a", aml_assessment(p, default_threshold))
    return assessed.select(
        key,
        F.lit(model_type).alias("model_type"),
        F.round(p, 8).alias("aml_probability"),
        F.round(p * 100, 6).alias("aml_probability_percent"),
        F.col("_a.aml_prediction").alias("model_prediction"),
        F.col("_a.aml_decision").alias("model_decision"),
        F.col("_a.risk_segment").alias("risk_segment"),
        aml_business_risk(p).alias("business_risk"),
        aml_business_alert(p, business_threshold).alias("alert_status"),
        (aml_business_alert(p, business_threshold) == "AML_ALERT").alias("requires_review"),
        F.col("_a.explanation").alias("business_explanation"),
        F.lit(default_threshold).alias("default_threshold"),
        F.lit(best_f1_threshold).alias("best_f1_threshold"),
        F.lit(business_threshold).alias("business_threshold"),
    )


def aml_alerts(report: DataFrame, key: str = "record_key") -> DataFrame:
    """Alert table: one row per transfer with its review flag."""
    return report.select(
        F.concat(F.lit("AML-"), F.col(key)).alias("alert_id"),
        "aml_probability", F.col("business_risk").alias("risk_segment"), "alert_status",
        F.col("model_decision").alias("aml_decision"), "requires_review")


def report_features(importance: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most important features of a delivered importance table, under any of its known column names.

    Values that are no number are left out; a table without a known column gives no features. Equal values come by name.
    """
    known = {name.lower(): name for name in importance.columns}
    value = next((known[n] for n in V.IMPORTANCE_COLUMNS if n in known), None)
    name = next((known[n] for n in V.FEATURE_COLUMNS if n in known), None)
    if value is None or name is None:
        return importance.sparkSession.createDataFrame([], "feature string, importance double")
    numbers = importance.select(F.col(f"`{name}`").cast("string").alias("feature"), to_number(F.col(f"`{value}`")).alias("importance"))
    usable = F.col("importance").isNotNull() & ~F.isnan("importance")
    return numbers.where(usable).orderBy(F.desc("importance"), "feature").limit(k).withColumn("importance", F.round("importance", 6))


def rate_gaps(df: DataFrame, label: str, flags: list[str]) -> DataFrame:
    """Per 0/1 feature how far its share among the labelled rows is from that among the others: a model-free importance."""
    hit = flag(F.col(label).cast("int") == 1)
    counts = df.agg(F.sum(hit).alias("_yes"), F.sum(1 - hit).alias("_no"), *[
        F.sum(F.col(f"`{f}`") * side).alias(f"{f}_{n}") for f in flags for n, side in (("yes", hit), ("no", 1 - hit))])
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(f).alias("feature"),
        F.abs(rate(F.col(f"`{f}_yes`"), F.col("_yes")) - rate(F.col(f"`{f}_no`"), F.col("_no"))).alias("importance")) for f in flags])))
