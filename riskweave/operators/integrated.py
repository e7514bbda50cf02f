"""Integrated risk: domain scores combined per customer, and request-level assessment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.conditions import band, differs, flag
from riskweave.functions.normalise import (
    clean_decision, first_present, normalize_probability, normalize_score, normalize_segment,
)


def extract_domain(df: DataFrame, domain: str) -> DataFrame:
    """A domain's delivery under any of its known column names, reduced to four typed columns.

    A laundering delivery also has its own alert, ``aml_alert_status``, NO_ALERT where it brings none.
    A score that is delivered is normalised as it comes; a score that has to be derived is the
    probability in percent and is not scaled a second time.
    """
    schema = df.schema
    probability = normalize_probability(
        first_present(schema, V.PROBABILITY_ALIASES[domain], F.lit(None).cast("string")))
    delivered = first_present(schema, V.SCORE_ALIASES[domain], F.lit(None).cast("string"))
    score = F.when(delivered.isNotNull(), normalize_score(delivered)).otherwise(probability * 100)
    unknown = F.lit("UNKNOWN")
    alert = [first_present(schema, V.ALERT_ALIASES, F.lit(V.NO_ALERT)).cast("string").alias("aml_alert_status")]
    return df.select(
        "customer_id",
        probability.alias(f"{domain}_probability"),
        score.alias(f"{domain}_score"),
        first_present(schema, V.SEGMENT_ALIASES[domain], unknown).cast("string").alias(f"{domain}_segment"),
        first_present(schema, V.DECISION_ALIASES[domain], unknown).cast("string").alias(f"{domain}_decision"),
        *(alert if domain == "aml" else []),
    )


def combine_domains(credit: DataFrame, fraud: DataFrame, aml: DataFrame) -> DataFrame:
    """One row per customer known to any domain; what a domain does not know is 0 and UNKNOWN."""
    joined = (
        extract_domain(credit, "credit")
        .join(extract_domain(fraud, "fraud"), "customer_id", "full")
        .join(extract_domain(aml, "aml"), "customer_id", "full")
    )
    numbers = {f"{d}_{kind}": 0.0 for d in V.DRIVER_ORDER for kind in ("probability", "score")}
    labels = {f"{d}_{kind}": "UNKNOWN" for d in V.DRIVER_ORDER for kind in ("segment", "decision")}
    return joined.fillna(numbers).fillna({**labels, "aml_alert_status": V.NO_ALERT})


def weighted_score(credit: Column, fraud: Column, aml: Column, weights: dict[str, float] = V.WEIGHTS) -> Column:
    return F.round(credit * weights["credit"] + fraud * weights["fraud"] + aml * weights["aml"], 4)


def tier(score: Column) -> Column:
    return band(score, V.TIERS, V.TIER_ELSE)


def alert_status(overall: Column, domain_scores: dict[str, Column]) -> Column:
    """Overall score first, then fraud, laundering and credit, in that order."""
    chain = None
    for edge, label in V.OVERALL_ALERTS:
        chain = F.when(overall >= edge, label) if chain is None else chain.when(overall >= edge, label)
    for domain, label in V.DOMAIN_ALERTS:
        chain = chain.when(domain_scores[domain] >= V.DOMAIN_ALERT_SCORE, label)
    return chain.otherwise(V.NO_ALERT)


def top_driver(scores: dict[str, Column]) -> Column:
    """Domain with the highest score; on ties the earlier of credit, fraud, laundering."""
    highest = F.greatest(*[scores[d] for d in V.DRIVER_ORDER])
    chain = F.when(scores[V.DRIVER_ORDER[0]] >= highest, f"{V.DRIVER_ORDER[0]}_risk")
    for domain in V.DRIVER_ORDER[1:]:
        chain = chain.when(scores[domain] >= highest, f"{domain}_risk")
    return chain


def integrated_assessment(domains: DataFrame) -> DataFrame:
    """Adds overall score, tier, alert status, alert flag and top driver."""
    scores = {d: F.col(f"{d}_score") for d in V.DRIVER_ORDER}
    return (
        domains.withColumn("overall_risk_score", weighted_score(scores["credit"], scores["fraud"], scores["aml"]))
        .withColumns({
            "risk_tier": tier(F.col("overall_risk_score")),
            "alert_status": alert_status(F.col("overall_risk_score"), scores),
            "top_risk_driver": top_driver(scores),
        })
        .withColumn("alert_triggered", F.col("alert_status") != V.NO_ALERT)
    )


def risk_components(assessed: DataFrame, weights: dict[str, float] = V.WEIGHTS) -> DataFrame:
    """Three rows per customer, one per domain."""
    rows = F.array(*[
        F.struct(
            F.lit(V.DOMAIN_TITLES[d]).alias("risk_domain"),
            F.col(f"{d}_score").alias("risk_score"),
            F.col(f"{d}_probability").alias("probability"),
            F.col(f"{d}_segment").alias("risk_segment"),
            F.col(f"{d}_decision").alias("decision"),
            F.lit(weights[d]).alias("weight"),
        ) for d in V.DRIVER_ORDER
    ])
    return assessed.select("customer_id", F.inline(rows))


SAVED = {
    "overall_risk_score": ("saved_engine_score", 0.0),
    "risk_tier": ("saved_engine_risk_tier", "UNKNOWN"),
    "alert_status": ("saved_engine_alert_status", V.NO_ALERT),
    "top_risk_driver": ("saved_engine_top_risk_driver", "UNKNOWN"),
}


def assess_requests(
    requests: DataFrame, assessments: DataFrame, review_decisions: list[str] = V.REVIEW_DECISIONS
) -> DataFrame:
    """Request-aware assessment: stored domain results plus the risk of the transfer itself.

    One equi-join and a projection; customers without stored results count as 0 and UNKNOWN.
    """
    stored = ["credit", "fraud", "aml"]
    saved = {old: new for old, (new, _) in SAVED.items() if old in assessments.columns}
    domain_columns = [f"{d}_{kind}" for d in stored for kind in ("probability", "segment", "decision")]
    known = assessments.select("customer_id", *domain_columns, *[F.col(old).alias(new) for old, new in saved.items()])
    joined = requests.join(known, "customer_id", "left").fillna({new: default for new, default in SAVED.values() if new in saved.values()})
    shares = {d: F.coalesce(F.col(f"{d}_probability"), F.lit(0.0)) for d in stored}
    decisions = {d: clean_decision(F.col(f"{d}_decision")) for d in stored}
    prepared = joined.withColumns({
        "country_from": F.upper(F.trim("country_from")),
        "country_to": F.upper(F.trim("country_to")),
        "currency": F.upper(F.trim("currency")),
        **{f"{d}_probability": shares[d] for d in stored},
        **{f"{d}_segment": normalize_segment(F.col(f"{d}_segment")) for d in stored},
        **{f"{d}_decision": decisions[d] for d in stored},
    }).withColumns({
        "cross_border": differs(F.col("country_from"), F.col("country_to")),
        "high_value": F.col("transaction_amount") >= V.HIGH_VALUE_REQUEST,
    })
    factor = flag(F.col("high_value")) * V.HIGH_VALUE_FACTOR + flag(F.col("cross_border")) * V.CROSS_BORDER_FACTOR
    scored = prepared.withColumn("transaction_factor", factor).withColumns({
        "credit_score": F.col("credit_probability") * 100,
        "fraud_score": F.col("fraud_probability") * 100,
        "aml_score": F.least(F.lit(100.0), F.col("aml_probability") * 100 + F.col("transaction_factor")),
    })
    scores = {d: F.col(f"{d}_score") for d in stored}
    asks_review = F.col("risk_tier").isin("HIGH", "CRITICAL")
    for d in stored:
        asks_review = asks_review | F.col(f"{d}_decision").isin(review_decisions)
    return (
        scored.withColumn("overall_score", F.greatest(*scores.values()))
        .withColumns({"risk_tier": tier(F.col("overall_score")), "top_risk_driver": top_driver(scores)})
        .withColumn("alert_status", F.when(asks_review, "REVIEW_REQUIRED").otherwise(V.NO_ALERT))
        .withColumn("approved", (F.col("risk_tier") == V.TIER_ELSE) & (F.col("alert_status") == V.NO_ALERT))
        .withColumns({
            "requires_review": ~F.col("approved"),
            "reason": F.when(F.col("approved"), V.APPROVED_REASON).otherwise(V.REVIEW_REASON),
        })
    )
