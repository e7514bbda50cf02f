"""Joins of the banking model.

No broadcast hints on dimensions: accounts, customers, cards and devices grow with the
business. Spark broadcasts the sides whose size statistics allow it, sorts and merges the
others, and adaptive execution splits hot keys. What it does not do is spread a missing key,
so optional keys are spread here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NULL_SPREAD = 4096


def optional_lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, spread_by: str) -> DataFrame:
    """Left join on a nullable key whose nulls do not pile up in one task.

    Rows without a key hash to different join keys; the second condition keeps those
    stand-ins from ever matching.
    """
    stand_in = -1 - F.pmod(F.xxhash64(facts[spread_by]), F.lit(NULL_SPREAD))
    on = (F.coalesce(facts[fact_key], stand_in) == dim[dim_key]) & facts[fact_key].isNotNull()
    joined = facts.join(dim, on, "left")
    return joined.drop(dim[dim_key])


def account_holders(accounts: DataFrame, customers: DataFrame, kyc: DataFrame) -> DataFrame:
    """One narrow row per account with its holder's risk attributes.

    Joining the dimensions first means transactions are shuffled once for all three.
    """
    holders = customers.select("customer_id", "customer_type", F.col("risk_category").alias("customer_risk"))
    checks = kyc.select("customer_id", F.col("risk_rating").alias("kyc_risk"), "pep_flag", "sanctions_flag")
    return (
        accounts.select("account_id", "customer_id", "account_type")
        .join(holders, "customer_id")
        .join(checks, "customer_id", "left")
    )


def enrich_transactions(transactions, accounts, customers, cards, merchants, devices, kyc) -> DataFrame:
    """Transactions with the risk attributes of account holder, card, merchant and device."""
    base = transactions.join(account_holders(accounts, customers, kyc), "account_id")
    with_card = optional_lookup(base, cards.select(F.col("card_id").alias("_card"), "card_status"),
                                "card_id", "_card", "transaction_id")
    with_merchant = optional_lookup(
        with_card,
        merchants.select(F.col("merchant_id").alias("_merchant"), F.col("risk_level").alias("merchant_risk"),
                         F.col("country").alias("merchant_country")),
        "merchant_id", "_merchant", "transaction_id")
    return optional_lookup(with_merchant, devices.select(F.col("device_id").alias("_device"), "trusted_device"),
                           "device_id", "_device", "transaction_id")


def missing_kyc(customers: DataFrame, kyc: DataFrame, as_of: Column) -> DataFrame:
    """KYC records for the customers that have none, rated by the seed rule."""
    from riskweave.operators.seeds import kyc_for

    return kyc_for(customers.join(kyc.select("customer_id"), "customer_id", "left_anti"), as_of)


def assign_branch(customers: DataFrame, branches: DataFrame, positions: int = 5) -> DataFrame:
    """Branch at position (customer_id - 1) mod ``positions`` in branch order.

    Only the first ``positions`` branches can be addressed, so only they are ranked.
    """
    first = branches.select("branch_id").orderBy("branch_id").limit(positions)
    ranked = first.select(
        "branch_id", (F.row_number().over(Window.orderBy("branch_id")) - 1).cast("long").alias("_position")
    )
    keyed = customers.withColumn("_position", F.pmod(F.col("customer_id") - 1, F.lit(positions)))
    return keyed.join(F.broadcast(ranked), "_position", "left").drop("_position")


def star_facts(transactions, accounts, customers, kyc, cards, merchants, devices, alerts) -> DataFrame:
    """Transactions with every dimension attribute the reporting model shows; facts never drop out."""
    holders = customers.select("customer_id", "customer_type", "risk_category", "kyc_status")
    checks = kyc.select("customer_id", F.col("risk_rating").alias("kyc_risk"), "pep_flag", "sanctions_flag")
    account_dim = (
        accounts.select("account_id", "customer_id", "branch_id", "account_type", "account_status")
        .join(holders, "customer_id", "left").join(checks, "customer_id", "left")
    )
    facts = transactions.join(account_dim, "account_id", "left")
    facts = optional_lookup(facts, cards.select(F.col("card_id").alias("_card"), "card_type", "card_status"),
                            "card_id", "_card", "transaction_id")
    facts = optional_lookup(
        facts, merchants.select(F.col("merchant_id").alias("_merchant"), "merchant_category",
                                F.col("country").alias("merchant_country"), F.col("risk_level").alias("merchant_risk")),
        "merchant_id", "_merchant", "transaction_id")
    facts = optional_lookup(facts, devices.select(F.col("device_id").alias("_device"), "device_type", "trusted_device"),
                            "device_id", "_device", "transaction_id")
    per_alert = alerts.select("transaction_id", "detection_source", "fraud_score",
                              F.col("risk_level").alias("alert_level"), "alert_status")
    return facts.join(per_alert, "transaction_id", "left")
