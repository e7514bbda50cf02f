"""Master data derived from a customer key: customers, addresses, KYC, accounts, branches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.bands import modulo_risk
from riskweave.functions.normalise import padded
from riskweave.operators.joins import assign_branch


def branch_rows(spark: SparkSession, prefix: str = "BR") -> DataFrame:
    rows = [
        (i, f"{prefix}{i:03d}", f"{city} Branch", city, state, region, f"{prefix}IFS{i:06d}", "Active")
        for i, (city, state, region) in enumerate(V.SEED_CITIES, start=1)
    ]
    return spark.createDataFrame(
        rows, "branch_id long, branch_code string, branch_name string, city string, state string, "
              "region string, ifsc_code string, branch_status string")


def seed_keys(spark: SparkSession, count: int = 500) -> DataFrame:
    return spark.range(1, count + 1).withColumnRenamed("id", "customer_id")


def customers_for(keys: DataFrame, mail_domain: str = "bank.example") -> DataFrame:
    """One customer per ``customer_id``."""
    key = F.col("customer_id")
    text = key.cast("string")
    return keys.select(
        key,
        F.concat(F.lit("CUST"), padded(text, 6)).alias("customer_code"),
        F.lit("Customer").alias("first_name"),
        F.concat(F.lit("Demo"), text).alias("last_name"),
        F.date_add(F.lit("1980-01-01").cast("date"), ((key * 137) % 12000).cast("int")).alias("date_of_birth"),
        F.when(key % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.concat(F.lit("customer"), text, F.lit(f"@{mail_domain}")).alias("email"),
        F.concat(F.lit("9"), padded(text, 9)).alias("mobile_number"),
        F.concat(F.lit("ABCDE"), padded(text, 4), F.lit("F")).alias("pan_number"),
        F.when(key % 10 == 0, "Corporate").otherwise("Individual").alias("customer_type"),
        modulo_risk(key).alias("risk_category"),
        F.lit("Verified").alias("kyc_status"),
        F.lit("Active").alias("record_status"),
    )


def _by_city(field: int) -> Column:
    position = F.pmod(F.col("customer_id") - 1, F.lit(5))
    chain = F.when(position == 0, V.SEED_CITIES[0][field])
    for i in (1, 2, 3):
        chain = chain.when(position == i, V.SEED_CITIES[i][field])
    return chain.otherwise(V.SEED_CITIES[4][field])


def addresses_for(customers: DataFrame) -> DataFrame:
    key = F.col("customer_id")
    return customers.where(F.col("customer_code").like("CUST%")).select(
        key,
        F.lit("Permanent").alias("address_type"),
        F.concat(F.lit("Demo Address "), key.cast("string")).alias("address_line_1"),
        F.lit(None).cast("string").alias("address_line_2"),
        _by_city(0).alias("city"),
        _by_city(1).alias("state"),
        padded((key + 100000).cast("string"), 6).alias("postal_code"),
        F.lit("India").alias("country"),
    )


def kyc_for(customers: DataFrame, as_of: Column) -> DataFrame:
    """One KYC record per customer; Aadhaar numbers are padded from the key so they stay unique."""
    key = F.col("customer_id")
    return customers.where(F.col("customer_code").like("CUST%")).select(
        key,
        "pan_number",
        padded(key.cast("string"), 12).alias("aadhaar_number"),
        F.lit(True).alias("pan_verified"),
        F.lit(True).alias("aadhaar_verified"),
        F.date_sub(as_of, (key % 1000).cast("int")).alias("kyc_completion_date"),
        F.date_add(as_of, 365).alias("kyc_expiry_date"),
        modulo_risk(key).alias("risk_rating"),
        F.lit(False).alias("pep_flag"),
        F.lit(False).alias("sanctions_flag"),
    )


def accounts_for(customers: DataFrame, branches: DataFrame, as_of: Column) -> DataFrame:
    key = F.col("customer_id")
    placed = assign_branch(customers.where(F.col("customer_code").like("CUST%")), branches)
    balance = (F.lit("10000.00").cast("decimal(18,2)") + key * F.lit("125.50").cast("decimal(5,2)")).cast("decimal(18,2)")
    return placed.select(
        F.concat(F.lit("AC"), padded(key.cast("string"), 10)).alias("account_number"),
        key,
        "branch_id",
        F.when(key % 10 == 0, "Current").otherwise("Savings").alias("account_type"),
        F.lit("Active").alias("account_status"),
        balance.alias("opening_balance"),
        balance.alias("current_balance"),
        F.lit("INR").alias("currency_code"),
        F.date_sub(as_of, (key % 2000).cast("int")).alias("opened_date"),
    )
