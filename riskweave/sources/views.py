"""Domain views over the input tables.

Each view is a projection or join of the given tables, so its size grows with them. Where the
tables lack an attribute it is derived from a key by a fixed rule.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.bands import aml_assessment, credit_decision, credit_segment, fraud_decision, fraud_segment, modulo_risk
from riskweave.functions.normalise import padded
from riskweave.operators import seeds
from riskweave.operators.aml_rules import RULE_SCHEMA
from riskweave.operators.joins import enrich_transactions
from riskweave.operators.rules import rule_alerts, score_transactions

AS_OF = "2024-06-30"
PREVIOUS_RUN_BEFORE = "1996-01-01"


def _case(value: Column, cases: dict, otherwise: str | None = None) -> Column:
    chain = None
    for key, label in cases.items():
        chain = F.when(value == key, label) if chain is None else chain.when(value == key, label)
    return chain if otherwise is None else chain.otherwise(otherwise)


def _money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def _hundredths(value: Column) -> Column:
    """A number with two decimals as a whole number of hundredths."""
    return F.floor(value * 100 + 0.5)


def _whole(value: Column, divisor: int) -> Column:
    """Integer division of a non-negative whole number."""
    return F.floor(value / divisor)


def _value_probability() -> Column:
    """An event's value as a share of 200, in steps of a thousandth."""
    return F.least(_whole(_hundredths(F.col("value")), 20), F.lit(1000)) / F.lit(1000.0)


class Views:
    """Lazy views over one folder of input tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.as_of = F.lit(AS_OF).cast("date")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Input table; its footer is read once per instance."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # --- banking tables ----------------------------------------------------------------------
    @cached_property
    def supplier_count(self) -> Column:
        return self.table("supplier").agg(F.count("*").alias("n")).scalar()

    @cached_property
    def transactions(self) -> DataFrame:
        key = F.col("o_orderkey")
        status = (
            F.when(key % 97 == 0, "Reversed").when(F.col("o_orderstatus") == "F", "Success")
            .when(F.col("o_orderstatus") == "P", "Pending").when(key % 10 == 0, "Failed").otherwise("Success")
        )
        return self.table("orders").select(
            key.alias("transaction_id"),
            F.concat(F.lit("TXN"), padded(key.cast("string"), 15)).alias("transaction_reference"),
            F.col("o_custkey").alias("account_id"),
            F.when(key % 4 != 3, F.col("o_custkey")).alias("card_id"),
            F.when(key % 10 != 0, key % self.supplier_count).alias("merchant_id"),
            F.when(key % 7 != 0, key % 50).alias("device_id"),
            F.col("o_orderdate").cast("timestamp").alias("transaction_timestamp"),
            _case(F.substring("o_orderpriority", 1, 1),
                  {"1": "RTGS", "2": "Cash Withdrawal", "3": "Purchase", "4": "UPI", "5": "NEFT"}).alias("transaction_type"),
            _case(key % 5, {0: "ATM", 1: "POS", 2: "Mobile", 3: "Internet Banking", 4: "Branch"}).alias("transaction_channel"),
            F.when(key % 2 == 0, "D").otherwise("C").alias("debit_credit"),
            _money(F.col("o_totalprice")).alias("transaction_amount"),
            F.lit("INR").alias("currency_code"),
            status.alias("transaction_status"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        return seeds.customers_for(self.table("customer").select(F.col("c_custkey").alias("customer_id")))

    @cached_property
    def branches(self) -> DataFrame:
        region = F.col("r_regionkey")
        return self.table("region").select(
            (region + 1).cast("long").alias("branch_id"),
            F.concat(F.lit("BR"), padded((region + 1).cast("string"), 3)).alias("branch_code"),
            F.concat(F.initcap("r_name"), F.lit(" Branch")).alias("branch_name"),
            F.col("r_name").alias("region"),
            F.lit("Active").alias("branch_status"),
        )

    @cached_property
    def accounts(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("account_id"),
            F.concat(F.lit("AC"), padded(key.cast("string"), 10)).alias("account_number"),
            key.alias("customer_id"),
            (F.pmod(key - 1, F.lit(5)) + 1).alias("branch_id"),
            F.when(key % 10 == 0, "Current").otherwise("Savings").alias("account_type"),
            F.when(key % 50 == 7, F.lit(None).cast("string")).otherwise("Active").alias("account_status"),
            _money(F.col("c_acctbal")).alias("opening_balance"),
            _money(F.col("c_acctbal")).alias("current_balance"),
            F.when(F.col("c_mktsegment") != "MACHINERY", "INR").alias("currency_code"),
        )

    @cached_property
    def customer_kyc(self) -> DataFrame:
        """Customers in debt have not been through KYC yet."""
        key = F.col("c_custkey")
        return self.table("customer").where(F.col("c_acctbal") >= 0).select(
            key.alias("customer_id"),
            F.concat(F.lit("ABCDE"), padded(key.cast("string"), 4), F.lit("F")).alias("pan_number"),
            padded(key.cast("string"), 12).alias("aadhaar_number"),
            (key % 9 != 0).alias("pan_verified"),
            (key % 11 != 0).alias("aadhaar_verified"),
            modulo_risk(key).alias("risk_rating"),
            (key % 40 == 0).alias("pep_flag"),
            (key % 100 == 0).alias("sanctions_flag"),
        )

    @cached_property
    def cards(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("card_id"), key.alias("account_id"),
            F.concat(F.lit("4"), padded(key.cast("string"), 15)).alias("card_number"),
            F.when(key % 3 == 0, "Credit").otherwise("Debit").alias("card_type"),
            _case(key % 4, {0: "Visa", 1: "Mastercard", 2: "RuPay", 3: "Amex"}).alias("card_network"),
            F.when(key % 11 == 0, "Blocked").otherwise("Active").alias("card_status"),
            _money(F.col("c_acctbal") * 10).alias("daily_transaction_limit"),
        )

    @cached_property
    def merchants(self) -> DataFrame:
        key = F.col("s_suppkey")
        nations = self.table("nation").select("n_nationkey", F.col("n_name").alias("country"))
        return self.table("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
            key.alias("merchant_id"),
            F.concat(F.lit("M"), padded(key.cast("string"), 9)).alias("merchant_code"),
            F.col("s_name").alias("merchant_name"),
            F.when(key % 2 == 0, "Retail").otherwise("Services").alias("merchant_category"),
            "country",
            modulo_risk(key).alias("risk_level"),
            F.lit("Active").alias("merchant_status"),
        )

    @cached_property
    def devices(self) -> DataFrame:
        key = F.col("device_id")
        return self.transactions.where(key.isNotNull()).select("device_id").distinct().select(
            key,
            F.concat(F.lit("fp-"), key.cast("string")).alias("device_fingerprint"),
            _case(key % 5, {0: "Mobile", 1: "Laptop", 2: "Desktop", 3: "ATM", 4: "POS"}).alias("device_type"),
            (key % 3 != 0).alias("trusted_device"),
        )

    @cached_property
    def orphan_transactions(self) -> DataFrame:
        """Transactions of which some lost their account, for the integrity checks."""
        moved = F.when(F.col("transaction_id") % 500 == 0, F.col("account_id") + 1_000_000_000).otherwise(F.col("account_id"))
        return self.transactions.withColumn("account_id", moved)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich_transactions(self.transactions, self.accounts, self.customers, self.cards, self.merchants,
                                   self.devices, self.customer_kyc)

    @cached_property
    def scored_transactions(self) -> DataFrame:
        return score_transactions(self.enriched)

    @cached_property
    def alerts(self) -> DataFrame:
        return rule_alerts(self.scored_transactions)

    @cached_property
    def existing_alerts(self) -> DataFrame:
        """What an earlier run of the rule engine has left: alerts on the older transactions."""
        older = F.col("transaction_timestamp") < F.lit(PREVIOUS_RUN_BEFORE).cast("timestamp")
        return rule_alerts(self.scored_transactions.where(older))

    @cached_property
    def credit_scores(self) -> DataFrame:
        """Bureau scores by balance: debtors and the richest fall out of the range, every fiftieth has no bureau."""
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("credit_score_id"), key.alias("customer_id"),
            F.when(key % 50 != 7, _case(key % 4, {0: "CIBIL", 1: "Experian", 2: "Equifax", 3: "CRIF"})).alias("bureau_name"),
            (F.floor(_hundredths(F.col("c_acctbal")) / 1500) + 300).cast("int").alias("bureau_score"),
            (key % 101).cast("decimal(5,2)").alias("internal_score"),
            ((key * 37 % 101) / F.lit(100)).cast("decimal(5,4)").alias("default_probability"),
            F.when(key % 40 != 3, self.as_of).alias("score_date"))

    @cached_property
    def counterparty_rules(self) -> DataFrame:
        """An AML rule per supplier, in the form of the rule table; suppliers of one nation offer the same code at times."""
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            key.alias("rule_id"), F.concat(F.lit("SUP"), (key % 97).cast("string")).alias("rule_code"),
            F.when(key % 30 != 4, F.col("s_name")).alias("rule_name"),
            _money(F.col("s_acctbal")).alias("threshold_amount"),
            (key % 10).cast("int").alias("threshold_count"),
            _case(key % 5, {0: "Low", 1: "Medium", 2: "High", 3: "Critical"}, "Severe").alias("severity"),
            F.when(key % 3 != 0, key % 2 == 0).alias("is_active"))

    # --- credit and fraud -----------------------------------------------------------------------
    @cached_property
    def applicants(self) -> DataFrame:
        key = F.col("c_custkey")

        def when_zero(divisor: int) -> Column:
            return F.when(key % divisor == 0, 1).otherwise(0)

        return self.table("customer").select(
            key.alias("applicant_id"),
            F.when((key % 15 == 0) | (key % 23 == 0), 1).otherwise(0).alias(V.APPLICANT_TARGET),
            ((key * 37 % 120) / F.lit(100.0)).alias(V.UTILIZATION),
            (key % 95 + 15).cast("int").alias("age"),
            when_zero(9).alias(V.LATE_30_59),
            ((key * 53 % 90) / F.lit(100.0)).alias("DebtRatio"),
            F.when(key % 6 != 0, F.round(F.abs("c_acctbal"), 2)).alias("MonthlyIncome"),
            (key % 20).cast("int").alias(V.OPEN_LINES),
            when_zero(15).alias(V.LATE_90),
            (key % 4).cast("int").alias(V.REAL_ESTATE_LINES),
            when_zero(14).alias(V.LATE_60_89),
            F.when(key % 13 != 0, (key % 5).cast("double")).alias(V.DEPENDENTS),
        )

    # --- laundering --------------------------------------------------------------------------------
    @cached_property
    def aml_transfers(self) -> DataFrame:
        def place(prefix: str) -> DataFrame:
            """A row per nation, 25 in all."""
            regions = self.table("region")
            return F.broadcast(self.table("nation").join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey")).select(
                F.col("n_nationkey").alias(f"{prefix}_nation"), F.col("n_name").alias(f"{prefix}_country"),
                _case(F.col("r_regionkey"), {0: "USD", 1: "EUR", 2: "GBP", 3: "INR", 4: "JPY"}).alias(f"{prefix}_currency")))

        # only keys and numbers are shuffled, and of the lines as few times as can be: payers meet the fewer orders first,
        # and the names of places come last
        payers = self.table("customer").select("c_custkey", F.col("c_nationkey").alias("from_nation"))
        takers = self.table("supplier").select("s_suppkey", F.col("s_nationkey").alias("to_nation"))
        orders = self.table("orders").select("o_orderkey", "o_custkey").join(payers, F.col("o_custkey") == F.col("c_custkey"))
        joined = (
            self.table("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(takers, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(place("from"), "from_nation").join(place("to"), "to_nation")
        )
        line = F.col("l_orderkey") + F.col("l_linenumber")
        formats = dict(enumerate(V.PAYMENT_FORMATS))

        def share(percent: Column) -> Column:
            """Price times a percentage, rounded half up to the cent in whole numbers."""
            return _whole(_hundredths(F.col("l_extendedprice")) * percent + 50, 100) / F.lit(100.0)

        return joined.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("record_key"),
            F.col("l_shipdate").cast("timestamp").alias("timestamp"),
            (F.col("from_nation") % 10).cast("string").alias("from_bank"),
            F.col("o_custkey").cast("string").alias("from_account"),
            "from_country",
            (F.col("to_nation") % 10).cast("string").alias("to_bank"),
            F.col("l_suppkey").cast("string").alias("to_account"),
            "to_country",
            share(100 - _hundredths(F.col("l_discount"))).alias("amount_received"),
            F.col("to_currency").alias("receiving_currency"),
            share(100 + _hundredths(F.col("l_tax"))).alias("amount_paid"),
            F.col("from_currency").alias("payment_currency"),
            _case(line % 7, formats).alias("payment_format"),
            ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 500 == 0).alias("is_laundering"),
        )

    @cached_property
    def aml_events(self) -> DataFrame:
        return self.table("events").select(
            "event_id", F.col("user_id").alias("account_id"), F.col("ts").cast("timestamp").alias("ts"),
            F.col("value").alias("amount"))

    @cached_property
    def aml_rules(self) -> DataFrame:
        """The rule table, one row inactive."""
        return self.spark.createDataFrame([
            ("HIV01", "Medium", Decimal(150), None, None, True, None),
            ("STR01", "Critical", Decimal(100), 4, 1440, True, None),
            ("VEL01", "High", None, 5, 1440, True, None),
            ("VEL02", "Low", None, 1, 1440, False, None),
            ("XBR01", "High", Decimal(50000), None, None, True, "cross_border"),
            ("XBR02", "Low", None, None, None, True, "cross_border"),
        ], RULE_SCHEMA)

    # --- scores ---------------------------------------------------------------------------------------
    @cached_property
    def scored(self) -> DataFrame:
        """Events as a scored validation set."""
        return self.table("events").select(
            "event_id",
            _value_probability().alias("probability"),
            F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"))

    @cached_property
    def model_scores(self) -> DataFrame:
        """Three scores per event as three candidate models, in long form."""
        hour = F.hour(F.col("ts").cast("timestamp"))
        p = _value_probability()
        return self.table("events").select(
            F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"),
            F.inline(F.array(*[
                F.struct(F.lit(name).alias("model"), value.cast("double").alias("probability"))
                for name, value in (
                    ("logistic_regression", p), ("random_forest", F.round(1 - p, 3)),
                    ("gradient_boosting", F.round(hour / F.lit(23.0), 3)),
                )
            ])))

    @cached_property
    def domain_results(self) -> DataFrame:
        """Probability, segment and decision of each domain per customer."""
        key = F.col("c_custkey")
        p = {"credit": (key * 37 % 101) / F.lit(100.0), "fraud": (key * 53 % 101) / F.lit(100.0),
             "aml": (key * 71 % 101) / F.lit(100.0)}
        aml = aml_assessment(p["aml"])
        return self.table("customer").select(
            key.alias("customer_id"),
            *[p[d].alias(f"{d}_probability") for d in V.DRIVER_ORDER],
            credit_segment(p["credit"]).alias("credit_segment"), fraud_segment(p["fraud"]).alias("fraud_segment"),
            aml["risk_segment"].alias("aml_segment"),
            credit_decision(p["credit"]).alias("credit_decision"), fraud_decision(p["fraud"]).alias("fraud_decision"),
            aml["aml_decision"].alias("aml_decision"))

    def delivered(self, domain: str) -> DataFrame:
        """A domain's results under the column names that domain uses when it delivers them."""
        probability = {"credit": "default_probability", "fraud": "fraud_probability", "aml": "aml_probability"}[domain]
        decision = {"credit": "decision", "fraud": "fraud_decision", "aml": "aml_decision"}[domain]
        alert = [F.when(F.col("aml_probability") >= 0.5, "AML_ALERT").alias("alert")] if domain == "aml" else []
        return self.domain_results.select(
            "customer_id", F.col(f"{domain}_probability").alias(probability),
            F.col(f"{domain}_segment").alias("risk_segment"), F.col(f"{domain}_decision").alias(decision), *alert)

    @cached_property
    def raw_requests(self) -> DataFrame:
        """Assessment requests as they arrive: untrimmed text, some absent or malformed."""
        key = F.col("o_orderkey")
        payers = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")) \
            .select("c_custkey", F.col("n_name").alias("_from"))
        takers = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")) \
            .select("s_suppkey", F.col("n_name").alias("_to"))
        amount = _whole(_hundredths(F.col("o_totalprice")), 30) / F.lit(100.0)
        text = (
            F.when(key % 89 == 0, "invalid").when(key % 83 == 0, F.concat(F.lit("-"), amount.cast("string")))
            .when(key % 79 != 0, amount.cast("string"))
        )
        return (
            self.table("orders").join(payers, F.col("o_custkey") == F.col("c_custkey"), "left")
            .withColumn("_taker", key % self.supplier_count)
            .join(takers, F.col("_taker") == F.col("s_suppkey"), "left")
            .select(
                key.alias("request_id"),
                F.col("o_custkey").cast("string").alias("customer_id"),
                text.alias("transaction_amount"),
                F.concat(F.lit(" "), F.lower("_from"), F.lit(" ")).alias("country_from"),
                F.when(key % 73 != 0, F.col("_to")).alias("country_to"),
                F.when(key % 71 != 0, F.lit("usd")).alias("currency")))

    @cached_property
    def card_transactions(self) -> DataFrame:
        vector = F.col("embedding")
        return self.table("embeddings").select(
            F.col("vec_id"),
            F.col("vec_id").cast("double").alias("Time"),
            *[vector[i - 1].cast("double").alias(f"V{i}") for i in range(1, 29)],
            (F.col("vec_id") % 300 + 0.5).cast("double").alias("Amount"),
            F.when(F.col("label") == 1, 1).otherwise(0).alias("Class"))
