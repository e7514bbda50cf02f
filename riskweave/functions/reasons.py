"""Human-readable reasons, built as arrays of conditional sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.conditions import same


def sentences(*parts: Column) -> Column:
    """Array of the parts that apply, in the given order."""
    return F.array_compact(F.array(*parts))


def _by_level(level: Column, high: str, medium: str) -> Column:
    return F.when(level == "High", F.lit(high)).when(level == "Medium", F.lit(medium))


def transaction_reason(c=F.col) -> Column:
    """Reason text of a rule alert, e.g. ``High-risk merchant; PEP flag``."""
    amount = None
    for edge, text in V.AMOUNT_REASONS:
        reached = c("transaction_amount") >= edge
        amount = F.when(reached, F.lit(text)) if amount is None else amount.when(reached, F.lit(text))
    reasons = sentences(
        amount,
        _by_level(c("merchant_risk"), "High-risk merchant", "Medium-risk merchant"),
        _by_level(c("customer_risk"), "High-risk customer", "Medium-risk customer"),
        _by_level(c("kyc_risk"), "High KYC risk", "Medium KYC risk"),
        F.when(same(c("trusted_device"), F.lit(False)), F.lit("Untrusted device")),
        F.when(c("card_status") == "Blocked", F.lit("Blocked card")),
        F.when(c("pep_flag"), F.lit("PEP flag")),
        F.when(c("sanctions_flag"), F.lit("Sanctions flag")),
        F.when(
            c("transaction_status").isin(V.BAD_STATUSES),
            F.concat(F.lit("Transaction status: "), c("transaction_status")),
        ),
        F.when(
            c("transaction_type").isin(V.SENSITIVE_TYPES),
            F.concat(F.lit("Risk-sensitive transaction type: "), c("transaction_type")),
        ),
    )
    text = F.concat_ws("; ", reasons)
    return F.when(text == "", F.lit(V.REASON_FALLBACK)).otherwise(text)


def _two_places(value: Column) -> Column:
    return F.format_string("%.2f", value)


def _money(value: Column) -> Column:
    return F.format_number(value, 2)


def credit_reasons(probability: Column, segment: Column, decision: Column) -> Column:
    """Sentences explaining a credit score from the applicant's engineered features."""
    zero = F.lit(0.0)
    utilization = F.coalesce(F.col(V.UTILIZATION).cast("double"), zero)
    debt = F.coalesce(F.col("DebtRatio").cast("double"), zero)
    income = F.coalesce(F.col("MonthlyIncome").cast("double"), zero)
    events = F.coalesce(F.col("TotalDelinquencyEvents").cast("long"), F.lit(0))

    def is_set(name: str) -> Column:
        return F.coalesce(F.col(name) > 0, F.lit(False))

    return sentences(
        F.when(events > 0, F.format_string("Customer has %d delinquency event(s).", events))
        .otherwise("No delinquency events are present."),
        F.when(is_set("HasSevereDelinquency"), "Severe delinquency indicator is present."),
        F.when(is_set("HighCreditUtilization"), "Credit utilization is flagged as high.")
        .when(utilization >= 0.70,
              F.concat(F.lit("Credit utilization is relatively high ("), _two_places(utilization), F.lit(").")))
        .otherwise(F.concat(F.lit("Credit utilization is moderate/low ("), _two_places(utilization), F.lit(")."))),
        F.when(is_set("HighDebtRatio"), "Debt ratio is flagged as high.")
        .when(debt > 1, F.concat(F.lit("Debt ratio is elevated ("), _two_places(debt), F.lit(").")))
        .otherwise(F.concat(F.lit("Debt ratio is within the observed range ("), _two_places(debt), F.lit(")."))),
        F.when(income > 0, F.concat(F.lit("Monthly income is approximately "), _money(income), F.lit("."))),
        F.concat(F.lit("Predicted default probability is "), _two_places(probability * 100), F.lit("%.")),
        F.concat(F.lit("Risk segment is classified as "), segment, F.lit(".")),
        F.concat(F.lit("Business credit decision is "), decision, F.lit(".")),
    )


def fraud_reasons(probability: Column, segment: Column) -> Column:
    zero = F.lit(0.0)
    utilization = F.coalesce(F.col(V.UTILIZATION).cast("double"), zero)
    debt = F.coalesce(F.col("DebtRatio").cast("double"), zero)
    income = F.coalesce(F.col("MonthlyIncome").cast("double"), zero)
    events = F.coalesce(F.col("TotalDelinquencyEvents").cast("long"), F.lit(0))

    def graded(value: Column, steps: list[tuple[float, str]], last: str) -> Column:
        chain = None
        for edge, text in steps:
            line = F.concat(F.lit(f"{text} ("), _two_places(value), F.lit(")."))
            chain = F.when(value <= edge, line) if chain is None else chain.when(value <= edge, line)
        return chain.otherwise(F.concat(F.lit(f"{last} ("), _two_places(value), F.lit(").")))

    return sentences(
        F.when(events == 0, "No delinquency events are present.")
        .otherwise(F.format_string("%d delinquency event(s) are present.", events)),
        graded(utilization,
               [(0.30, "Credit utilization is low"), (0.70, "Credit utilization is moderate")],
               "Credit utilization is high"),
        graded(debt,
               [(0.50, "Debt ratio is relatively low"), (1.00, "Debt ratio is within the observed range")],
               "Debt ratio is elevated"),
        F.concat(F.lit("Monthly income is approximately "), _money(income), F.lit(".")),
        F.concat(F.lit("Predicted fraud probability is "), _two_places(probability * 100), F.lit("%.")),
        F.concat(F.lit("Risk segment is classified as "), segment, F.lit(".")),
    )


def aml_reasons() -> Column:
    reasons = sentences(
        F.when(F.col("cross_border_transaction") == 1, "Cross-border transaction"),
        F.when(F.col("currency_conversion") == 1, "Currency conversion"),
        F.when(F.col("amount_mismatch_flag") == 1, "Amount mismatch"),
        F.when(F.col("high_value_transaction") == 1, "High-value transaction"),
    )
    return F.when(F.size(reasons) == 0, F.array(F.lit("No major AML risk indicator detected"))).otherwise(reasons)
