"""Explicit schemas of the banking tables and flat files, with their checks, keys and defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import fixed_values as V


def _schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


STAMPS = "created_at timestamp, updated_at timestamp"

DDL = {
    "customers": "customer_id long, customer_code string, first_name string, last_name string, date_of_birth date, "
                 "gender string, email string, mobile_number string, pan_number string, customer_type string, "
                 f"risk_category string, kyc_status string, record_status string, {STAMPS}",
    "branches": "branch_id long, branch_code string, branch_name string, city string, state string, region string, "
                f"ifsc_code string, branch_status string, {STAMPS}",
    "accounts": "account_id long, account_number string, customer_id long, branch_id long, account_type string, "
                "account_status string, opening_balance decimal(18,2), current_balance decimal(18,2), "
                f"currency_code string, opened_date date, {STAMPS}",
    "customer_addresses": "address_id long, customer_id long, address_type string, address_line_1 string, "
                          "address_line_2 string, city string, state string, postal_code string, country string, "
                          "created_at timestamp",
    "customer_kyc": "kyc_id long, customer_id long, pan_number string, aadhaar_number string, pan_verified boolean, "
                    "aadhaar_verified boolean, kyc_completion_date date, kyc_expiry_date date, risk_rating string, "
                    f"pep_flag boolean, sanctions_flag boolean, {STAMPS}",
    "cards": "card_id long, account_id long, card_number string, card_type string, card_network string, "
             "issue_date date, expiry_date date, card_status string, daily_transaction_limit decimal(18,2), "
             f"international_enabled boolean, contactless_enabled boolean, {STAMPS}",
    "merchants": "merchant_id long, merchant_code string, merchant_name string, merchant_category string, city string, "
                 f"state string, country string, risk_level string, merchant_status string, {STAMPS}",
    "devices": "device_id long, device_fingerprint string, device_type string, operating_system string, "
               "browser_name string, browser_version string, ip_address string, trusted_device boolean, "
               "first_seen_at timestamp, last_seen_at timestamp, created_at timestamp",
    "transactions": "transaction_id long, transaction_reference string, account_id long, card_id long, merchant_id long, "
                    "device_id long, transaction_timestamp timestamp, transaction_type string, transaction_channel string, "
                    "debit_credit string, transaction_amount decimal(18,2), currency_code string, "
                    "transaction_status string, available_balance decimal(18,2), remarks string, created_at timestamp",
    "credit_scores": "credit_score_id long, customer_id long, bureau_name string, bureau_score int, "
                     "internal_score decimal(5,2), default_probability decimal(5,4), score_date date, "
                     "score_version string, created_at timestamp",
    "fraud_alerts": "fraud_alert_id long, transaction_id long, alert_timestamp timestamp, detection_source string, "
                    "fraud_score decimal(5,4), risk_level string, alert_status string, assigned_to string, "
                    "investigation_notes string, resolved_at timestamp, created_at timestamp",
    "aml_rules": "rule_id long, rule_code string, rule_name string, description string, threshold_amount decimal(18,2), "
                 "threshold_count int, time_window_minutes int, severity string, is_active boolean, created_at timestamp",
    "card_transactions": "Time double, " + ", ".join(f"V{i} double" for i in range(1, 29)) + ", Amount double, Class int",
    "aml_transfers": "record_key string, timestamp timestamp, from_bank string, from_account string, from_country string, "
                     "to_bank string, to_account string, to_country string, amount_received double, "
                     "receiving_currency string, amount_paid double, payment_currency string, payment_format string, "
                     "is_laundering boolean, predicted_alert boolean, model_score double, is_dashboard_sample boolean",
}


def table_schema(name: str) -> T.StructType:
    if name == "applicants":
        doubles = {V.UTILIZATION, "DebtRatio", "MonthlyIncome", V.DEPENDENTS}
        fields = [T.StructField("Unnamed: 0", T.LongType())]
        fields += [T.StructField(c, T.DoubleType() if c in doubles else T.IntegerType()) for c in V.APPLICANT_COLUMNS]
        return T.StructType(fields)
    return _schema(DDL[name])


# CHECK lists, ranges, unique keys and defaults of the banking tables.
ALLOWED = {
    "customers": {
        "gender": ["Male", "Female", "Other"],
        "customer_type": ["Individual", "Corporate"],
        "risk_category": ["Low", "Medium", "High"],
        "kyc_status": ["Pending", "Verified", "Rejected"],
        "record_status": ["Active", "Inactive"],
    },
    "branches": {"branch_status": ["Active", "Inactive"]},
    "accounts": {
        "account_type": ["Savings", "Current", "Salary", "Fixed Deposit"],
        "account_status": ["Active", "Inactive", "Blocked", "Closed"],
    },
    "customer_addresses": {"address_type": ["Permanent", "Current", "Office"]},
    "customer_kyc": {"risk_rating": ["Low", "Medium", "High"]},
    "cards": {
        "card_type": ["Debit", "Credit"],
        "card_network": ["Visa", "Mastercard", "RuPay", "Amex"],
        "card_status": ["Active", "Blocked", "Expired", "Closed"],
    },
    "merchants": {"risk_level": ["Low", "Medium", "High"], "merchant_status": ["Active", "Inactive"]},
    "devices": {"device_type": ["Mobile", "Laptop", "Desktop", "ATM", "POS"]},
    "transactions": {
        "transaction_type": [
            "Purchase", "Cash Withdrawal", "Cash Deposit", "Transfer", "Bill Payment", "UPI", "NEFT", "RTGS", "IMPS"],
        "transaction_channel": ["ATM", "POS", "Mobile", "Internet Banking", "Branch"],
        "debit_credit": ["D", "C"],
        "transaction_status": ["Success", "Failed", "Pending", "Reversed"],
    },
    "credit_scores": {"bureau_name": ["CIBIL", "Experian", "Equifax", "CRIF"]},
    "fraud_alerts": {
        "detection_source": ["ML", "Rule Engine", "Hybrid"],
        "risk_level": ["Low", "Medium", "High", "Critical"],
        "alert_status": ["Open", "Investigating", "Confirmed Fraud", "False Positive", "Closed"],
    },
    "aml_rules": {"severity": ["Low", "Medium", "High", "Critical"]},
}
RANGES = {
    "accounts": {"opening_balance": (0, None), "current_balance": (0, None)},
    "cards": {"daily_transaction_limit": (0, None)},
    "credit_scores": {"bureau_score": (300, 900)},
    "fraud_alerts": {"fraud_score": (0, 1)},
}
POSITIVE = {"transactions": ["transaction_amount"]}
UNIQUE = {
    "customers": ["customer_code", "email", "mobile_number", "pan_number"],
    "branches": ["branch_code", "ifsc_code"],
    "accounts": ["account_number"],
    "customer_kyc": ["customer_id", "pan_number", "aadhaar_number"],
    "cards": ["card_number"],
    "merchants": ["merchant_code"],
    "devices": ["device_fingerprint"],
    "transactions": ["transaction_reference"],
    "aml_rules": ["rule_code"],
}
REQUIRED = {
    "customers": ["customer_id", "customer_code", "first_name", "last_name", "date_of_birth"],
    "branches": ["branch_id", "branch_code", "branch_name", "city", "state", "ifsc_code"],
    "accounts": ["account_id", "account_number", "customer_id", "branch_id", "opened_date"],
    "customer_addresses": ["address_id", "customer_id", "address_line_1", "city", "state", "postal_code"],
    "customer_kyc": ["kyc_id", "customer_id", "pan_number"],
    "cards": ["card_id", "account_id", "card_number", "issue_date", "expiry_date"],
    "merchants": ["merchant_id", "merchant_code", "merchant_name", "merchant_category"],
    "devices": ["device_id", "device_fingerprint"],
    "transactions": ["transaction_id", "transaction_reference", "account_id", "transaction_timestamp"],
    "credit_scores": ["credit_score_id", "customer_id", "score_date"],
    "fraud_alerts": ["fraud_alert_id", "transaction_id", "alert_timestamp"],
    "aml_rules": ["rule_id", "rule_code", "rule_name"],
}
DEFAULTS = {
    "customers": {"customer_type": "Individual", "risk_category": "Low", "kyc_status": "Pending", "record_status": "Active"},
    "branches": {"branch_status": "Active"},
    "accounts": {
        "account_type": "Savings", "account_status": "Active", "opening_balance": 0, "current_balance": 0,
        "currency_code": "INR"},
    "customer_addresses": {"country": "India"},
    "customer_kyc": {
        "pan_verified": False, "aadhaar_verified": False, "risk_rating": "Low", "pep_flag": False, "sanctions_flag": False},
    "cards": {
        "card_status": "Active", "daily_transaction_limit": 50000, "international_enabled": False,
        "contactless_enabled": True},
    "merchants": {"country": "India", "risk_level": "Low", "merchant_status": "Active"},
    "devices": {"trusted_device": False},
    "transactions": {"currency_code": "INR", "transaction_status": "Success"},
    "fraud_alerts": {"alert_status": "Open"},
    "aml_rules": {"is_active": True},
}


def table_checks(table: str, columns: list[str]) -> dict[str, Column]:
    """CHECK conditions of a table for those of its columns that are present."""
    checks: dict[str, Column] = {}
    for name, allowed in ALLOWED.get(table, {}).items():
        checks[f"allowed_{name}"] = F.col(name).isin(allowed)
    for name, (low, high) in RANGES.get(table, {}).items():
        inside = F.col(name) >= low
        checks[f"range_{name}"] = inside if high is None else inside & (F.col(name) <= high)
    for name in POSITIVE.get(table, []):
        checks[f"positive_{name}"] = F.col(name) > 0
    return {k: c for k, c in checks.items() if k.split("_", 1)[1] in columns}


def table_unique(table: str, columns: list[str]) -> list[str]:
    return [name for name in UNIQUE.get(table, []) if name in columns]


def table_required(table: str, columns: list[str]) -> list[str]:
    return [name for name in REQUIRED.get(table, []) if name in columns]
