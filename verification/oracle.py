"""Reference SQL per query name, runnable by DuckDB on the input tables."""

from __future__ import annotations

from verification.oracle_views import FORMATS, VIEWS, modulo_risk, with_views

SQL: dict[str, str] = {}


def sql(name: str, views: list[str], text: str) -> None:
    SQL[name] = with_views(views, text)


def rules(counts: str, names: list[str], per_rule: str) -> str:
    """One row per rule from a one-row subquery of counts."""
    return " UNION ALL ".join(per_rule.format(n=n) for n in names).replace("@counts", counts)


SEED_PLACES = [("Bhopal", "Madhya Pradesh"), ("Indore", "Madhya Pradesh"), ("Mumbai", "Maharashtra"),
               ("New Delhi", "Delhi"), ("Bengaluru", "Karnataka")]


def place(field: int) -> str:
    position = "((customer_id - 1) % 5 + 5) % 5"
    return f"CASE {position} " + " ".join(f"WHEN {i} THEN '{p[field]}'" for i, p in enumerate(SEED_PLACES)) + " END"


# --- sinks and seeds -----------------------------------------------------------------------------
sql("alert_append_idempotent", ["alerts", "existing_alerts"], """
SELECT transaction_id, detection_source, fraud_score::DOUBLE AS fraud_score, risk_level, alert_status, investigation_notes
FROM alerts a WHERE NOT EXISTS (SELECT 1 FROM existing_alerts e
  WHERE e.transaction_id = a.transaction_id AND e.detection_source = 'Rule Engine')""")
sql("seed_customers", ["customers"], "SELECT * REPLACE (date_of_birth::DATE::VARCHAR AS date_of_birth) FROM customers")
VIEWS["addresses"] = (["customers"], f"""
SELECT customer_id, 'Permanent' AS address_type, 'Demo Address ' || customer_id AS address_line_1, NULL::VARCHAR AS address_line_2,
  {place(0)} AS city, {place(1)} AS state, repeat('0', greatest(0, 6 - length((100000 + customer_id)::VARCHAR))) || (100000 + customer_id)::VARCHAR AS postal_code,
  'India' AS country
FROM customers WHERE customer_code LIKE 'CUST%'""")
# what the constraints of branches look at; the name is there wherever the region has one
VIEWS["branch_checks"] = (["branches"], """SELECT b.branch_id, b.branch_code, r.r_name || ' Branch' AS branch_name, 'Active' AS branch_status
FROM branches b JOIN region r ON r.r_regionkey + 1 = b.branch_id""")
sql("seed_addresses", ["addresses"], "SELECT * FROM addresses")
KYC = f"""SELECT customer_id, pan_number, repeat('0', greatest(0, 12 - length(customer_id::VARCHAR))) || customer_id::VARCHAR AS aadhaar_number,
  true AS pan_verified, true AS aadhaar_verified,
  (DATE '2024-06-30' - (customer_id % 1000)::INTEGER)::DATE::VARCHAR AS kyc_completion_date,
  (DATE '2024-06-30' + 365)::DATE::VARCHAR AS kyc_expiry_date,
  {modulo_risk('customer_id')} AS risk_rating, false AS pep_flag, false AS sanctions_flag FROM customers c"""
sql("seed_kyc", ["customers"], KYC)
sql("kyc_backfill", ["customers", "customer_kyc"], KYC +
    " WHERE NOT EXISTS (SELECT 1 FROM customer_kyc k WHERE k.customer_id = c.customer_id)")
sql("branch_assign", ["customers", "branches"], """
SELECT c.customer_id, b.branch_id FROM customers c
LEFT JOIN (SELECT branch_id, row_number() OVER (ORDER BY branch_id) - 1 AS position FROM branches) b
  ON b.position = ((c.customer_id - 1) % 5 + 5) % 5""")
sql("seed_accounts", ["customers", "branches"], """
SELECT 'AC' || repeat('0', greatest(0, 10 - length(c.customer_id::VARCHAR))) || c.customer_id::VARCHAR AS account_number, c.customer_id, b.branch_id,
  CASE WHEN c.customer_id % 10 = 0 THEN 'Current' ELSE 'Savings' END AS account_type, 'Active' AS account_status,
  (10000.00 + c.customer_id * 125.50)::DOUBLE AS opening_balance, (10000.00 + c.customer_id * 125.50)::DOUBLE AS current_balance,
  'INR' AS currency_code, (DATE '2024-06-30' - (c.customer_id % 2000)::INTEGER)::DATE::VARCHAR AS opened_date
FROM customers c LEFT JOIN (SELECT branch_id, row_number() OVER (ORDER BY branch_id) - 1 AS position FROM branches) b
  ON b.position = ((c.customer_id - 1) % 5 + 5) % 5""")
sql("insert_ignore_conflicts", ["customers", "customer_kyc"], f"""
SELECT customer_id, pan_number, {modulo_risk('customer_id')} AS risk_rating FROM customers c
WHERE NOT EXISTS (SELECT 1 FROM customer_kyc k WHERE k.customer_id = c.customer_id)
  AND NOT EXISTS (SELECT 1 FROM customer_kyc k WHERE k.pan_number = c.pan_number)
QUALIFY row_number() OVER (PARTITION BY pan_number ORDER BY customer_id) = 1""")

# --- validation ------------------------------------------------------------------------------------
APPLICANT_CHECKS = {
    "target_values": ('"SeriousDlqin2yrs" IS NULL OR "SeriousDlqin2yrs" NOT IN (0, 1)',
                      "'Target contains only 0 and 1.'", "'Invalid target values detected.'"),
    "age_range": ("age < 18 OR age > 100", "'Age values are within 18-100.'", "n || ' invalid age values detected.'"),
    "monthly_income": ('"MonthlyIncome" < 0', "'No negative monthly income values.'", "n || ' negative income values detected.'"),
    "debt_ratio": ('"DebtRatio" < 0', "'No negative debt ratios.'", "n || ' negative debt ratios detected.'"),
    "revolving_utilization": ('"RevolvingUtilizationOfUnsecuredLines" < 0', "'No negative utilization values.'",
                              "n || ' negative utilization values.'"),
    **{f"{c}_non_negative": (f'"{c}" < 0', f"'{c} contains no negative values.'", "n || ' negative values detected.'")
       for c in ("NumberOfTime30-59DaysPastDueNotWorse", "NumberOfTimes90DaysLate", "NumberOfTime60-89DaysPastDueNotWorse")},
    "number_of_dependents": ('"NumberOfDependents" < 0', "'No negative dependent counts.'", "n || ' negative dependent counts.'"),
    "open_credit_lines": ('"NumberOfOpenCreditLinesAndLoans" < 0', "'No negative credit-line counts.'",
                          "n || ' negative credit-line counts.'"),
}
_rules = ["SELECT 'required_columns' AS rule, 0::BIGINT AS n, 'All required columns are present.' AS message",
          "SELECT 'duplicate_rows', n, CASE WHEN n = 0 THEN 'No duplicate rows found.' ELSE n || ' duplicate rows detected.' END "
          "FROM (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (applicant_id) FROM applicants)) AS n FROM applicants)"]
_rules += [f"SELECT '{name}', n, CASE WHEN n = 0 THEN {good} ELSE {bad} END FROM (SELECT count(*) FILTER (WHERE {cond}) AS n FROM applicants)"
           for name, (cond, good, bad) in APPLICANT_CHECKS.items()]
sql("dq_credit_rules", ["applicants"], f"""
SELECT rule, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n AS failed_rows, message,
  CASE WHEN max(n) OVER () = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status FROM ({' UNION ALL '.join(_rules)})""")
sql("sanity_checks", ["applicants"], " UNION ALL ".join(
    f"SELECT '{name}' AS rule, n AS invalid_count, CASE WHEN n = 0 THEN 'PASS' ELSE 'REVIEW' END AS status "
    f"FROM (SELECT count(*) FILTER (WHERE {cond}) AS n FROM applicants)"
    for name, cond in {
        "age_range": "age < 18 OR age > 120", "revolving_utilization": '"RevolvingUtilizationOfUnsecuredLines" < 0',
        "debt_ratio": '"DebtRatio" < 0', "monthly_income": '"MonthlyIncome" < 0', "number_of_dependents": '"NumberOfDependents" < 0',
    }.items()))
COLUMNS = {
    "applicant_id": "bigint", "SeriousDlqin2yrs": "int", "RevolvingUtilizationOfUnsecuredLines": "double", "age": "int",
    "NumberOfTime30-59DaysPastDueNotWorse": "int", "DebtRatio": "double", "MonthlyIncome": "double",
    "NumberOfOpenCreditLinesAndLoans": "int", "NumberOfTimes90DaysLate": "int", "NumberRealEstateLoansOrLines": "int",
    "NumberOfTime60-89DaysPastDueNotWorse": "int", "NumberOfDependents": "double",
}
sql("profile_columns", ["applicants"], " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count("{c}") AS null_count,
    round((count(*) - count("{c}")) / count(*)::DOUBLE * 100, 4) AS null_percentage, count(DISTINCT "{c}") AS unique_count,
    count(*) AS row_count, 12::BIGINT AS column_count,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM applicants)) AS duplicate_rows FROM applicants""" for c, t in COLUMNS.items()))
sql("profile_numeric", ["applicants"], " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS missing, count(DISTINCT "{c}") AS unique_values,
    round(min("{c}")::DOUBLE, 6) AS minimum, round(max("{c}")::DOUBLE, 6) AS maximum, round(avg("{c}"), 6) AS mean
    FROM applicants""" for c in COLUMNS))
sql("quarantine_split", ["applicants"], """
SELECT applicant_id, age, 'age_range' AS quarantine_rule, 'Age outside allowed range 18-100' AS quarantine_reason,
  'applicants' AS source_file FROM applicants WHERE age < 18 OR age > 100""")
sql("quarantine_clean", ["applicants"], "SELECT applicant_id, age FROM applicants WHERE age BETWEEN 18 AND 100 OR age IS NULL")
sql("quarantine_audit", ["applicants"], """
SELECT 'applicants' AS dataset, count(*) AS source_rows, count(*) FILTER (WHERE age BETWEEN 18 AND 100) AS valid_rows,
  count(*) FILTER (WHERE age < 18 OR age > 100) AS quarantined_rows, 'age_range' AS quarantine_rule,
  18::BIGINT AS age_min, 100::BIGINT AS age_max FROM applicants""")
sql("missing_values", ["applicants"], "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS missing_count,
    round((count(*) - count("{c}")) / count(*)::DOUBLE * 100, 6) AS missing_percentage FROM applicants""" for c in COLUMNS)
    + ") WHERE missing_count > 0")
sql("infinite_values", ["unbounded"], """SELECT 'income_share' AS "column", count(*) AS infinite_count
FROM unbounded WHERE isinf(income_share) HAVING count(*) > 0""")
sql("infinite_to_null", ["unbounded"], """SELECT applicant_id, round("DebtRatio", 6) AS "DebtRatio",
CASE WHEN isinf(income_share) THEN NULL ELSE round(income_share, 6) END AS income_share FROM unbounded""")
sql("dedup_rows", [], "SELECT DISTINCT user_id, event_type FROM events")
sql("duplicate_count", [], """SELECT count(*) AS row_count,
count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS duplicate_rows FROM events""")
sql("target_check", ["aml_transfers"], """
SELECT 'is_laundering' AS target, count(*) AS row_count, count(*) FILTER (WHERE is_laundering IS NULL) AS null_targets,
  count(*) FILTER (WHERE is_laundering::INTEGER NOT IN (0, 1)) AS invalid_targets, 'PASSED' AS status FROM aml_transfers""")
sql("target_distribution", ["aml_transfers"], """
SELECT is_laundering::BIGINT AS target, count(*) AS "count", round(count(*) / (SELECT count(*) FROM aml_transfers)::DOUBLE * 100, 4) AS percentage
FROM aml_transfers GROUP BY 1""")
sql("describe_amounts", ["aml_transfers"], " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
    round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(quantile_cont({c}, 0.25), 4) AS q25,
    round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75 FROM aml_transfers"""
    for c in ("amount_received", "amount_paid")))
sql("entity_cardinality", ["aml_transfers"], " UNION ALL ".join(
    f"SELECT '{c}' AS entity, count(DISTINCT {c}) AS distinct_count FROM aml_transfers"
    for c in ("from_bank", "to_bank", "from_account", "to_account", "receiving_currency", "payment_currency")))
sql("value_counts", ["aml_transfers"], 'SELECT payment_format AS value, count(*) AS "count" FROM aml_transfers GROUP BY 1')
sql("orphan_checks", ["orphan_transactions", "accounts", "merchants", "devices", "alerts"], """
SELECT 'transaction_account' AS relationship, count(*) AS orphans FROM orphan_transactions WHERE account_id NOT IN (SELECT account_id FROM accounts)
UNION ALL SELECT 'transaction_merchant', count(*) FROM orphan_transactions WHERE merchant_id NOT IN (SELECT merchant_id FROM merchants)
UNION ALL SELECT 'transaction_device', count(*) FROM orphan_transactions WHERE device_id NOT IN (SELECT device_id FROM devices)
UNION ALL SELECT 'alert_transaction', count(*) FROM alerts WHERE transaction_id NOT IN (SELECT transaction_id FROM orphan_transactions)""")
sql("null_checks", ["transactions"], " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS null_count FROM transactions"""
    for c in ("transaction_amount", "transaction_timestamp", "transaction_status", "account_id", "card_id")))

_in = "{c} NOT IN ({v})"
CHECKS = {
    "customers": {
        "allowed_gender": "gender NOT IN ('Male', 'Female', 'Other')",
        "allowed_customer_type": "customer_type NOT IN ('Individual', 'Corporate')",
        "allowed_risk_category": "risk_category NOT IN ('Low', 'Medium', 'High')",
        "allowed_kyc_status": "kyc_status NOT IN ('Pending', 'Verified', 'Rejected')",
        "allowed_record_status": "record_status NOT IN ('Active', 'Inactive')"},
    "accounts": {
        "allowed_account_type": "account_type NOT IN ('Savings', 'Current', 'Salary', 'Fixed Deposit')",
        "allowed_account_status": "account_status NOT IN ('Active', 'Inactive', 'Blocked', 'Closed')",
        "range_opening_balance": "opening_balance < 0", "range_current_balance": "current_balance < 0"},
    "customer_kyc": {"allowed_risk_rating": "risk_rating NOT IN ('Low', 'Medium', 'High')"},
    "cards": {
        "allowed_card_type": "card_type NOT IN ('Debit', 'Credit')",
        "allowed_card_network": "card_network NOT IN ('Visa', 'Mastercard', 'RuPay', 'Amex')",
        "allowed_card_status": "card_status NOT IN ('Active', 'Blocked', 'Expired', 'Closed')",
        "range_daily_transaction_limit": "daily_transaction_limit < 0"},
    "merchants": {"allowed_risk_level": "risk_level NOT IN ('Low', 'Medium', 'High')",
                  "allowed_merchant_status": "merchant_status NOT IN ('Active', 'Inactive')"},
    "devices": {"allowed_device_type": "device_type NOT IN ('Mobile', 'Laptop', 'Desktop', 'ATM', 'POS')"},
    "transactions": {
        "allowed_transaction_type": "transaction_type NOT IN ('Purchase', 'Cash Withdrawal', 'Cash Deposit', 'Transfer', 'Bill Payment', 'UPI', 'NEFT', 'RTGS', 'IMPS')",
        "allowed_transaction_channel": "transaction_channel NOT IN ('ATM', 'POS', 'Mobile', 'Internet Banking', 'Branch')",
        "allowed_debit_credit": "debit_credit NOT IN ('D', 'C')",
        "allowed_transaction_status": "transaction_status NOT IN ('Success', 'Failed', 'Pending', 'Reversed')",
        "positive_transaction_amount": "transaction_amount <= 0"},
    "alerts": {
        "allowed_detection_source": "detection_source NOT IN ('ML', 'Rule Engine', 'Hybrid')",
        "allowed_risk_level": "risk_level NOT IN ('Low', 'Medium', 'High', 'Critical')",
        "allowed_alert_status": "alert_status NOT IN ('Open', 'Investigating', 'Confirmed Fraud', 'False Positive', 'Closed')",
        "range_fraud_score": "fraud_score < 0 OR fraud_score > 1"},
    "branch_checks": {"allowed_branch_status": "branch_status NOT IN ('Active', 'Inactive')"},
    "addresses": {"allowed_address_type": "address_type NOT IN ('Permanent', 'Current', 'Office')"},
    "credit_scores": {"allowed_bureau_name": "bureau_name NOT IN ('CIBIL', 'Experian', 'Equifax', 'CRIF')",
                      "range_bureau_score": "bureau_score < 300 OR bureau_score > 900"},
    "counterparty_rules": {"allowed_severity": "severity NOT IN ('Low', 'Medium', 'High', 'Critical')"},
}
KEYS = {"customers": ["customer_code", "email", "mobile_number", "pan_number"], "accounts": ["account_number"],
        "customer_kyc": ["customer_id", "pan_number", "aadhaar_number"], "cards": ["card_number"],
        "merchants": ["merchant_code"], "devices": ["device_fingerprint"], "transactions": ["transaction_reference"], "branch_checks": ["branch_code"],
        "counterparty_rules": ["rule_code"]}
NOT_NULL = {"customers": ["customer_id", "customer_code", "first_name", "last_name", "date_of_birth"], "accounts": ["account_id", "account_number", "customer_id", "branch_id"],
            "customer_kyc": ["customer_id", "pan_number"], "cards": ["card_id", "account_id", "card_number"],
            "merchants": ["merchant_id", "merchant_code", "merchant_name", "merchant_category"], "devices": ["device_id", "device_fingerprint"],
            "transactions": ["transaction_id", "transaction_reference", "account_id", "transaction_timestamp"], "alerts": ["transaction_id"],
            "branch_checks": ["branch_id", "branch_code", "branch_name"], "addresses": ["customer_id", "address_line_1", "city", "state", "postal_code"],
            "credit_scores": ["credit_score_id", "customer_id", "score_date"], "counterparty_rules": ["rule_id", "rule_code", "rule_name"]}
_label = {"alerts": "fraud_alerts", "branch_checks": "branches", "addresses": "customer_addresses", "counterparty_rules": "aml_rules"}
sql("check_constraints", list(CHECKS), " UNION ALL ".join(
    [f"SELECT '{_label.get(t, t)}' AS table_name, '{n}' AS constraint_name, count(*) FILTER (WHERE {c}) AS violations FROM {t}"
     for t, checks in CHECKS.items() for n, c in checks.items()]
    + [f"SELECT '{_label.get(t, t)}', 'unique_{k}', count({k}) - count(DISTINCT {k}) FROM {t}" for t, keys in KEYS.items() for k in keys]
    + [f"SELECT '{_label.get(t, t)}', 'required_{c}', count(*) - count({c}) FROM {t}" for t, columns in NOT_NULL.items() for c in columns]))
sql("apply_defaults", ["accounts"], """
SELECT account_id, account_number, customer_id, branch_id, coalesce(account_type, 'Savings') AS account_type,
  coalesce(account_status, 'Active') AS account_status, coalesce(opening_balance, 0)::DOUBLE AS opening_balance,
  coalesce(current_balance, 0)::DOUBLE AS current_balance, coalesce(currency_code, 'INR') AS currency_code FROM accounts""")
DEFAULTED = {
    "customers": ("customer_id", {"customer_type": "'Individual'", "risk_category": "'Low'", "kyc_status": "'Pending'", "record_status": "'Active'"}),
    "branches": ("branch_id", {"branch_status": "'Active'"}),
    "accounts": ("account_id", {"account_type": "'Savings'", "account_status": "'Active'", "opening_balance": "'0.00'", "current_balance": "'0.00'",
                                "currency_code": "'INR'"}),
    "addresses": ("customer_id", {"country": "'India'"}),
    "customer_kyc": ("customer_id", {"pan_verified": "'false'", "aadhaar_verified": "'false'", "risk_rating": "'Low'", "pep_flag": "'false'",
                                     "sanctions_flag": "'false'"}),
    "cards": ("card_id", {"card_status": "'Active'", "daily_transaction_limit": "'50000.00'"}),
    "merchants": ("merchant_id", {"country": "'India'", "risk_level": "'Low'", "merchant_status": "'Active'"}),
    "devices": ("device_id", {"trusted_device": "'false'"}),
    "transactions": ("transaction_id", {"currency_code": "'INR'", "transaction_status": "'Success'"}),
    "alerts": ("transaction_id", {"alert_status": "'Open'"}),
    "counterparty_rules": ("rule_id", {"is_active": "'true'"}),
}
sql("apply_defaults_tables", list(DEFAULTED), " UNION ALL ".join(
    [f"""SELECT '{_label.get(t, t)}' AS table_name, {key}::BIGINT AS row_key, '{c}' AS column_name,
     coalesce(CASE WHEN {key} % 6 <> 0 THEN {c}::VARCHAR END, {default}) AS value FROM {t}"""
     for t, (key, columns) in DEFAULTED.items() for c, default in columns.items()]
    + [f"SELECT 'cards', card_id::BIGINT, '{c}', '{default}' FROM cards"
       for c, default in (("international_enabled", "false"), ("contactless_enabled", "true"))]))
sql("unexpected_columns", ["applicants"], """
SELECT 'applicants' AS table_name, 'applicant_id' AS "column", count(applicant_id) AS filled FROM applicants
UNION ALL SELECT 'card_transactions', 'vec_id', count(vec_id) FROM embeddings""")
TRANSFER_KINDS = {"amount_received": "numeric", "amount_paid": "numeric", "timestamp": "other", "is_laundering": "boolean"}
sql("column_types", ["aml_transfers"], " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{TRANSFER_KINDS.get(c, "categorical")}' AS kind, count("{c}") AS filled FROM aml_transfers"""
    for c in ("record_key", "timestamp", "from_bank", "from_account", "from_country", "to_bank", "to_account", "to_country", "amount_received",
              "receiving_currency", "amount_paid", "payment_currency", "payment_format", "is_laundering")))
FRAUD_COLUMNS = ["applicant_id", "SeriousDlqin2yrs", "RevolvingUtilizationOfUnsecuredLines", "age", "NumberOfTime30-59DaysPastDueNotWorse",
                 "DebtRatio", "MonthlyIncome", "NumberOfOpenCreditLinesAndLoans", "NumberOfTimes90DaysLate", "NumberRealEstateLoansOrLines",
                 "NumberOfTime60-89DaysPastDueNotWorse", "NumberOfDependents", "TotalDelinquencyEvents", "HasDelinquency",
                 "HasSevereDelinquency", "HighCreditUtilization", "HighDebtRatio", "IncomePerDependent", "TotalCreditLines", "AgeBand",
                 "RiskIndicator"]
_train = [c for c in FRAUD_COLUMNS if c != "DebtRatio"]
_validation = [c for c in FRAUD_COLUMNS if c != "AgeBand"]
_null = "NULL::BIGINT"
sql("alignment_report", ["fraud"], " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {_train.index(c) if c in _train else _null}::BIGINT AS train_position,
    {f'count("{c}")' if c in _train else _null} AS train_values, {_validation.index(c) if c in _validation else _null}::BIGINT AS validation_position,
    {f'count("{c}")' if c in _validation else _null} AS validation_values,
    {str(c in _train and c in _validation and _train.index(c) == _validation.index(c)).lower()} AS aligned FROM fraud""" for c in FRAUD_COLUMNS))
sql("numeric_gate", ["fraud"], """
SELECT applicant_id, coalesce("MonthlyIncome", 0.0::DOUBLE) AS "MonthlyIncome", coalesce("NumberOfDependents", 0.0::DOUBLE) AS "NumberOfDependents",
  "RiskIndicator" FROM fraud""")
sql("rejected_applicants", ["credit"], """
SELECT applicant_id, rejection_reasons FROM (
  SELECT applicant_id, concat_ws(' | ', CASE WHEN age < 18 OR age > 120 THEN 'Invalid age: ' || age || '. Expected range: 18-120.' END,
    CASE WHEN "MonthlyIncome" < 0 THEN 'MonthlyIncome cannot be negative.' END,
    CASE WHEN "DebtRatio" < 0 THEN 'DebtRatio cannot be negative.' END,
    CASE WHEN "RevolvingUtilizationOfUnsecuredLines" < 0 THEN 'Revolving utilization cannot be negative.' END) AS rejection_reasons
  FROM credit) WHERE rejection_reasons <> ''""")
sql("validate_applicants", ["credit"], """
SELECT applicant_id, age BETWEEN 18 AND 120 AND "MonthlyIncome" >= 0 AND "DebtRatio" >= 0 AND "RevolvingUtilizationOfUnsecuredLines" >= 0 AS is_valid,
  concat_ws(' | ', CASE WHEN age < 18 OR age > 120 THEN 'Invalid age: ' || age || '. Expected range: 18-120.' END,
    CASE WHEN "MonthlyIncome" < 0 THEN 'MonthlyIncome cannot be negative.' END,
    CASE WHEN "DebtRatio" < 0 THEN 'DebtRatio cannot be negative.' END,
    CASE WHEN "RevolvingUtilizationOfUnsecuredLines" < 0 THEN 'Revolving utilization cannot be negative.' END) AS rejection_reasons
FROM credit""")
sql("validate_requests", ["requests"], "SELECT * FROM requests")
sql("coerce_numeric", ["raw_requests"], "SELECT request_id, TRY_CAST(transaction_amount AS DOUBLE) AS transaction_amount FROM raw_requests")

# --- joins, rule engine ------------------------------------------------------------------------------
sql("txn_enriched", ["enriched"], """
SELECT transaction_id, customer_id, transaction_amount::DOUBLE AS transaction_amount, transaction_type, transaction_channel,
  transaction_status, card_status, merchant_risk, trusted_device, customer_risk, kyc_risk, pep_flag, sanctions_flag FROM enriched""")
sql("fact_star", ["orphan_transactions", "accounts", "customers", "customer_kyc", "cards", "merchants", "devices", "alerts"], """
SELECT t.transaction_id, t.account_id, a.customer_id, a.branch_id, a.account_type, cu.customer_type, cu.risk_category,
  k.risk_rating AS kyc_risk, c.card_type, m.merchant_category, m.country AS merchant_country, d.device_type,
  t.transaction_amount::DOUBLE AS transaction_amount, al.fraud_score::DOUBLE AS fraud_score, al.risk_level AS alert_level
FROM orphan_transactions t LEFT JOIN accounts a USING (account_id) LEFT JOIN customers cu ON cu.customer_id = a.customer_id
LEFT JOIN customer_kyc k ON k.customer_id = a.customer_id LEFT JOIN cards c ON c.card_id = t.card_id
LEFT JOIN merchants m ON m.merchant_id = t.merchant_id LEFT JOIN devices d ON d.device_id = t.device_id
LEFT JOIN alerts al ON al.transaction_id = t.transaction_id""")
sql("txn_rule_score", ["scored_transactions"], "SELECT transaction_id, risk_score FROM scored_transactions")
sql("txn_rule_level", ["scored_transactions"], "SELECT transaction_id, risk_score, risk_level FROM scored_transactions")
sql("txn_alert_reason", ["reasoned"], "SELECT transaction_id, reason FROM reasoned")
sql("rule_alerts", ["alerts"], "SELECT * REPLACE (fraud_score::DOUBLE AS fraud_score) FROM alerts")
sql("alert_summary", ["alerts", "existing_alerts"], """
SELECT count(*) FILTER (WHERE NOT known AND risk_level = 'Critical') AS critical_created,
  count(*) FILTER (WHERE NOT known AND risk_level = 'High') AS high_created,
  count(*) FILTER (WHERE NOT known) AS total_created, count(*) FILTER (WHERE known) AS skipped
FROM (SELECT *, transaction_id IN (SELECT transaction_id FROM existing_alerts) AS known FROM alerts)""")

# --- bands ---------------------------------------------------------------------------------------------
def below(p: str, edges: list[tuple[float, str]], last: str, op: str = "<") -> str:
    return "CASE " + " ".join(f"WHEN {p} {op} {e}::DOUBLE THEN '{label}'" for e, label in edges) + f" ELSE '{last}' END"


CREDIT = below("probability", [(0.18, "Low Risk"), (0.24, "Moderate Risk"), (0.5, "High Risk")], "Very High Risk")
CREDIT_CUT = below("probability", [(0.18, "Low Risk"), (0.24, "Moderate Risk"), (0.5, "High Risk")], "Very High Risk", "<=")
FRAUD = below("probability", [(0.05, "Low Risk"), (0.15, "Moderate Risk"), (0.3, "High Risk")], "Very High Risk")


def at_least(threshold: float, yes: str, no: str) -> str:
    return f"CASE WHEN probability >= {threshold}::DOUBLE THEN {yes} ELSE {no} END"


sql("credit_band", ["scored"], f"""
SELECT event_id, probability AS default_probability, {CREDIT} AS risk_segment, {at_least(0.18, "'REVIEW'", "'LOW_RISK'")} AS credit_decision,
  {at_least(0.18, '1', '0')}::BIGINT AS default_prediction FROM scored""")
sql("credit_band_cut", ["scored"], f"SELECT event_id, {CREDIT_CUT} AS risk_segment FROM scored")
sql("credit_band_explain", ["scored"], f"""
SELECT event_id, {below("probability", [(0.05, "Low Risk"), (0.1, "Moderate Risk"), (0.18, "High Risk")], "Very High Risk")} AS risk_segment,
  {at_least(0.18, "'HIGH_RISK'", "'LOW_RISK'")} AS decision FROM scored""")
sql("credit_category", ["scored"], f"SELECT event_id, {below('probability', [(0.4, 'LOW'), (0.7, 'MEDIUM')], 'HIGH')} AS risk_category FROM scored")
sql("fraud_band", ["scored"], f"""
SELECT event_id, {FRAUD} AS risk_segment, {at_least(0.2, "'FRAUD_REVIEW'", "'LOW_RISK'")} AS fraud_decision,
  {at_least(0.2, "'REVIEW_REQUIRED'", "'LOW_RISK'")} AS evaluation_decision FROM scored""")
sql("txn_fraud_band", ["scored"], f"""
SELECT event_id, {below("probability", [(0.4, "Low"), (0.75, "Medium"), (0.9, "High")], "Critical")} AS risk_level,
  {at_least(0.45, '1', '0')}::BIGINT AS fraud_prediction FROM scored""")
AML = """CASE WHEN {p} >= 0.5::DOUBLE THEN '{a}' WHEN {p} >= 0.2::DOUBLE THEN '{b}' ELSE '{c}' END"""
EXPLAINED = ("Transaction probability exceeds the default AML alert threshold.",
             "Transaction does not exceed the AML alert threshold but should receive additional review.",
             "Transaction probability is below the AML alert threshold.")


def aml3(a: str, b: str, c: str) -> str:
    return AML.format(p="probability", a=a, b=b, c=c)


sql("aml_band", ["scored"], f"""
SELECT event_id, {aml3('HIGH RISK', 'MEDIUM RISK', 'LOW RISK')} AS risk_segment, {aml3('AML_ALERT', 'REVIEW', 'LOW_RISK')} AS aml_decision,
  {at_least(0.5, '1', '0')}::BIGINT AS aml_prediction, {aml3(*EXPLAINED)} AS explanation FROM scored""")
BUSINESS = below("probability", [(0.3, "LOW_RISK"), (0.8, "MEDIUM_RISK")], "HIGH_RISK")
sql("aml_business_alert", ["scored"], f"""
SELECT event_id, {BUSINESS} AS business_risk, {at_least(0.01, "'AML_ALERT'", "'NO_ALERT'")} AS alert_status,
  probability >= 0.01::DOUBLE AS requires_review FROM scored""")
sql("threshold_lookup", ["scored"], """
SELECT event_id, CASE WHEN label = 1 THEN probability ELSE 0.20::DOUBLE END AS business_threshold,
  CASE WHEN label = 1 THEN 0.24::DOUBLE ELSE probability END AS best_f1_threshold FROM scored""")

# --- integrated ------------------------------------------------------------------------------------------
sql("first_value", ["assessed"], """
SELECT customer_id, credit_probability, round(credit_score, 6) AS credit_score, credit_segment, credit_decision,
  fraud_probability, round(fraud_score, 6) AS fraud_score, fraud_segment, fraud_decision,
  aml_probability, round(aml_score, 6) AS aml_score, aml_segment, aml_decision,
  CASE WHEN aml_probability >= 0.5::DOUBLE THEN 'AML_ALERT' ELSE 'NO_ALERT' END AS aml_alert_status FROM assessed""")
sql("normalize_probability", [], """
SELECT event_id, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN v > 1 THEN v / 100 ELSE v END)), 6) AS probability
FROM (SELECT event_id, value::DECIMAL(12,2)::DOUBLE AS v FROM events)""")
sql("normalize_score", [], """
SELECT event_id, round(greatest(0.0::DOUBLE, least(100.0::DOUBLE, CASE WHEN v <= 1 THEN v * 100 ELSE v END)), 6) AS score
FROM (SELECT event_id, value / 50 AS v FROM events)""")
sql("integrated_score", ["assessed"], "SELECT customer_id, overall_risk_score FROM assessed")
sql("integrated_tier", ["assessed"], "SELECT customer_id, risk_tier FROM assessed")
sql("integrated_alert", ["assessed"], "SELECT customer_id, alert_status, alert_triggered FROM assessed")
sql("top_risk_driver", ["assessed"], "SELECT customer_id, top_risk_driver FROM assessed")
COMPONENTS = " UNION ALL ".join(
    f"""SELECT customer_id, '{title}' AS risk_domain, round({d}_score, 6) AS risk_score, {d}_probability AS probability,
    {d}_segment AS risk_segment, {d}_decision AS decision, {w}::DOUBLE AS weight FROM assessed"""
    for d, title, w in (("credit", "Credit Risk", 0.35), ("fraud", "Fraud Risk", 0.35), ("aml", "AML Risk", 0.3)))
sql("risk_components", ["assessed"], COMPONENTS)
SUMMARY = """customer_id, overall_risk_score, risk_tier, alert_status, alert_triggered, top_risk_driver"""
sql("executive_summary", ["assessed"], f"""
SELECT {SUMMARY}, round(credit_score, 6) AS credit_score, round(fraud_score, 6) AS fraud_score, round(aml_score, 6) AS aml_score,
  credit_probability, fraud_probability, aml_probability FROM assessed""")
sql("integrated_dashboard", ["assessed"], f"""
SELECT {SUMMARY}, 'summary' AS section, NULL AS risk_domain, NULL AS risk_score, NULL AS probability, NULL AS risk_segment,
  NULL AS decision, NULL AS weight FROM assessed
UNION ALL BY NAME SELECT *, 'component' AS section FROM ({COMPONENTS})""")
sql("alert_distribution", ["assessed"], """
SELECT risk_tier, alert_status, count(*) AS customers, count(*) FILTER (WHERE alert_triggered) AS alerts_triggered,
  round(avg(overall_risk_score), 6) AS average_score FROM assessed GROUP BY 1, 2""")
sql("assess_requests", ["requests", "assessed"], """
SELECT request_id, customer_id, transaction_amount, country_from, country_to, currency, cross_border, high_value,
  round(credit_score, 6) AS credit_score, credit_segment, round(fraud_score, 6) AS fraud_score, round(aml_score, 6) AS aml_score,
  round(overall_score, 6) AS overall_score, risk_tier, alert_status, top_risk_driver,
  risk_tier = 'LOW' AND alert_status = 'NO_ALERT' AS approved,
  CASE WHEN risk_tier = 'LOW' AND alert_status = 'NO_ALERT' THEN 'Transaction is LOW risk and requires no review.'
       ELSE 'Transaction requires risk review.' END AS reason, saved_engine_score, saved_engine_risk_tier
FROM (SELECT *, CASE WHEN risk_tier IN ('HIGH', 'CRITICAL') OR credit_decision IN ('HIGH_RISK', 'REVIEW')
        OR fraud_decision IN ('HIGH_RISK', 'REVIEW') OR aml_decision IN ('HIGH_RISK', 'REVIEW') THEN 'REVIEW_REQUIRED' ELSE 'NO_ALERT' END AS alert_status
  FROM (SELECT *, CASE WHEN overall_score >= 75 THEN 'CRITICAL' WHEN overall_score >= 50 THEN 'HIGH' WHEN overall_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
          CASE WHEN credit_score = overall_score THEN 'credit_risk' WHEN fraud_score = overall_score THEN 'fraud_risk' ELSE 'aml_risk' END AS top_risk_driver
    FROM (SELECT *, greatest(credit_score, fraud_score, aml_score) AS overall_score
      FROM (SELECT request_id, customer_id, transaction_amount, country_from, country_to, currency, cross_border, high_value,
              coalesce(credit_probability, 0) * 100 AS credit_score, coalesce(fraud_probability, 0) * 100 AS fraud_score,
              least(100.0::DOUBLE, coalesce(aml_probability, 0) * 100 + CASE WHEN high_value THEN 10 ELSE 0 END + CASE WHEN cross_border THEN 5 ELSE 0 END) AS aml_score,
              coalesce(CASE credit_segment WHEN 'Low Risk' THEN 'LOW RISK' WHEN 'High Risk' THEN 'HIGH RISK' ELSE credit_segment END, 'UNKNOWN') AS credit_segment, coalesce(credit_decision, 'UNKNOWN') AS credit_decision,
              coalesce(fraud_decision, 'UNKNOWN') AS fraud_decision, coalesce(aml_decision, 'UNKNOWN') AS aml_decision,
              coalesce(saved_score, 0) AS saved_engine_score, coalesce(saved_tier, 'UNKNOWN') AS saved_engine_risk_tier
        FROM (SELECT r.request_id, r.customer_id, r.transaction_amount, upper(trim(r.country_from)) AS country_from,
                upper(trim(r.country_to)) AS country_to, upper(trim(r.currency)) AS currency,
                upper(trim(r.country_from)) <> upper(trim(r.country_to)) AS cross_border, r.transaction_amount >= 10000 AS high_value,
                a.credit_probability, a.fraud_probability, a.aml_probability, a.credit_segment, a.credit_decision, a.fraud_decision, a.aml_decision,
                a.overall_risk_score AS saved_score, a.risk_tier AS saved_tier
              FROM requests r LEFT JOIN assessed a ON a.customer_id::VARCHAR = r.customer_id WHERE r.is_valid)))))""")
sql("normalize_segment", ["domain_results"], "SELECT customer_id, aml_segment, credit_segment FROM domain_results")
sql("normalize_segment", ["domain_results"], """
SELECT customer_id, aml_segment, CASE credit_segment WHEN 'Low Risk' THEN 'LOW RISK' WHEN 'High Risk' THEN 'HIGH RISK' ELSE credit_segment END AS credit_segment
FROM domain_results""")
sql("clean_decision", ["domain_results"], "SELECT customer_id, credit_decision, fraud_decision FROM domain_results")

# --- features ----------------------------------------------------------------------------------------------
ROUNDED = """* REPLACE (round("RevolvingUtilizationOfUnsecuredLines", 6) AS "RevolvingUtilizationOfUnsecuredLines",
  round("DebtRatio", 6) AS "DebtRatio", round("MonthlyIncome", 6) AS "MonthlyIncome", round("IncomePerDependent", 6) AS "IncomePerDependent")"""
sql("credit_features", ["credit"], f"SELECT {ROUNDED} FROM credit")
sql("fraud_features", ["fraud"], f"SELECT {ROUNDED} FROM fraud")
sql("aml_time_features", ["aml"], """
SELECT record_key, transaction_hour, transaction_day, transaction_month, transaction_day_of_week, is_weekend FROM aml""")
AMOUNTS = ["amount_difference", "amount_difference_abs", "amount_ratio", "log_amount_received", "log_amount_paid"]
sql("aml_amount_features", ["aml"], f"SELECT record_key, {', '.join(f'round({c}, 6) AS {c}' for c in AMOUNTS)} FROM aml")
sql("aml_relation_flags", ["aml"], """
SELECT record_key, cross_border_transaction, same_country, currency_conversion, same_currency, same_bank, same_account FROM aml""")
sql("aml_high_value", ["aml"], "SELECT record_key, high_value_transaction FROM aml")
sql("aml_mismatch_flags", ["aml"], "SELECT record_key, amount_mismatch_flag, cross_border_currency_flag FROM aml")
ONEHOT = ", ".join(f"""CASE WHEN payment_format = '{f}' THEN 1 ELSE 0 END::BIGINT AS "payment_format_{f}" """ for f in FORMATS)
sql("aml_payment_onehot", ["aml_transfers"], f"SELECT record_key, {ONEHOT} FROM aml_transfers")
sql("aml_features", ["aml"], f"""
SELECT * EXCLUDE ("timestamp", payment_format) REPLACE (is_laundering::BIGINT AS is_laundering,
  {', '.join(f'round({c}, 6) AS {c}' for c in AMOUNTS)}), {ONEHOT} FROM aml""")
sql("feature_summary", ["fraud"], """
SELECT 'AgeBand' AS feature, coalesce("AgeBand", '(missing)') AS value, count(*) AS "count" FROM fraud GROUP BY 2
UNION ALL SELECT 'RiskIndicator', "RiskIndicator"::VARCHAR, count(*) FROM fraud GROUP BY 2
UNION ALL SELECT 'SeriousDlqin2yrs', "SeriousDlqin2yrs"::VARCHAR, count(*) FROM fraud GROUP BY 2""" + "".join(
    f"""
UNION ALL SELECT 'missing_values', '{c}', count(*) FROM fraud WHERE "{c}" IS NULL HAVING count(*) > 0""" for c in FRAUD_COLUMNS))
sql("mask_pii", ["customers", "accounts"], """
SELECT customer_id, customer_code, gender, sha256('catalog:out:' || sha256('catalog:in:' || pan_number)) AS pan_number, customer_type, risk_category, kyc_status, record_status,
  '****' || right(account_number, 4) AS account_number FROM customers JOIN accounts USING (customer_id)""")
sql("model_title", [], """SELECT title, count(*) AS scores FROM events,
(VALUES ('Logistic Regression'), ('Random Forest'), ('Gradient Boosting')) AS m(title) GROUP BY title""")

FINGERPRINTS = {"customer": ["c_custkey", "c_name", "c_mktsegment"], "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
                "documents": ["doc_id", "lang", "source", "text"]}
sql("source_fingerprint", [], " UNION ALL ".join(
    f"SELECT '{table}' AS source_table, count(*) AS row_count, coalesce(sum(('0x' || md5(" + " || chr(10) || ".join(
        f"coalesce({c}::VARCHAR, chr(92) || 'N')" for c in columns) + f")[1:8])::BIGINT), 0)::BIGINT AS hash_sum FROM {table}"
    for table, columns in FINGERPRINTS.items()))

sql("report_lines", ["alerts", "accounts"], """
SELECT 0::BIGINT AS section, 0::BIGINT AS place, '{"alerts":[' AS line UNION ALL
SELECT 0, row_number() OVER (ORDER BY transaction_id), CASE WHEN row_number() OVER (ORDER BY transaction_id) > 1 THEN ',' ELSE '' END || to_json(
  {'transaction_id': transaction_id, 'risk_level': risk_level, 'alert_status': alert_status, 'investigation_notes': investigation_notes})::VARCHAR FROM alerts UNION ALL
SELECT 1, 0, '],"accounts":[' UNION ALL
SELECT 1, row_number() OVER (ORDER BY account_id), CASE WHEN row_number() OVER (ORDER BY account_id) > 1 THEN ',' ELSE '' END || to_json(
  {'account_id': account_id, 'account_status': account_status, 'currency_code': currency_code})::VARCHAR FROM accounts UNION ALL
SELECT 2, 0, ']}'""")

# --- split and encode ------------------------------------------------------------------------------------------
SPLIT = """split AS (SELECT *, CASE WHEN position <= wanted THEN 'validation' ELSE 'train' END AS split FROM (
  SELECT *, least(greatest(round(0.2::DOUBLE * count(*) OVER (PARTITION BY "SeriousDlqin2yrs"))::BIGINT, 1),
                  count(*) OVER (PARTITION BY "SeriousDlqin2yrs") - 1) AS wanted,
    row_number() OVER (PARTITION BY "SeriousDlqin2yrs" ORDER BY md5('42:' || applicant_id), applicant_id) AS position FROM @source))"""


def split_sql(name: str, source: str, text: str) -> None:
    SQL[name] = with_views([source], "@").replace("\n@", ",\n" + SPLIT.replace("@source", source) + "\n" + text)


split_sql("stratified_split", "applicants", 'SELECT applicant_id, "SeriousDlqin2yrs", split FROM split')
split_sql("split_summary", "applicants", """
SELECT split, count(*) AS row_count, count(*) FILTER (WHERE "SeriousDlqin2yrs" = 1) AS positives,
  count(*) FILTER (WHERE "SeriousDlqin2yrs" = 0) AS negatives FROM split GROUP BY 1""")


def median(c: str) -> str:
    return f"""(SELECT quantile_cont("{c}", 0.5) FROM split WHERE split = 'train')"""


split_sql("impute_median", "applicants", f"""
SELECT applicant_id, split, round(coalesce("MonthlyIncome", {median('MonthlyIncome')}), 6) AS "MonthlyIncome",
  round(coalesce("NumberOfDependents", {median('NumberOfDependents')}), 6) AS "NumberOfDependents" FROM split""")
sql("impute_mode", ["accounts"], """
SELECT account_id, coalesce(account_status, (SELECT account_status FROM accounts WHERE account_status IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS account_status,
  coalesce(currency_code, (SELECT currency_code FROM accounts WHERE currency_code IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS currency_code
FROM accounts""")


def scaled(c: str) -> str:
    filled = f'coalesce("{c}", {median(c)})'
    return f"""round(({filled} - (SELECT avg({filled}) FROM split WHERE split = 'train'))
      / coalesce(nullif((SELECT stddev_pop({filled}) FROM split WHERE split = 'train'), 0), 1), 6) AS "numeric__{c}" """


split_sql("standard_scale", "applicants", "SELECT applicant_id, split, " + ", ".join(
    scaled(c) for c in ("DebtRatio", "RevolvingUtilizationOfUnsecuredLines", "MonthlyIncome")) + " FROM split")
MODE_BAND = """(SELECT "AgeBand" FROM split WHERE split = 'train' AND "AgeBand" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""
BANDS = ["18-25", "26-35", "36-50", "51-65", "66+"]
ENCODED = ", ".join(
    f"""CASE WHEN coalesce("AgeBand", {MODE_BAND}) = '{b}' THEN 1.0 ELSE 0.0 END::DOUBLE AS "categorical__AgeBand_{b}" """ for b in BANDS)
split_sql("onehot_ignore", "fraud", f"SELECT applicant_id, split, {ENCODED} FROM split")
split_sql("column_transform", "fraud", 'SELECT applicant_id, split, "SeriousDlqin2yrs", ' + ", ".join(scaled(c) for c in (
    "RevolvingUtilizationOfUnsecuredLines", "age", "DebtRatio", "MonthlyIncome", "NumberOfDependents", "IncomePerDependent"))
    + f", {ENCODED} FROM split")
def unnamed(column: str) -> str:
    return column.rsplit(" AS ", 1)[0].replace(", 6)", ", 5)")


FEATURES = [unnamed(scaled(c)) for c in (
    "RevolvingUtilizationOfUnsecuredLines", "age", "DebtRatio", "MonthlyIncome", "NumberOfDependents", "IncomePerDependent")] + [
    unnamed(c) for c in ENCODED.split(" , ")]
split_sql("encode_stage", "fraud", f"""SELECT applicant_id, split, unnest(range({len(FEATURES)})) AS position,
  unnest([{", ".join(FEATURES)}]) AS value FROM split""")
sql("class_weights", ["applicants"], """
SELECT "SeriousDlqin2yrs" AS target, count(*) AS "count", round((SELECT count(*) FROM applicants) / (2.0::DOUBLE * count(*)), 9) AS weight
FROM applicants GROUP BY 1""")

# --- metrics ------------------------------------------------------------------------------------------------------
DERIVED = """round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 9) AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp / (tp + fp)::DOUBLE, 9) END AS "precision",
  CASE WHEN tp + fn = 0 THEN 0 ELSE round(tp / (tp + fn)::DOUBLE, 9) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 9) END AS f1_score"""
CELLS = """count(*) FILTER (WHERE label = 0 AND probability < t) AS tn, count(*) FILTER (WHERE label = 0 AND probability >= t) AS fp,
  count(*) FILTER (WHERE label = 1 AND probability < t) AS fn, count(*) FILTER (WHERE label = 1 AND probability >= t) AS tp"""


def grid(low: int, high: int, step: int) -> str:
    return f"(SELECT i / 100.0::DOUBLE AS t FROM range({low}, {high}, {step}) g(i))"


def sweep(points: str) -> str:
    return f"""SELECT t AS threshold, tn, fp, fn, tp, {DERIVED}, tp + fp AS predicted_positive
      FROM (SELECT t, {CELLS} FROM scored, {points} GROUP BY t)"""


FINE, COARSE, TENS = grid(1, 100, 1), grid(5, 100, 5), grid(5, 51, 5)
sql("confusion_at", ["scored"], f"SELECT tn, fp, fn, tp, {DERIVED} FROM (SELECT {CELLS} FROM scored, (SELECT 0.5::DOUBLE AS t))")
sql("threshold_sweep", ["scored"], sweep(FINE))
sql("threshold_sweep_coarse", ["scored"], sweep(COARSE))
sql("threshold_sweep_credit", ["scored"], sweep(TENS))
sql("best_f1_threshold", ["scored"], f"SELECT * FROM ({sweep(FINE)}) ORDER BY f1_score DESC, recall DESC, \"precision\" DESC, threshold LIMIT 1")


def floored(points: str, floor: float, prefer: str, fallback: str, tie: str) -> str:
    return f"""SELECT *, recall >= {floor}::DOUBLE AS meets_floor FROM ({sweep(points)})
    ORDER BY recall >= {floor}::DOUBLE DESC, {', '.join(f'CASE WHEN recall >= {floor}::DOUBLE THEN {c} END DESC NULLS LAST' for c in prefer.split())},
      {', '.join(f'{c} DESC' for c in fallback.split())}, threshold {tie} LIMIT 1"""


sql("business_threshold", ["scored"], floored(FINE, 0.5, '"precision" f1_score', 'recall "precision"', "ASC").replace(
    'recall DESC, "precision" DESC, threshold', "CASE WHEN recall < 0.5 THEN recall END DESC NULLS LAST, CASE WHEN recall < 0.5 THEN \"precision\" END DESC NULLS LAST, threshold"))
sql("aml_business_threshold", ["scored"], floored(FINE, 0.9, '"precision" f1_score', 'f1_score', "ASC"))
sql("recall_floor_threshold", ["scored"], f"""SELECT *, CASE WHEN meets_floor
  THEN 'Selected highest-F1 threshold among thresholds with recall >= 0.70.'
  ELSE 'No threshold satisfied the minimum recall requirement. Selected the threshold with highest recall.' END AS selection_reason
FROM ({floored(TENS, 0.7, 'f1_score "precision"', 'recall f1_score', 'DESC').replace('recall DESC, f1_score DESC, threshold', 'CASE WHEN recall < 0.7 THEN recall END DESC NULLS LAST, CASE WHEN recall < 0.7 THEN f1_score END DESC NULLS LAST, threshold')})""")


def areas(source: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    first = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {first}sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives,
      round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 9) AS roc_auc,
      round(sum(pos * tp / (tp + fp)) / sum(pos), 9) AS pr_auc
    FROM (SELECT *, (sum(pos) OVER ({part} ORDER BY probability DESC))::DOUBLE AS tp, (sum(neg) OVER ({part} ORDER BY probability DESC))::DOUBLE AS fp
      FROM (SELECT {first}probability, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
            FROM {source} GROUP BY {first}probability)) {group}"""


sql("roc_auc", ["scored"], f"SELECT positives, negatives, roc_auc FROM ({areas('scored')})")
sql("average_precision", ["scored"], f"SELECT positives, negatives, pr_auc AS average_precision FROM ({areas('scored')})")
sql("threshold_comparison", ["scored"], f"""
SELECT s.strategy, m.*, a.roc_auc, a.pr_auc FROM (VALUES ('default', 0.5::DOUBLE), ('best_f1', 0.24::DOUBLE), ('business', 0.18::DOUBLE)) s(strategy, t)
JOIN ({sweep("(VALUES (0.5::DOUBLE), (0.24::DOUBLE), (0.18::DOUBLE)) g(t)")}) m ON m.threshold = s.t, ({areas('scored')}) a""")


def compared(source: str) -> str:
    return f"""SELECT model, tn, fp, fn, tp, {DERIVED}, roc_auc, pr_auc
    FROM (SELECT model, {CELLS} FROM {source}, (SELECT 0.5::DOUBLE AS t) GROUP BY model) JOIN ({areas(source, 'model')}) USING (model)"""


sql("model_comparison", ["model_scores"], compared("model_scores"))
sql("select_model", ["model_scores"], f"SELECT * FROM ({compared('model_scores')}) ORDER BY pr_auc DESC, roc_auc DESC, f1_score DESC, model LIMIT 1")
SQL["model_performance_report"] = with_views(["applicants", "model_scores"], "@").replace("\n@", f""",
one AS (SELECT "SeriousDlqin2yrs" AS label, 'logistic_regression' AS model, (applicant_id * 37 % 101) / 100.0::DOUBLE AS probability FROM applicants)
SELECT * REPLACE (CASE model WHEN 'logistic_regression' THEN 'Logistic Regression' WHEN 'random_forest' THEN 'Random Forest' ELSE 'Gradient Boosting' END AS model)
FROM (SELECT 'Credit Risk' AS domain, * FROM ({compared('one')}) UNION ALL SELECT 'Fraud Detection', * FROM ({compared('model_scores')}))""")
sql("classification_report", ["scored"], """
SELECT "class", round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1_score, support FROM (
  WITH cells AS (SELECT count(*) FILTER (WHERE label = 0 AND probability < 0.5) AS tn, count(*) FILTER (WHERE label = 0 AND probability >= 0.5) AS fp,
            count(*) FILTER (WHERE label = 1 AND probability < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND probability >= 0.5) AS tp FROM scored),
  per AS (SELECT '0' AS "class", tn AS hit, fn AS wrong, fp AS missed FROM cells UNION ALL SELECT '1', tp, fp, fn FROM cells),
  m AS (SELECT "class", coalesce(hit / nullif(hit + wrong, 0)::DOUBLE, 0) AS "precision", coalesce(hit / nullif(hit + missed, 0)::DOUBLE, 0) AS recall,
          coalesce(2 * hit / nullif(2 * hit + wrong + missed, 0)::DOUBLE, 0) AS f1, (hit + missed)::BIGINT AS support FROM per)
  SELECT * FROM m UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support)::BIGINT FROM m
  UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT FROM m)""")
sql("segment_distribution", ["scored"], f"""
SELECT position::BIGINT AS position, s.risk_segment, count(x.risk_segment) AS "count", round(count(x.risk_segment) / (SELECT count(*) FROM scored)::DOUBLE * 100, 6) AS percentage
FROM (VALUES (0, 'Low Risk'), (1, 'Moderate Risk'), (2, 'High Risk'), (3, 'Very High Risk')) s(position, risk_segment)
LEFT JOIN (SELECT {FRAUD} AS risk_segment FROM scored) x ON x.risk_segment = s.risk_segment GROUP BY 1, 2""")
sql("prediction_table", ["scored"], f"""
SELECT event_id, label AS actual_target, probability AS default_probability, {at_least(0.5, '1', '0')}::BIGINT AS prediction_at_0_50,
  {at_least(0.24, '1', '0')}::BIGINT AS prediction_at_0_24, {at_least(0.18, '1', '0')}::BIGINT AS prediction_at_0_18, {CREDIT_CUT} AS risk_segment FROM scored""")
sql("probability_summary", ["scored"], """
SELECT min(probability) AS minimum, max(probability) AS maximum, round(avg(probability), 9) AS mean, round(quantile_cont(probability, 0.5), 9) AS median FROM scored""")

# --- explanations ------------------------------------------------------------------------------------------------------
U, D, N = '"RevolvingUtilizationOfUnsecuredLines"', '"DebtRatio"', '"TotalDelinquencyEvents"'
INCOME = """'Monthly income is approximately ' || format('{:,.2f}', coalesce("MonthlyIncome", 0)) || '.'"""


def two(c: str) -> str:
    return f"printf('%.2f', {c})"


sql("credit_reasons", ["credit"], f"""
SELECT applicant_id, concat_ws(' | ',
  CASE WHEN {N} > 0 THEN 'Customer has ' || {N} || ' delinquency event(s).' ELSE 'No delinquency events are present.' END,
  CASE WHEN "HasSevereDelinquency" > 0 THEN 'Severe delinquency indicator is present.' END,
  CASE WHEN "HighCreditUtilization" > 0 THEN 'Credit utilization is flagged as high.'
       WHEN {U} >= 0.70::DOUBLE THEN 'Credit utilization is relatively high (' || {two(U)} || ').'
       ELSE 'Credit utilization is moderate/low (' || {two(U)} || ').' END,
  CASE WHEN "HighDebtRatio" > 0 THEN 'Debt ratio is flagged as high.' WHEN {D} > 1 THEN 'Debt ratio is elevated (' || {two(D)} || ').'
       ELSE 'Debt ratio is within the observed range (' || {two(D)} || ').' END,
  CASE WHEN "MonthlyIncome" > 0 THEN {INCOME} END,
  'Predicted default probability is ' || {two('probability * 100')} || '%.',
  'Risk segment is classified as ' || ({CREDIT}) || '.',
  'Business credit decision is ' || {at_least(0.18, "'REVIEW'", "'LOW_RISK'")} || '.') AS reasons
FROM (SELECT *, (applicant_id * 37 % 101) / 100.0::DOUBLE AS probability FROM credit)""")
sql("fraud_reasons", ["fraud"], f"""
SELECT applicant_id, concat_ws(' | ',
  CASE WHEN {N} = 0 THEN 'No delinquency events are present.' ELSE {N} || ' delinquency event(s) are present.' END,
  'Credit utilization is ' || CASE WHEN {U} <= 0.30::DOUBLE THEN 'low' WHEN {U} <= 0.70::DOUBLE THEN 'moderate' ELSE 'high' END || ' (' || {two(U)} || ').',
  'Debt ratio is ' || CASE WHEN {D} <= 0.50::DOUBLE THEN 'relatively low' WHEN {D} <= 1 THEN 'within the observed range' ELSE 'elevated' END || ' (' || {two(D)} || ').',
  {INCOME}, 'Predicted fraud probability is ' || {two('probability * 100')} || '%.', 'Risk segment is classified as ' || ({FRAUD}) || '.') AS reasons
FROM (SELECT *, (applicant_id * 37 % 101) / 100.0::DOUBLE AS probability FROM fraud)""")
sql("aml_reasons", ["aml"], """
SELECT record_key, coalesce(nullif(concat_ws(' | ', CASE WHEN cross_border_transaction = 1 THEN 'Cross-border transaction' END,
  CASE WHEN currency_conversion = 1 THEN 'Currency conversion' END, CASE WHEN amount_mismatch_flag = 1 THEN 'Amount mismatch' END,
  CASE WHEN high_value_transaction = 1 THEN 'High-value transaction' END), ''), 'No major AML risk indicator detected') AS reasons FROM aml""")
SCORED_TRANSFERS = "(SELECT record_key, least((amount_received * 100)::DECIMAL(18,0)::BIGINT, 10000000) / 1e7::DOUBLE AS probability FROM aml_transfers)"
sql("aml_report", ["aml_transfers"], f"""
SELECT record_key, 'logistic_regression' AS model_type, round(probability, 8) AS aml_probability, round(probability * 100, 6) AS aml_probability_percent,
  {at_least(0.5, '1', '0')}::BIGINT AS model_prediction, {aml3('AML_ALERT', 'REVIEW', 'LOW_RISK')} AS model_decision,
  {aml3('HIGH RISK', 'MEDIUM RISK', 'LOW RISK')} AS risk_segment, {BUSINESS} AS business_risk,
  {at_least(0.01, "'AML_ALERT'", "'NO_ALERT'")} AS alert_status, probability >= 0.01::DOUBLE AS requires_review, {aml3(*EXPLAINED)} AS business_explanation,
  0.5::DOUBLE AS default_threshold, 0.01::DOUBLE AS best_f1_threshold, 0.01::DOUBLE AS business_threshold FROM {SCORED_TRANSFERS}""")
sql("aml_alerts", ["aml_transfers"], f"""
SELECT 'AML-' || record_key AS alert_id, round(probability, 8) AS aml_probability, {BUSINESS} AS risk_segment,
  {at_least(0.01, "'AML_ALERT'", "'NO_ALERT'")} AS alert_status, {aml3('AML_ALERT', 'REVIEW', 'LOW_RISK')} AS aml_decision,
  probability >= 0.01::DOUBLE AS requires_review FROM {SCORED_TRANSFERS}""")
AML_FLAGS = ["cross_border_transaction", "currency_conversion", "same_bank", "amount_mismatch_flag", "cross_border_currency_flag"]


def gaps(source: str, label: str, columns: list[str]) -> str:
    """Per flag the distance of its shares on both sides of the label."""
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, abs(coalesce(sum("{c}") FILTER (WHERE {label})::DOUBLE / nullif(count(*) FILTER (WHERE {label}), 0), 0)
        - coalesce(sum("{c}") FILTER (WHERE NOT {label})::DOUBLE / nullif(count(*) FILTER (WHERE NOT {label}), 0), 0)) AS importance FROM {source}"""
        for c in columns)


RANKED = """SELECT row_number() OVER (ORDER BY importance DESC, feature) AS rank, feature, importance,
  CASE WHEN sum(importance) OVER () > 0 THEN importance / sum(importance) OVER () ELSE 0.0::DOUBLE END AS share"""
sql("aml_report_features", ["aml"], f"""
SELECT feature, round(importance, 6) AS importance FROM ({gaps('aml', 'is_laundering', AML_FLAGS)}) ORDER BY importance DESC, feature LIMIT 3""")
sql("rank_importance", ["aml"], f"""
SELECT rank, feature, round(importance, 9) AS importance, round(share, 9) AS importance_normalized, round(share * 100, 9) AS importance_percentage
FROM ({RANKED} FROM ({gaps('aml', 'is_laundering', AML_FLAGS)}))""")
APPLICANT_FLAGS = ["HasDelinquency", "HasSevereDelinquency", "HighCreditUtilization", "HighDebtRatio", "NumberOfOpenCreditLinesAndLoans", "RiskIndicator"]
_gaps = gaps("fraud", '"SeriousDlqin2yrs" = 1', APPLICANT_FLAGS)
sql("explain_applicant_flags", ["fraud"], f"""
SELECT applicant_id, feature, 'numeric__' || feature AS model_feature, CASE feature {" ".join(f"WHEN '{c}' THEN {chr(34)}{c}{chr(34)}::VARCHAR" for c in APPLICANT_FLAGS)} END AS row_value,
  round(importance, 6) AS importance, rank FROM fraud, (SELECT * FROM ({RANKED} FROM ({_gaps})) WHERE rank <= 4)""")
CARD = """ -2.0::DOUBLE + 0.75 * "HasDelinquency" + 1.5 * "HasSevereDelinquency" + 0.5 * "HighCreditUtilization" + 0.25 * "HighDebtRatio" + 0.125 * "RiskIndicator" """
sql("scorecard_score", ["credit"], f"""
SELECT applicant_id, round(p, 6) AS default_probability,
  CASE WHEN p < 0.18::DOUBLE THEN 'Low Risk' WHEN p < 0.24::DOUBLE THEN 'Moderate Risk' WHEN p < 0.50::DOUBLE THEN 'High Risk' ELSE 'Very High Risk' END AS risk_segment,
  CASE WHEN p >= 0.18::DOUBLE THEN 'REVIEW' ELSE 'LOW_RISK' END AS credit_decision
FROM (SELECT applicant_id, round(1 / (1 + exp(-({CARD}))), 10) AS p FROM credit
  WHERE age BETWEEN 18 AND 120 AND "MonthlyIncome" >= 0 AND "DebtRatio" >= 0 AND "RevolvingUtilizationOfUnsecuredLines" >= 0)""")
sql("aml_dashboard", ["aml_transfers"], """
SELECT count(*) AS dataset_rows, 14::BIGINT AS dataset_columns, count(*) FILTER (WHERE NOT is_laundering) AS legitimate_transactions,
  count(*) FILTER (WHERE is_laundering) AS laundering_transactions, round(count(*) FILTER (WHERE is_laundering) / count(*)::DOUBLE * 100, 6) AS laundering_rate_percent,
  'logistic_regression' AS model_type, 0.5::DOUBLE AS default_threshold, 0.01::DOUBLE AS best_f1_threshold, 0.01::DOUBLE AS business_threshold FROM aml_transfers""")

# --- reporting -----------------------------------------------------------------------------------------------------------
VALUE = "sum(transaction_amount)::DOUBLE"
sql("txn_kpis", ["transactions"], f"""
SELECT count(*) AS total_transactions, {VALUE} AS transaction_value, round(avg(transaction_amount::DOUBLE), 6) AS average_amount,
  min(transaction_amount)::DOUBLE AS minimum_amount, max(transaction_amount)::DOUBLE AS maximum_amount,
  count(*) FILTER (WHERE transaction_status = 'Success') AS successful_transactions, count(*) FILTER (WHERE transaction_status = 'Failed') AS failed_transactions,
  count(*) FILTER (WHERE transaction_status = 'Pending') AS pending_transactions,
  round(count(*) FILTER (WHERE transaction_status = 'Success') / count(*)::DOUBLE, 6) AS success_rate FROM transactions""")
for _name, _column in (("txn_by_status", "transaction_status"), ("txn_by_channel", "transaction_channel")):
    sql(_name, ["transactions"], f"""
    SELECT {_column}, count(*) AS transaction_count, {VALUE} AS transaction_value,
      round(count(*) / (SELECT count(*) FROM transactions)::DOUBLE, 6) AS transaction_share FROM transactions GROUP BY 1""")
sql("alert_kpis", ["alerts", "transactions"], """
SELECT count(*) AS fraud_alerts, round(avg(fraud_score::DOUBLE), 6) AS average_fraud_score, min(fraud_score)::DOUBLE AS minimum_fraud_score,
  max(fraud_score)::DOUBLE AS maximum_fraud_score, count(*) FILTER (WHERE alert_status = 'Open') AS open_alerts,
  count(*) FILTER (WHERE risk_level = 'High') AS high_alerts, count(*) FILTER (WHERE risk_level = 'Critical') AS critical_alerts,
  (SELECT count(*) FROM transactions) AS total_transactions, round(count(*) / (SELECT count(*) FROM transactions)::DOUBLE, 6) AS alert_rate FROM alerts""")
sql("kyc_kpis", ["customer_kyc"], """
SELECT count(*) AS kyc_records, count(*) FILTER (WHERE pan_verified) AS pan_verified, count(*) FILTER (WHERE aadhaar_verified) AS aadhaar_verified,
  count(*) FILTER (WHERE pep_flag) AS pep_flag, count(*) FILTER (WHERE sanctions_flag) AS sanctions_flag FROM customer_kyc""")
sql("risk_mix", ["customers", "merchants"], """
SELECT 'customer' AS entity, risk_category AS risk, count(*) AS "count" FROM customers GROUP BY 2
UNION ALL SELECT 'merchant', risk_level, count(*) FROM merchants GROUP BY 2""")
sql("txn_trend", ["transactions"], f"""
SELECT transaction_timestamp::DATE::VARCHAR AS transaction_date, count(*) AS transaction_count, {VALUE} AS transaction_value FROM transactions GROUP BY 1""")
sql("alert_trend", ["alerts", "transactions"], """
SELECT transaction_timestamp::DATE::VARCHAR AS alert_date, count(*) AS fraud_alerts, round(avg(fraud_score::DOUBLE), 6) AS average_fraud_score
FROM alerts JOIN transactions USING (transaction_id) GROUP BY 1""")
sql("alert_matrix", ["alerts", "transactions"], f"""
SELECT coalesce(risk_level, '(all)') AS risk_level, coalesce(alert_status, '(all)') AS alert_status, coalesce(detection_source, '(all)') AS detection_source,
  (3 - grouping(risk_level) - grouping(alert_status) - grouping(detection_source))::BIGINT AS depth, count(*) AS alert_count,
  round(avg(fraud_score::DOUBLE), 6) AS average_fraud_score, {VALUE} AS fraud_amount
FROM alerts JOIN transactions USING (transaction_id) GROUP BY ROLLUP (risk_level, alert_status, detection_source)""")
sql("channel_risk", ["alerts", "transactions"], f"""
SELECT transaction_channel, count(*) AS transaction_count, {VALUE} AS transaction_value, count(a.transaction_id) AS fraud_alerts,
  round(count(a.transaction_id) / count(*)::DOUBLE, 6) AS alert_rate
FROM transactions t LEFT JOIN alerts a USING (transaction_id) GROUP BY 1""")
sql("vw_transaction_risk", ["scored_transactions"], """
SELECT transaction_id, account_id, strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp, transaction_type, transaction_channel,
  transaction_status, transaction_amount::DOUBLE AS transaction_amount, customer_type, customer_risk, kyc_risk, pep_flag, sanctions_flag,
  card_status, merchant_risk, merchant_country, trusted_device, risk_score, risk_level FROM scored_transactions""")
sql("dim_date", ["transactions"], """
SELECT d::DATE::VARCHAR AS date, year(d)::BIGINT AS year, quarter(d)::BIGINT AS quarter, monthname(d) AS month, month(d)::BIGINT AS month_number,
  weekofyear(d)::BIGINT AS week, day(d)::BIGINT AS day, dayname(d) AS day_of_week
FROM (SELECT unnest(generate_series(min(transaction_timestamp)::DATE::TIMESTAMP, max(transaction_timestamp)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM transactions)""")

# --- event-time rules --------------------------------------------------------------------------------------------------------
TRAILING = """SELECT *, count(*) OVER w AS window_count, (sum(amount) OVER w)::DOUBLE AS window_sum, max(amount) OVER w AS largest FROM events_in
  WINDOW w AS (PARTITION BY account_id ORDER BY ts RANGE BETWEEN INTERVAL 1440 MINUTE PRECEDING AND CURRENT ROW)"""
HIT = "event_id, account_id, '{code}' AS rule_code, '{severity}' AS severity, window_count, window_sum"
sql("aml_velocity_rule", ["events_in"], f"SELECT {HIT.format(code='VEL01', severity='High')} FROM ({TRAILING}) WHERE window_count >= 5")
sql("aml_structuring_rule", ["events_in"], f"""
SELECT {HIT.format(code='STR01', severity='Critical')} FROM ({TRAILING}) WHERE window_count >= 4 AND largest < 100 AND window_sum >= 100""")
sql("aml_high_value_rule", ["events_in"], """
SELECT event_id, account_id, 'HIV01' AS rule_code, 'Medium' AS severity, 1::BIGINT AS window_count, amount::DOUBLE AS window_sum
FROM events_in WHERE amount >= 150""")
sql("aml_cross_border_rule", ["aml_transfers"], """
SELECT record_key, from_account, rule_code, severity, 1::BIGINT AS window_count, amount_received::DECIMAL(18,2)::DOUBLE AS window_sum
FROM aml_transfers JOIN (VALUES ('XBR01', 'High', 50000), ('XBR02', 'Low', NULL)) AS r(rule_code, severity, least_amount)
  ON from_country <> to_country AND (least_amount IS NULL OR amount_received >= least_amount)""")
