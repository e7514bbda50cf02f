"""The domain views of ``riskweave.sources.views`` as plain SQL, for checking results."""

FORMATS = ["ACH", "Bitcoin", "Cash", "Cheque", "Credit Card", "Reinvestment", "Wire"]


def modulo_risk(key: str) -> str:
    return f"CASE WHEN {key} % 20 = 0 THEN 'High' WHEN {key} % 5 = 0 THEN 'Medium' ELSE 'Low' END"


VIEWS = {
    "transactions": (
        [], """
        SELECT o_orderkey AS transaction_id,
          'TXN' || repeat('0', greatest(0, 15 - length(o_orderkey::VARCHAR))) || o_orderkey::VARCHAR AS transaction_reference,
          o_custkey AS account_id,
          CASE WHEN o_orderkey % 4 <> 3 THEN o_custkey END AS card_id,
          CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % (SELECT count(*) FROM supplier) END AS merchant_id,
          CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 50 END AS device_id,
          o_orderdate AS transaction_timestamp,
          CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'RTGS' WHEN '2' THEN 'Cash Withdrawal'
            WHEN '3' THEN 'Purchase' WHEN '4' THEN 'UPI' WHEN '5' THEN 'NEFT' END AS transaction_type,
          CASE o_orderkey % 5 WHEN 0 THEN 'ATM' WHEN 1 THEN 'POS' WHEN 2 THEN 'Mobile'
            WHEN 3 THEN 'Internet Banking' WHEN 4 THEN 'Branch' END AS transaction_channel,
          CASE WHEN o_orderkey % 2 = 0 THEN 'D' ELSE 'C' END AS debit_credit,
          o_totalprice::DECIMAL(18,2) AS transaction_amount,
          'INR' AS currency_code,
          CASE WHEN o_orderkey % 97 = 0 THEN 'Reversed' WHEN o_orderstatus = 'F' THEN 'Success'
            WHEN o_orderstatus = 'P' THEN 'Pending' WHEN o_orderkey % 10 = 0 THEN 'Failed' ELSE 'Success' END AS transaction_status
        FROM orders"""),
    "customers": (
        [], f"""
        SELECT c_custkey AS customer_id,
          'CUST' || repeat('0', greatest(0, 6 - length(c_custkey::VARCHAR))) || c_custkey::VARCHAR AS customer_code,
          'Customer' AS first_name, 'Demo' || c_custkey AS last_name,
          DATE '1980-01-01' + ((c_custkey * 137) % 12000)::INTEGER AS date_of_birth,
          CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
          'customer' || c_custkey || '@bank.example' AS email,
          '9' || repeat('0', greatest(0, 9 - length(c_custkey::VARCHAR))) || c_custkey::VARCHAR AS mobile_number,
          'ABCDE' || repeat('0', greatest(0, 4 - length(c_custkey::VARCHAR))) || c_custkey::VARCHAR || 'F' AS pan_number,
          CASE WHEN c_custkey % 10 = 0 THEN 'Corporate' ELSE 'Individual' END AS customer_type,
          {modulo_risk('c_custkey')} AS risk_category,
          'Verified' AS kyc_status, 'Active' AS record_status
        FROM customer"""),
    "branches": (
        [], """
        SELECT (r_regionkey + 1)::BIGINT AS branch_id, 'BR' || repeat('0', greatest(0, 3 - length((r_regionkey + 1)::VARCHAR))) || (r_regionkey + 1)::VARCHAR AS branch_code,
          r_name AS region, 'Active' AS branch_status
        FROM region"""),
    "accounts": (
        [], """
        SELECT c_custkey AS account_id, 'AC' || repeat('0', greatest(0, 10 - length(c_custkey::VARCHAR))) || c_custkey::VARCHAR AS account_number, c_custkey AS customer_id,
          ((c_custkey - 1) % 5 + 5) % 5 + 1 AS branch_id,
          CASE WHEN c_custkey % 10 = 0 THEN 'Current' ELSE 'Savings' END AS account_type,
          CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE 'Active' END AS account_status,
          c_acctbal::DECIMAL(18,2) AS opening_balance, c_acctbal::DECIMAL(18,2) AS current_balance,
          CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'INR' END AS currency_code
        FROM customer"""),
    "customer_kyc": (
        [], f"""
        SELECT c_custkey AS customer_id, 'ABCDE' || repeat('0', greatest(0, 4 - length(c_custkey::VARCHAR))) || c_custkey::VARCHAR || 'F' AS pan_number,
          repeat('0', greatest(0, 12 - length(c_custkey::VARCHAR))) || c_custkey::VARCHAR AS aadhaar_number,
          c_custkey % 9 <> 0 AS pan_verified, c_custkey % 11 <> 0 AS aadhaar_verified,
          {modulo_risk('c_custkey')} AS risk_rating, c_custkey % 40 = 0 AS pep_flag, c_custkey % 100 = 0 AS sanctions_flag
        FROM customer WHERE c_acctbal >= 0"""),
    "cards": (
        [], """
        SELECT c_custkey AS card_id, c_custkey AS account_id, '4' || repeat('0', greatest(0, 15 - length(c_custkey::VARCHAR))) || c_custkey::VARCHAR AS card_number,
          CASE WHEN c_custkey % 3 = 0 THEN 'Credit' ELSE 'Debit' END AS card_type,
          CASE c_custkey % 4 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' WHEN 2 THEN 'RuPay' ELSE 'Amex' END AS card_network,
          CASE WHEN c_custkey % 11 = 0 THEN 'Blocked' ELSE 'Active' END AS card_status,
          (c_acctbal * 10)::DECIMAL(18,2) AS daily_transaction_limit
        FROM customer"""),
    "merchants": (
        [], f"""
        SELECT s_suppkey AS merchant_id, 'M' || repeat('0', greatest(0, 9 - length(s_suppkey::VARCHAR))) || s_suppkey::VARCHAR AS merchant_code, s_name AS merchant_name,
          CASE WHEN s_suppkey % 2 = 0 THEN 'Retail' ELSE 'Services' END AS merchant_category, n_name AS country,
          {modulo_risk('s_suppkey')} AS risk_level, 'Active' AS merchant_status
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""),
    "devices": (
        ["transactions"], """
        SELECT DISTINCT device_id, 'fp-' || device_id AS device_fingerprint,
          CASE device_id % 5 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Laptop' WHEN 2 THEN 'Desktop' WHEN 3 THEN 'ATM' ELSE 'POS' END AS device_type,
          device_id % 3 <> 0 AS trusted_device
        FROM transactions WHERE device_id IS NOT NULL"""),
    "credit_scores": (
        [], """
        SELECT c_custkey AS credit_score_id, c_custkey AS customer_id,
          CASE WHEN c_custkey % 50 <> 7 THEN CASE c_custkey % 4 WHEN 0 THEN 'CIBIL' WHEN 1 THEN 'Experian' WHEN 2 THEN 'Equifax' ELSE 'CRIF' END END AS bureau_name,
          floor(floor(c_acctbal * 100 + 0.5) / 1500) + 300 AS bureau_score,
          CASE WHEN c_custkey % 40 <> 3 THEN DATE '2024-06-30' END AS score_date
        FROM customer"""),
    "counterparty_rules": (
        [], """
        SELECT s_suppkey AS rule_id, 'SUP' || (s_suppkey % 97) AS rule_code, CASE WHEN s_suppkey % 30 <> 4 THEN s_name END AS rule_name,
          CASE s_suppkey % 5 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' WHEN 3 THEN 'Critical' ELSE 'Severe' END AS severity,
          CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey % 2 = 0 END AS is_active
        FROM supplier"""),
    "orphan_transactions": (
        ["transactions"], """
        SELECT * REPLACE (CASE WHEN transaction_id % 500 = 0 THEN account_id + 1000000000 ELSE account_id END AS account_id)
        FROM transactions"""),
    "enriched": (
        ["transactions", "accounts", "customers", "cards", "merchants", "devices", "customer_kyc"], """
        SELECT t.*, a.customer_id, a.account_type, cu.customer_type, cu.risk_category AS customer_risk,
          k.risk_rating AS kyc_risk, k.pep_flag, k.sanctions_flag, c.card_status,
          m.risk_level AS merchant_risk, m.country AS merchant_country, d.trusted_device
        FROM transactions t
        JOIN accounts a ON a.account_id = t.account_id
        JOIN customers cu ON cu.customer_id = a.customer_id
        LEFT JOIN cards c ON c.card_id = t.card_id
        LEFT JOIN merchants m ON m.merchant_id = t.merchant_id
        LEFT JOIN devices d ON d.device_id = t.device_id
        LEFT JOIN customer_kyc k ON k.customer_id = cu.customer_id"""),
    "scored_transactions": (
        ["enriched"], """
        SELECT *, CASE WHEN risk_score >= 70 THEN 'Critical' WHEN risk_score >= 50 THEN 'High'
                       WHEN risk_score >= 30 THEN 'Medium' ELSE 'Low' END AS risk_level
        FROM (SELECT *, (
            CASE WHEN transaction_amount >= 150000 THEN 25 WHEN transaction_amount >= 100000 THEN 15
                 WHEN transaction_amount >= 50000 THEN 10 ELSE 0 END
          + CASE merchant_risk WHEN 'High' THEN 20 WHEN 'Medium' THEN 10 ELSE 0 END
          + CASE customer_risk WHEN 'High' THEN 20 WHEN 'Medium' THEN 10 ELSE 0 END
          + CASE kyc_risk WHEN 'High' THEN 20 WHEN 'Medium' THEN 10 ELSE 0 END
          + CASE WHEN trusted_device = false THEN 15 ELSE 0 END
          + CASE WHEN card_status = 'Blocked' THEN 25 ELSE 0 END
          + CASE WHEN pep_flag THEN 20 ELSE 0 END
          + CASE WHEN sanctions_flag THEN 40 ELSE 0 END
          + CASE WHEN transaction_status IN ('Failed', 'Reversed') THEN 10 ELSE 0 END
          + CASE WHEN transaction_type IN ('Cash Withdrawal', 'IMPS', 'RTGS') THEN 5 ELSE 0 END)::BIGINT AS risk_score
          FROM enriched)"""),
    "reasoned": (
        ["scored_transactions"], """
        SELECT *, coalesce(nullif(concat_ws('; ',
            CASE WHEN transaction_amount >= 150000 THEN 'Very high transaction amount'
                 WHEN transaction_amount >= 100000 THEN 'High transaction amount'
                 WHEN transaction_amount >= 50000 THEN 'Elevated transaction amount' END,
            CASE merchant_risk WHEN 'High' THEN 'High-risk merchant' WHEN 'Medium' THEN 'Medium-risk merchant' END,
            CASE customer_risk WHEN 'High' THEN 'High-risk customer' WHEN 'Medium' THEN 'Medium-risk customer' END,
            CASE kyc_risk WHEN 'High' THEN 'High KYC risk' WHEN 'Medium' THEN 'Medium KYC risk' END,
            CASE WHEN trusted_device = false THEN 'Untrusted device' END,
            CASE WHEN card_status = 'Blocked' THEN 'Blocked card' END,
            CASE WHEN pep_flag THEN 'PEP flag' END,
            CASE WHEN sanctions_flag THEN 'Sanctions flag' END,
            CASE WHEN transaction_status IN ('Failed', 'Reversed') THEN 'Transaction status: ' || transaction_status END,
            CASE WHEN transaction_type IN ('Cash Withdrawal', 'IMPS', 'RTGS')
                 THEN 'Risk-sensitive transaction type: ' || transaction_type END), ''),
          'Multiple transaction risk indicators') AS reason
        FROM scored_transactions"""),
    "alerts": (
        ["reasoned"], """
        SELECT transaction_id, 'Rule Engine' AS detection_source, least(risk_score / 100.0, 1.0)::DECIMAL(5,4) AS fraud_score,
          risk_level, 'Open' AS alert_status, reason AS investigation_notes
        FROM reasoned WHERE risk_level IN ('Critical', 'High')"""),
    "existing_alerts": (
        ["alerts", "transactions"], """
        SELECT a.* FROM alerts a JOIN transactions t USING (transaction_id)
        WHERE t.transaction_timestamp < TIMESTAMP '1996-01-01'"""),
    "applicants": (
        [], """
        SELECT c_custkey AS applicant_id,
          CASE WHEN c_custkey % 15 = 0 OR c_custkey % 23 = 0 THEN 1 ELSE 0 END::BIGINT AS "SeriousDlqin2yrs",
          (c_custkey * 37 % 120) / 100.0::DOUBLE AS "RevolvingUtilizationOfUnsecuredLines",
          (c_custkey % 95 + 15)::BIGINT AS age,
          CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END::BIGINT AS "NumberOfTime30-59DaysPastDueNotWorse",
          (c_custkey * 53 % 90) / 100.0::DOUBLE AS "DebtRatio",
          CASE WHEN c_custkey % 6 <> 0 THEN round(abs(c_acctbal), 2) END AS "MonthlyIncome",
          (c_custkey % 20)::BIGINT AS "NumberOfOpenCreditLinesAndLoans",
          CASE WHEN c_custkey % 15 = 0 THEN 1 ELSE 0 END::BIGINT AS "NumberOfTimes90DaysLate",
          (c_custkey % 4)::BIGINT AS "NumberRealEstateLoansOrLines",
          CASE WHEN c_custkey % 14 = 0 THEN 1 ELSE 0 END::BIGINT AS "NumberOfTime60-89DaysPastDueNotWorse",
          CASE WHEN c_custkey % 13 <> 0 THEN (c_custkey % 5)::DOUBLE END AS "NumberOfDependents"
        FROM customer"""),
    "credit": (
        ["applicants"], """
        SELECT *, ("HasDelinquency" + "HasSevereDelinquency" + "HighCreditUtilization" + "HighDebtRatio")::BIGINT AS "RiskIndicator"
        FROM (SELECT *,
          CASE WHEN "TotalDelinquencyEvents" > 0 THEN 1 ELSE 0 END::BIGINT AS "HasDelinquency",
          CASE WHEN "NumberOfTimes90DaysLate" > 0 THEN 1 ELSE 0 END::BIGINT AS "HasSevereDelinquency",
          CASE WHEN "RevolvingUtilizationOfUnsecuredLines" > 0.80::DOUBLE THEN 1 ELSE 0 END::BIGINT AS "HighCreditUtilization",
          CASE WHEN "DebtRatio" > 0.50::DOUBLE THEN 1 ELSE 0 END::BIGINT AS "HighDebtRatio",
          "MonthlyIncome" / ("NumberOfDependents" + 1) AS "IncomePerDependent",
          "NumberOfOpenCreditLinesAndLoans" + "NumberRealEstateLoansOrLines" AS "TotalCreditLines",
          CASE WHEN age < 17 OR age > 120 THEN NULL WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35'
               WHEN age <= 50 THEN '36-50' WHEN age <= 65 THEN '51-65' ELSE '66+' END AS "AgeBand"
          FROM (SELECT * REPLACE (
              coalesce("MonthlyIncome", (SELECT quantile_cont("MonthlyIncome", 0.5) FROM applicants)) AS "MonthlyIncome",
              coalesce("NumberOfDependents", 0.0::DOUBLE) AS "NumberOfDependents"),
            "NumberOfTime30-59DaysPastDueNotWorse" + "NumberOfTimes90DaysLate" + "NumberOfTime60-89DaysPastDueNotWorse"
              AS "TotalDelinquencyEvents"
            FROM applicants))"""),
    "fraud": (
        ["applicants"], """
        SELECT *, (CASE WHEN "TotalDelinquencyEvents" >= 2 THEN 1 ELSE 0 END + "HasSevereDelinquency"
                   + "HighCreditUtilization" + "HighDebtRatio")::BIGINT AS "RiskIndicator"
        FROM (SELECT *,
          CASE WHEN "TotalDelinquencyEvents" > 0 THEN 1 ELSE 0 END::BIGINT AS "HasDelinquency",
          CASE WHEN "NumberOfTimes90DaysLate" > 0 THEN 1 ELSE 0 END::BIGINT AS "HasSevereDelinquency",
          CASE WHEN "RevolvingUtilizationOfUnsecuredLines" >= 0.80::DOUBLE THEN 1 ELSE 0 END::BIGINT AS "HighCreditUtilization",
          CASE WHEN "DebtRatio" >= 0.50::DOUBLE THEN 1 ELSE 0 END::BIGINT AS "HighDebtRatio",
          coalesce("MonthlyIncome", 0.0::DOUBLE) / (greatest(coalesce("NumberOfDependents", 0.0::DOUBLE), 0.0::DOUBLE) + 1) AS "IncomePerDependent",
          "NumberOfOpenCreditLinesAndLoans" + "NumberRealEstateLoansOrLines" AS "TotalCreditLines",
          CASE WHEN age < 0 THEN NULL WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35'
               WHEN age <= 50 THEN '36-50' WHEN age <= 65 THEN '51-65' ELSE '66+' END AS "AgeBand"
          FROM (SELECT *, "NumberOfTime30-59DaysPastDueNotWorse" + "NumberOfTimes90DaysLate"
                  + "NumberOfTime60-89DaysPastDueNotWorse" AS "TotalDelinquencyEvents" FROM applicants))"""),
    "applicant_scores": (
        ["credit"], """
        SELECT applicant_id, "SeriousDlqin2yrs" AS label, (applicant_id * 37 % 101) / 100.0::DOUBLE AS probability
        FROM credit"""),
    "aml_transfers": (
        [], """
        WITH place AS (SELECT n_nationkey, n_name, CASE r_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP'
                         WHEN 3 THEN 'INR' ELSE 'JPY' END AS currency FROM nation JOIN region ON n_regionkey = r_regionkey)
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS record_key, l_shipdate AS "timestamp",
          (f.n_nationkey % 10)::VARCHAR AS from_bank, o_custkey::VARCHAR AS from_account, f.n_name AS from_country,
          (t.n_nationkey % 10)::VARCHAR AS to_bank, l_suppkey::VARCHAR AS to_account, t.n_name AS to_country,
          (floor(l_extendedprice * 100 + 0.5)::BIGINT * (100 - floor(l_discount * 100 + 0.5)::BIGINT) + 50) // 100 / 100.0::DOUBLE AS amount_received, t.currency AS receiving_currency,
          (floor(l_extendedprice * 100 + 0.5)::BIGINT * (100 + floor(l_tax * 100 + 0.5)::BIGINT) + 50) // 100 / 100.0::DOUBLE AS amount_paid, f.currency AS payment_currency,
          CASE (l_orderkey + l_linenumber) % 7 """
        + " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(FORMATS)) + """ END AS payment_format,
          (l_orderkey * 7 + l_linenumber) % 500 = 0 AS is_laundering
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN place f ON c_nationkey = f.n_nationkey JOIN place t ON s_nationkey = t.n_nationkey"""),
    "aml": (
        ["aml_transfers"], """
        SELECT *, CASE WHEN amount_difference_abs > amount_received * 0.10::DOUBLE THEN 1 ELSE 0 END::BIGINT AS amount_mismatch_flag,
          CASE WHEN cross_border_transaction = 1 AND currency_conversion = 1 THEN 1 ELSE 0 END::BIGINT AS cross_border_currency_flag
        FROM (SELECT *,
          hour("timestamp")::BIGINT AS transaction_hour, day("timestamp")::BIGINT AS transaction_day,
          month("timestamp")::BIGINT AS transaction_month, (isodow("timestamp") - 1)::BIGINT AS transaction_day_of_week,
          CASE WHEN isodow("timestamp") >= 6 THEN 1 ELSE 0 END::BIGINT AS is_weekend,
          amount_paid - amount_received AS amount_difference, abs(amount_paid - amount_received) AS amount_difference_abs,
          CASE WHEN amount_paid = 0 THEN 0.0::DOUBLE ELSE amount_received / amount_paid END AS amount_ratio,
          ln(1 + greatest(amount_received, 0)) AS log_amount_received, ln(1 + greatest(amount_paid, 0)) AS log_amount_paid,
          (from_country <> to_country)::BIGINT AS cross_border_transaction, (from_country = to_country)::BIGINT AS same_country,
          (payment_currency <> receiving_currency)::BIGINT AS currency_conversion,
          (payment_currency = receiving_currency)::BIGINT AS same_currency,
          (from_bank = to_bank)::BIGINT AS same_bank, (from_account = to_account)::BIGINT AS same_account,
          (amount_received > (SELECT quantile_cont(amount_received, 0.95) FROM aml_transfers))::BIGINT AS high_value_transaction
          FROM aml_transfers)"""),
    "scored": (
        [], """
        SELECT event_id, least((value::DECIMAL(18,2) * 100)::BIGINT // 20, 1000) / 1000.0::DOUBLE AS probability,
          CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END::BIGINT AS label
        FROM events"""),
    "model_scores": (
        [], """
        SELECT label, model, probability FROM (
          SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END::BIGINT AS label,
            least((value::DECIMAL(18,2) * 100)::BIGINT // 20, 1000) / 1000.0::DOUBLE AS p, hour(ts) AS h FROM events),
          LATERAL (SELECT 'logistic_regression' AS model, p AS probability UNION ALL
                   SELECT 'random_forest', round(1 - p, 3) UNION ALL
                   SELECT 'gradient_boosting', round(h / 23.0::DOUBLE, 3))"""),
    "domain_results": (
        [], """
        SELECT customer_id, credit_probability, fraud_probability, aml_probability,
          CASE WHEN credit_probability < 0.18::DOUBLE THEN 'Low Risk' WHEN credit_probability < 0.24::DOUBLE THEN 'Moderate Risk'
               WHEN credit_probability < 0.50::DOUBLE THEN 'High Risk' ELSE 'Very High Risk' END AS credit_segment,
          CASE WHEN fraud_probability < 0.05::DOUBLE THEN 'Low Risk' WHEN fraud_probability < 0.15::DOUBLE THEN 'Moderate Risk'
               WHEN fraud_probability < 0.30::DOUBLE THEN 'High Risk' ELSE 'Very High Risk' END AS fraud_segment,
          CASE WHEN aml_probability >= 0.5::DOUBLE THEN 'HIGH RISK' WHEN aml_probability >= 0.2::DOUBLE THEN 'MEDIUM RISK' ELSE 'LOW RISK' END AS aml_segment,
          CASE WHEN credit_probability >= 0.18::DOUBLE THEN 'REVIEW' ELSE 'LOW_RISK' END AS credit_decision,
          CASE WHEN fraud_probability >= 0.20::DOUBLE THEN 'FRAUD_REVIEW' ELSE 'LOW_RISK' END AS fraud_decision,
          CASE WHEN aml_probability >= 0.5::DOUBLE THEN 'AML_ALERT' WHEN aml_probability >= 0.2::DOUBLE THEN 'REVIEW' ELSE 'LOW_RISK' END AS aml_decision
        FROM (SELECT c_custkey AS customer_id, (c_custkey * 37 % 101) / 100.0::DOUBLE AS credit_probability,
                (c_custkey * 53 % 101) / 100.0::DOUBLE AS fraud_probability, (c_custkey * 71 % 101) / 100.0::DOUBLE AS aml_probability
              FROM customer)"""),
    "assessed": (
        ["domain_results"], """
        SELECT *, alert_status <> 'NO_ALERT' AS alert_triggered FROM (
          SELECT *,
            CASE WHEN overall_risk_score >= 75 THEN 'CRITICAL' WHEN overall_risk_score >= 50 THEN 'HIGH'
                 WHEN overall_risk_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
            CASE WHEN overall_risk_score >= 75 THEN 'CRITICAL_ALERT' WHEN overall_risk_score >= 50 THEN 'HIGH_RISK_ALERT'
                 WHEN fraud_score >= 50 THEN 'FRAUD_ALERT' WHEN aml_score >= 50 THEN 'AML_ALERT'
                 WHEN credit_score >= 50 THEN 'CREDIT_RISK_ALERT' ELSE 'NO_ALERT' END AS alert_status,
            CASE WHEN credit_score >= fraud_score AND credit_score >= aml_score THEN 'credit_risk'
                 WHEN fraud_score >= aml_score THEN 'fraud_risk' ELSE 'aml_risk' END AS top_risk_driver
          FROM (SELECT *, credit_probability * 100 AS credit_score, fraud_probability * 100 AS fraud_score,
                  aml_probability * 100 AS aml_score,
                  round(credit_probability * 100 * 0.35::DOUBLE + fraud_probability * 100 * 0.35::DOUBLE
                        + aml_probability * 100 * 0.30::DOUBLE, 4) AS overall_risk_score FROM domain_results))"""),
    "raw_requests": (
        [], """
        SELECT o_orderkey AS request_id, o_custkey::VARCHAR AS customer_id,
          CASE WHEN o_orderkey % 89 = 0 THEN 'invalid' WHEN o_orderkey % 83 = 0 THEN '-' || ((o_totalprice::DECIMAL(18,2) * 100)::BIGINT // 30 / 100.0::DOUBLE)::VARCHAR
               WHEN o_orderkey % 79 <> 0 THEN ((o_totalprice::DECIMAL(18,2) * 100)::BIGINT // 30 / 100.0::DOUBLE)::VARCHAR END AS transaction_amount,
          ' ' || lower(f.n_name) || ' ' AS country_from,
          CASE WHEN o_orderkey % 73 <> 0 THEN t.n_name END AS country_to,
          CASE WHEN o_orderkey % 71 <> 0 THEN 'usd' END AS currency
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation f ON c_nationkey = f.n_nationkey
        LEFT JOIN supplier ON o_orderkey % (SELECT count(*) FROM supplier) = s_suppkey LEFT JOIN nation t ON s_nationkey = t.n_nationkey"""),
    "requests": (
        ["raw_requests"], """
        SELECT *, coalesce(transaction_amount >= 0, false) AS is_valid FROM (
          SELECT request_id, coalesce(customer_id, 'DEMO-CUSTOMER') AS customer_id,
            CASE WHEN transaction_amount IS NULL THEN 1000.0::DOUBLE ELSE TRY_CAST(transaction_amount AS DOUBLE) END AS transaction_amount,
            coalesce(country_from, 'US') AS country_from, coalesce(country_to, 'US') AS country_to, coalesce(currency, 'USD') AS currency
          FROM raw_requests)"""),
    "events_in": (
        [], "SELECT event_id, user_id AS account_id, ts, value::DECIMAL(18,2) AS amount FROM events"),
    "unbounded": (
        ["applicants"], """
        SELECT applicant_id, "DebtRatio", CASE WHEN "NumberOfDependents" = 0 THEN 'Infinity'::DOUBLE
          ELSE "MonthlyIncome" / "NumberOfDependents" END AS income_share FROM applicants"""),
}


def with_views(names: list[str], query: str) -> str:
    """``query`` preceded by the views it needs, in order of dependence."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered) + "\n" + query
