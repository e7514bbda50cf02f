"""Business constants that results must agree on.

Column lists, thresholds, bands, weights and sentences are policy, not code.
They are stated once, here, and every operator takes them as defaults.
"""

# --- applicants (credit and fraud domains share the same source file) ---------------------
APPLICANT_TARGET = "SeriousDlqin2yrs"
UTILIZATION = "RevolvingUtilizationOfUnsecuredLines"
LATE_30_59 = "NumberOfTime30-59DaysPastDueNotWorse"
LATE_60_89 = "NumberOfTime60-89DaysPastDueNotWorse"
LATE_90 = "NumberOfTimes90DaysLate"
OPEN_LINES = "NumberOfOpenCreditLinesAndLoans"
REAL_ESTATE_LINES = "NumberRealEstateLoansOrLines"
DEPENDENTS = "NumberOfDependents"

APPLICANT_COLUMNS = [
    "SeriousDlqin2yrs",
    "RevolvingUtilizationOfUnsecuredLines",
    "age",
    "NumberOfTime30-59DaysPastDueNotWorse",
    "DebtRatio",
    "MonthlyIncome",
    "NumberOfOpenCreditLinesAndLoans",
    "NumberOfTimes90DaysLate",
    "NumberRealEstateLoansOrLines",
    "NumberOfTime60-89DaysPastDueNotWorse",
    "NumberOfDependents",
]
APPLICANT_ENGINEERED = [
    "TotalDelinquencyEvents",
    "HasDelinquency",
    "HasSevereDelinquency",
    "HighCreditUtilization",
    "HighDebtRatio",
    "IncomePerDependent",
    "TotalCreditLines",
    "AgeBand",
    "RiskIndicator",
]
AGE_MIN = 18
AGE_MAX_QUARANTINE = 100
AGE_MAX_SCORING = 120
QUARANTINE_RULE = "age_range"
HIGH_UTILIZATION = 0.80
HIGH_DEBT_RATIO = 0.50
AGE_LABELS = ["18-25", "26-35", "36-50", "51-65", "66+"]
AGE_UPPER_EDGES = [25, 35, 50, 65]

# --- transfers (anti money laundering) -----------------------------------------------------
AML_COLUMNS = [
    "record_key", "timestamp", "from_bank", "from_account", "from_country",
    "to_bank", "to_account", "to_country", "amount_received", "receiving_currency",
    "amount_paid", "payment_currency", "payment_format", "is_laundering",
]
AML_LEAKAGE = ["predicted_alert", "model_score", "is_dashboard_sample", "timestamp", "payment_format"]
AML_IDENTIFIERS = ["record_key", "from_account", "to_account", "from_bank", "to_bank"]
AML_HIGH_VALUE_QUANTILE = 0.95
AML_MISMATCH_SHARE = 0.10
PAYMENT_FORMATS = ["ACH", "Bitcoin", "Cash", "Cheque", "Credit Card", "Reinvestment", "Wire"]

# --- card transactions ----------------------------------------------------------------------
CARD_FEATURES = ["Time"] + [f"V{i}" for i in range(1, 29)] + ["Amount"]
CARD_TARGET = "Class"

# --- transaction rule engine -----------------------------------------------------------------
AMOUNT_POINTS = [(150000, 25), (100000, 15), (50000, 10)]
RISK_POINTS = [("High", 20), ("Medium", 10)]
UNTRUSTED_DEVICE_POINTS = 15
BLOCKED_CARD_POINTS = 25
PEP_POINTS = 20
SANCTIONS_POINTS = 40
BAD_STATUSES = ["Failed", "Reversed"]
BAD_STATUS_POINTS = 10
SENSITIVE_TYPES = ["Cash Withdrawal", "IMPS", "RTGS"]
SENSITIVE_TYPE_POINTS = 5
RULE_LEVELS = [(70, "Critical"), (50, "High"), (30, "Medium")]
RULE_LEVEL_ELSE = "Low"
ALERT_LEVELS = ["Critical", "High"]
ALERT_SOURCE = "Rule Engine"
ALERT_OPEN = "Open"
AMOUNT_REASONS = [
    (150000, "Very high transaction amount"),
    (100000, "High transaction amount"),
    (50000, "Elevated transaction amount"),
]
REASON_FALLBACK = "Multiple transaction risk indicators"

# --- probability bands: (lower edge, label), highest first --------------------------------
CREDIT_BUSINESS_THRESHOLD = 0.18
CREDIT_BEST_F1_THRESHOLD = 0.24
DEFAULT_THRESHOLD = 0.50
SEGMENTS = ["Low Risk", "Moderate Risk", "High Risk", "Very High Risk"]
CREDIT_BANDS = [(0.50, "Very High Risk"), (0.24, "High Risk"), (0.18, "Moderate Risk")]
CREDIT_EXPLAIN_BANDS = [(0.18, "Very High Risk"), (0.10, "High Risk"), (0.05, "Moderate Risk")]
CREDIT_CATEGORIES = [(0.70, "HIGH"), (0.40, "MEDIUM")]
FRAUD_BANDS = [(0.30, "Very High Risk"), (0.15, "High Risk"), (0.05, "Moderate Risk")]
FRAUD_BUSINESS_THRESHOLD = 0.20
TXN_FRAUD_BANDS = [(0.90, "Critical"), (0.75, "High"), (0.40, "Medium")]
AML_REVIEW_THRESHOLD = 0.20
AML_BUSINESS_THRESHOLD = 0.01
AML_BUSINESS_BANDS = [(0.80, "HIGH_RISK"), (0.30, "MEDIUM_RISK")]
AML_EXPLANATIONS = {
    "HIGH RISK": "Transaction probability exceeds the default AML alert threshold.",
    "MEDIUM RISK": "Transaction does not exceed the AML alert threshold but should receive additional review.",
    "LOW RISK": "Transaction probability is below the AML alert threshold.",
}

# --- threshold search -------------------------------------------------------------------------
FINE_GRID = [i / 100 for i in range(1, 100)]
COARSE_GRID = [i / 100 for i in range(5, 100, 5)]
CREDIT_GRID = [0.50, 0.45, 0.40, 0.35, 0.30, 0.25, 0.20, 0.15, 0.10, 0.05]
RECALL_FLOOR_CREDIT = 0.70
RECALL_FLOOR_FRAUD = 0.50
RECALL_FLOOR_AML = 0.90

# --- integrated risk ---------------------------------------------------------------------------
WEIGHTS = {"credit": 0.35, "fraud": 0.35, "aml": 0.30}
TIERS = [(75, "CRITICAL"), (50, "HIGH"), (25, "MEDIUM")]
TIER_ELSE = "LOW"
OVERALL_ALERTS = [(75, "CRITICAL_ALERT"), (50, "HIGH_RISK_ALERT")]
DOMAIN_ALERT_SCORE = 50
DOMAIN_ALERTS = [("fraud", "FRAUD_ALERT"), ("aml", "AML_ALERT"), ("credit", "CREDIT_RISK_ALERT")]
NO_ALERT = "NO_ALERT"
DRIVER_ORDER = ["credit", "fraud", "aml"]
DOMAIN_TITLES = {"credit": "Credit Risk", "fraud": "Fraud Risk", "aml": "AML Risk"}
HIGH_VALUE_REQUEST = 10000
HIGH_VALUE_FACTOR = 10.0
CROSS_BORDER_FACTOR = 5.0
REVIEW_DECISIONS = ["HIGH_RISK", "REVIEW"]
SEGMENT_NAMES = {
    "low": "LOW RISK", "low risk": "LOW RISK",
    "medium": "MEDIUM RISK", "medium risk": "MEDIUM RISK",
    "high": "HIGH RISK", "high risk": "HIGH RISK",
    "critical": "CRITICAL RISK", "critical risk": "CRITICAL RISK",
}
REQUEST_DEFAULTS = {
    "customer_id": "DEMO-CUSTOMER", "transaction_amount": 1000.0,
    "country_from": "US", "country_to": "US", "currency": "USD",
}
APPROVED_REASON = "Transaction is LOW risk and requires no review."
REVIEW_REASON = "Transaction requires risk review."

# aliases under which a domain may deliver its fields, first non-null wins
PROBABILITY_ALIASES = {
    "credit": ["credit_risk_probability", "default_probability", "probability", "risk_probability", "pd"],
    "fraud": ["fraud_probability", "fraud_score", "probability", "risk_probability"],
    "aml": ["aml_probability", "probability", "risk_probability"],
}
SCORE_ALIASES = {
    "credit": ["credit_risk_score", "risk_score", "score"],
    "fraud": ["fraud_risk_score", "risk_score", "score"],
    "aml": ["aml_risk_score", "risk_score", "score"],
}
SEGMENT_ALIASES = {
    "credit": ["risk_segment", "credit_risk_segment", "risk_level"],
    "fraud": ["risk_segment", "fraud_risk_segment", "risk_level"],
    "aml": ["risk_segment", "aml_risk_segment", "risk_level"],
}
DECISION_ALIASES = {
    "credit": ["credit_risk_decision", "decision", "prediction"],
    "fraud": ["fraud_decision", "decision", "prediction"],
    "aml": ["aml_decision", "decision", "prediction"],
}
ALERT_ALIASES = ["alert_status", "alert"]
NO_ALERT = "NO_ALERT"
IMPORTANCE_COLUMNS = ["importance", "coefficient", "feature_importance"]
FEATURE_COLUMNS = ["feature", "feature_name", "name"]

# --- model selection: metric priority per domain, all descending ---------------------------
SELECTION_ORDER = {
    "credit": ["pr_auc"],
    "fraud": ["pr_auc", "roc_auc", "f1_score"],
    "transaction_fraud": ["pr_auc", "recall", "f1_score"],
    "aml": ["f1_score"],
}

# --- seed data ------------------------------------------------------------------------------------
SEED_CITIES = [
    ("Bhopal", "Madhya Pradesh", "Central"),
    ("Indore", "Madhya Pradesh", "Central"),
    ("Mumbai", "Maharashtra", "West"),
    ("New Delhi", "Delhi", "North"),
    ("Bengaluru", "Karnataka", "South"),
]

# names under which a threshold may be stored in nested metadata; "-", "_" and " " are equal
BEST_F1_NAMES = ["best_f1_threshold", "best_f1", "optimal_threshold", "f1_threshold"]
BUSINESS_NAMES = ["business_threshold", "business_oriented_threshold", "recall_threshold"]
