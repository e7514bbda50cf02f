"""Every operator as a named query over a folder of input tables.

Each entry is ``f(spark, folder) -> DataFrame`` over the views of that folder. ``plain`` only
fixes the output types: integers as long, decimals as double, dates as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import fixed_values as V
from riskweave.functions import bands, normalise, privacy
from riskweave.operators import (
    aml_rules, explain, features, integrated, joins, lineage, metrics, preprocess, quality, reports, rules, seeds, training,
)
from riskweave.operators.stages import ColumnEncoder
from riskweave.plans import domains, inference
from riskweave.session import ensure_checkpoint_dir
from riskweave.sources import files, schemas, sinks
from riskweave.sources.views import Views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NUMERIC_FEATURES = [V.UTILIZATION, "age", "DebtRatio", "MonthlyIncome", V.DEPENDENTS, "IncomePerDependent"]
STRATEGIES = {"default": 0.50, "best_f1": 0.24, "business": 0.18}


def plain(df: DataFrame, digits: int | None = None) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            value = value.cast("double")
            if digits is not None:
                value = F.round(value, digits)
        elif isinstance(f.dataType, T.NumericType):
            value = value.cast("long")
        elif isinstance(f.dataType, T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            value = F.concat_ws(" | ", value)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def query(name: str, digits: int | None = None):
    def register(build: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain(build(Views(spark, folder)), digits)
        return build
    return register


# --- sources and sinks ---------------------------------------------------------------------------
@query("source_fingerprint")
def _(v):
    parts = {"customer": ["c_custkey", "c_name", "c_mktsegment"], "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
             "documents": ["doc_id", "lang", "source", "text"]}
    return reduce(DataFrame.unionByName, [
        files.fingerprint(v.table(name), columns).withColumn("source_table", F.lit(name)) for name, columns in parts.items()])


@query("alert_append_idempotent")
def _(v):
    return rules.new_alerts(v.alerts, v.existing_alerts)


@query("seed_customers")
def _(v):
    return v.customers


@query("seed_addresses")
def _(v):
    return seeds.addresses_for(v.customers)


@query("seed_kyc")
def _(v):
    return seeds.kyc_for(v.customers, v.as_of)


@query("seed_accounts")
def _(v):
    return seeds.accounts_for(v.customers, v.branches, v.as_of)


@query("insert_ignore_conflicts")
def _(v):
    offered = seeds.kyc_for(v.customers, v.as_of).select("customer_id", "pan_number", "risk_rating")
    existing = v.customer_kyc.select("customer_id", "pan_number")
    return sinks.insert_ignoring_conflicts(offered, existing, ["customer_id", "pan_number"], "customer_id")


# --- validation and profiling ------------------------------------------------------------------------
@query("dq_credit_rules")
def _(v):
    return quality.credit_quality_report(v.applicants.drop("applicant_id"))


@query("profile_columns", digits=4)
def _(v):
    return quality.profile_columns(v.applicants)


@query("profile_numeric", digits=6)
def _(v):
    return quality.profile_numeric(v.applicants).drop("dtype")


@query("quarantine_split")
def _(v):
    return quality.quarantine_split(v.applicants)[1].select(
        "applicant_id", "age", "quarantine_rule", "quarantine_reason", "source_file")


@query("quarantine_clean")
def _(v):
    return quality.quarantine_split(v.applicants)[0].select("applicant_id", "age")


@query("quarantine_audit")
def _(v):
    return quality.quarantine_audit(v.applicants)


@query("missing_values", digits=6)
def _(v):
    return quality.missing_values(v.applicants)


def _unbounded(v):
    income, dependents = F.col("MonthlyIncome"), F.col(V.DEPENDENTS)
    share = F.when(dependents == 0, F.lit(float("inf"))).otherwise(F.try_divide(income, dependents))
    return v.applicants.select("applicant_id", "DebtRatio", share.alias("income_share"))


@query("infinite_values")
def _(v):
    return quality.infinite_values(_unbounded(v))


@query("infinite_to_null", digits=6)
def _(v):
    return quality.infinite_to_null(_unbounded(v))


@query("dedup_rows")
def _(v):
    return quality.deduplicate(v.table("events").select("user_id", "event_type"))


@query("duplicate_count")
def _(v):
    return quality.duplicate_count(v.table("events").select("user_id", "event_type"))


@query("target_check")
def _(v):
    return quality.target_check(v.aml_transfers, "is_laundering")


@query("target_distribution", digits=4)
def _(v):
    return quality.target_distribution(v.aml_transfers, "is_laundering")


@query("sanity_checks")
def _(v):
    return quality.sanity_checks(v.applicants)


@query("describe_amounts", digits=4)
def _(v):
    return quality.describe_amounts(v.aml_transfers, ["amount_received", "amount_paid"])


@query("entity_cardinality")
def _(v):
    return quality.entity_cardinality(v.aml_transfers, [
        "from_bank", "to_bank", "from_account", "to_account", "receiving_currency", "payment_currency"])


@query("value_counts")
def _(v):
    return quality.value_counts(v.aml_transfers, "payment_format")


@query("orphan_checks")
def _(v):
    return quality.orphan_checks(v.orphan_transactions, v.accounts, v.merchants, v.devices, v.alerts)


@query("null_checks")
def _(v):
    return quality.null_checks(v.transactions, [
        "transaction_amount", "transaction_timestamp", "transaction_status", "account_id", "card_id"])


@query("check_constraints")
def _(v):
    tables = {"customers": v.customers, "accounts": v.accounts, "customer_kyc": v.customer_kyc, "cards": v.cards,
              "merchants": v.merchants, "devices": v.devices, "transactions": v.transactions, "fraud_alerts": v.alerts,
              "branches": v.branches, "customer_addresses": seeds.addresses_for(v.customers),
              "credit_scores": v.credit_scores, "aml_rules": v.counterparty_rules}
    result = None
    for name, df in tables.items():
        found = quality.check_constraints(
            df, name, schemas.table_checks(name, df.columns), schemas.table_unique(name, df.columns),
            schemas.table_required(name, df.columns))
        result = found if result is None else result.unionByName(found)
    return result


@query("apply_defaults")
def _(v):
    return quality.apply_defaults(v.accounts, schemas.DEFAULTS["accounts"])


def _gaps(df: DataFrame, table: str, key: str) -> DataFrame:
    """A delivery that leaves out some values of every sixth row."""
    return df.withColumns({c: F.when(F.col(key) % 6 != 0, F.col(c)) for c in schemas.DEFAULTS[table] if c in df.columns})


@query("apply_defaults_tables")
def _(v):
    """Every default of every table: of values left out and of whole columns that a delivery lacks."""
    tables = {"customers": (v.customers, "customer_id"), "branches": (v.branches, "branch_id"), "accounts": (v.accounts, "account_id"),
              "customer_addresses": (seeds.addresses_for(v.customers), "customer_id"), "customer_kyc": (v.customer_kyc, "customer_id"),
              "cards": (v.cards, "card_id"), "merchants": (v.merchants, "merchant_id"), "devices": (v.devices, "device_id"),
              "transactions": (v.transactions, "transaction_id"), "fraud_alerts": (v.alerts, "transaction_id"),
              "aml_rules": (v.counterparty_rules, "rule_id")}
    rows = []
    for name, (df, key) in tables.items():
        filled = quality.apply_defaults(_gaps(df, name, key), schemas.DEFAULTS[name], schemas.table_schema(name))
        rows.append(filled.select(F.lit(name).alias("table_name"), F.col(key).cast("long").alias("row_key"), F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in schemas.DEFAULTS[name]]))))
    return reduce(DataFrame.unionByName, rows)


@query("unexpected_columns")
def _(v):
    """What two deliveries bring beyond their schema."""
    deliveries = {"applicants": v.applicants, "card_transactions": v.card_transactions}
    return reduce(DataFrame.unionByName, [
        quality.unexpected_report(df, schemas.table_schema(name).fieldNames()).withColumn("table_name", F.lit(name))
        for name, df in deliveries.items()])


@query("column_types")
def _(v):
    return quality.column_types(v.aml_transfers)


@query("alignment_report")
def _(v):
    """Raw applicants against engineered ones, which replace and add columns."""
    engineered = features.fraud_features(v.applicants)
    return quality.alignment_report(engineered.drop("DebtRatio"), engineered.drop("AgeBand"))


@query("numeric_gate")
def _(v):
    return quality.numeric_gate(quality.fill_numeric(features.fraud_features(v.applicants).drop("AgeBand"))).select(
        "applicant_id", "MonthlyIncome", V.DEPENDENTS, "RiskIndicator")


@query("validate_applicants")
def _(v):
    checked = quality.validate_applicants(features.credit_features(v.applicants))
    return checked.select("applicant_id", "is_valid", "rejection_reasons")


@query("validate_requests")
def _(v):
    return quality.validate_requests(v.raw_requests)


@query("coerce_numeric")
def _(v):
    return quality.coerce_numeric(v.raw_requests.select("request_id", "transaction_amount"), ["transaction_amount"])


# --- joins -----------------------------------------------------------------------------------------------
@query("txn_enriched")
def _(v):
    return v.enriched.select(
        "transaction_id", "customer_id", "transaction_amount", "transaction_type", "transaction_channel",
        "transaction_status", "card_status", "merchant_risk", "trusted_device", "customer_risk", "kyc_risk",
        "pep_flag", "sanctions_flag")


@query("kyc_backfill")
def _(v):
    return joins.missing_kyc(v.customers, v.customer_kyc, v.as_of)


@query("branch_assign")
def _(v):
    return joins.assign_branch(v.customers, v.branches).select("customer_id", "branch_id")


@query("fact_star")
def _(v):
    facts = joins.star_facts(v.orphan_transactions, v.accounts, v.customers, v.customer_kyc, v.cards, v.merchants,
                             v.devices, v.alerts)
    return facts.select(
        "transaction_id", "account_id", "customer_id", "branch_id", "account_type", "customer_type", "risk_category",
        "kyc_risk", "card_type", "merchant_category", "merchant_country", "device_type", "transaction_amount",
        "fraud_score", "alert_level")


# --- rule engine and bands ------------------------------------------------------------------------------
@query("txn_rule_score")
def _(v):
    return v.enriched.select("transaction_id", rules.rule_score().alias("risk_score"))


@query("txn_rule_level")
def _(v):
    return v.scored_transactions.select("transaction_id", "risk_score", "risk_level")


@query("txn_alert_reason")
def _(v):
    from riskweave.functions.reasons import transaction_reason

    return v.enriched.select("transaction_id", transaction_reason().alias("reason"))


@query("rule_alerts")
def _(v):
    return v.alerts


@query("report_lines")
def _(v):
    """The lines of a report of all alerts and all accounts."""
    return files.document_lines({
        "alerts": (v.alerts.select("transaction_id", "risk_level", "alert_status", "investigation_notes"), ["transaction_id"]),
        "accounts": (v.accounts.select("account_id", "account_status", "currency_code"), ["account_id"])})


@query("alert_summary")
def _(v):
    return rules.alert_summary(v.alerts, v.existing_alerts)


def _p():
    return F.col("probability")


@query("credit_band")
def _(v):
    return v.scored.select(
        "event_id", F.round(_p(), 6).alias("default_probability"), bands.credit_segment(_p()).alias("risk_segment"),
        bands.credit_decision(_p()).alias("credit_decision"),
        bands.prediction_at(_p(), V.CREDIT_BUSINESS_THRESHOLD).alias("default_prediction"))


@query("credit_band_cut")
def _(v):
    return v.scored.select("event_id", bands.credit_segment_closed_right(_p()).alias("risk_segment"))


@query("credit_band_explain")
def _(v):
    return v.scored.select(
        "event_id", bands.credit_explain_segment(_p()).alias("risk_segment"),
        bands.credit_decision(_p(), label="HIGH_RISK").alias("decision"))


@query("credit_category")
def _(v):
    return v.scored.select("event_id", bands.credit_category(_p()).alias("risk_category"))


@query("fraud_band")
def _(v):
    return v.scored.select(
        "event_id", bands.fraud_segment(_p()).alias("risk_segment"), bands.fraud_decision(_p()).alias("fraud_decision"),
        bands.fraud_decision(_p(), label="REVIEW_REQUIRED").alias("evaluation_decision"))


@query("txn_fraud_band")
def _(v):
    return v.scored.select(
        "event_id", bands.transaction_fraud_level(_p()).alias("risk_level"), bands.prediction_at(_p(), 0.45).alias("fraud_prediction"))


@query("aml_band")
def _(v):
    return v.scored.select("event_id", bands.aml_assessment(_p()).alias("a")).select("event_id", "a.*")


@query("aml_business_alert")
def _(v):
    return v.scored.select(
        "event_id", bands.aml_business_risk(_p()).alias("business_risk"), bands.aml_business_alert(_p()).alias("alert_status"),
        (bands.aml_business_alert(_p()) == "AML_ALERT").alias("requires_review"))


@query("threshold_lookup")
def _(v):
    text = _p().cast("string")
    metadata = F.when(F.col("label") == 1, F.concat(
        F.lit('{"model": {"type": "boosting"}, "thresholds": {"Business-Threshold": '), text, F.lit("}}"))) \
        .otherwise(F.concat(F.lit('{"best f1": "'), text, F.lit('"}')))
    return v.scored.select(
        "event_id",
        normalise.threshold_in(metadata, V.BUSINESS_NAMES, V.FRAUD_BUSINESS_THRESHOLD).alias("business_threshold"),
        normalise.threshold_in(metadata, V.BEST_F1_NAMES, V.CREDIT_BEST_F1_THRESHOLD).alias("best_f1_threshold"))


# --- integrated risk ---------------------------------------------------------------------------------------
def _domains(v):
    return integrated.combine_domains(v.delivered("credit"), v.delivered("fraud"), v.delivered("aml"))


def _assessed(v):
    return integrated.integrated_assessment(_domains(v))


@query("first_value", digits=6)
def _(v):
    return _domains(v)


@query("normalize_probability", digits=6)
def _(v):
    given = F.concat(F.col("value").cast("decimal(12,2)").cast("string"), F.when(F.col("event_type") == "click", "%").otherwise(""))
    return v.table("events").select("event_id", normalise.normalize_probability(given).alias("probability"))


@query("normalize_score", digits=6)
def _(v):
    return v.table("events").select("event_id", normalise.normalize_score(F.col("value") / 50).alias("score"))


@query("integrated_score", digits=4)
def _(v):
    return _assessed(v).select("customer_id", "overall_risk_score")


@query("integrated_tier")
def _(v):
    return _assessed(v).select("customer_id", "risk_tier")


@query("integrated_alert")
def _(v):
    return _assessed(v).select("customer_id", "alert_status", "alert_triggered")


@query("top_risk_driver")
def _(v):
    return _assessed(v).select("customer_id", "top_risk_driver")


@query("risk_components", digits=6)
def _(v):
    return integrated.risk_components(_assessed(v))


@query("assess_requests", digits=6)
def _(v):
    valid = quality.validate_requests(v.raw_requests).where("is_valid")
    stored = _assessed(v).withColumn("customer_id", F.col("customer_id").cast("string"))
    return integrated.assess_requests(valid, stored).select(
        "request_id", "customer_id", "transaction_amount", "country_from", "country_to", "currency", "cross_border",
        "high_value", "credit_score", "credit_segment", "fraud_score", "aml_score", "overall_score", "risk_tier",
        "alert_status", "top_risk_driver", "approved", "reason", "saved_engine_score", "saved_engine_risk_tier")


@query("normalize_segment")
def _(v):
    label = F.concat(F.lit(" "), F.lower(F.replace(F.col("aml_segment"), F.lit(" RISK"), F.lit(""))), F.lit(" "))
    return v.domain_results.select(
        "customer_id", normalise.normalize_segment(label).alias("aml_segment"),
        normalise.normalize_segment(F.col("credit_segment")).alias("credit_segment"))


@query("clean_decision")
def _(v):
    text = F.concat(F.lit("{'risk_segment': '"), F.col("credit_segment"), F.lit("', 'credit_decision': '"),
                    F.col("credit_decision"), F.lit("', 'business_threshold': 0.18}"))
    return v.domain_results.select(
        "customer_id", normalise.clean_decision(text).alias("credit_decision"),
        normalise.clean_decision(F.col("fraud_decision")).alias("fraud_decision"))


# --- features -------------------------------------------------------------------------------------------------
@query("credit_features", digits=6)
def _(v):
    return features.credit_features(v.applicants)


@query("fraud_features", digits=6)
def _(v):
    return features.fraud_features(v.applicants)


@query("aml_time_features")
def _(v):
    return features.time_features(v.aml_transfers).select(
        "record_key", "transaction_hour", "transaction_day", "transaction_month", "transaction_day_of_week", "is_weekend")


@query("aml_amount_features", digits=6)
def _(v):
    return features.amount_features(v.aml_transfers).select(
        "record_key", "amount_difference", "amount_difference_abs", "amount_ratio", "log_amount_received", "log_amount_paid")


@query("aml_relation_flags")
def _(v):
    return features.relation_flags(v.aml_transfers).select(
        "record_key", "cross_border_transaction", "same_country", "currency_conversion", "same_currency", "same_bank", "same_account")


@query("aml_high_value")
def _(v):
    return features.high_value_flag(v.aml_transfers).select("record_key", "high_value_transaction")


@query("aml_mismatch_flags")
def _(v):
    flagged = features.mismatch_flags(features.relation_flags(features.amount_features(v.aml_transfers)))
    return flagged.select("record_key", "amount_mismatch_flag", "cross_border_currency_flag")


@query("aml_payment_onehot")
def _(v):
    formats = features.observed_formats(v.aml_transfers)
    return features.payment_onehot(v.aml_transfers, formats).select("record_key", *[f"payment_format_{name}" for name in formats])


@query("aml_features", digits=6)
def _(v):
    return features.aml_features(v.aml_transfers)


@query("feature_summary")
def _(v):
    return features.feature_summary(features.fraud_features(v.applicants))


@query("mask_pii")
def _(v):
    return privacy.mask_personal_data(v.customers.join(v.accounts.select("customer_id", "account_number"), "customer_id"), key="catalog")


@query("model_title")
def _(v):
    return v.model_scores.groupBy("model").agg(F.count("*").alias("scores")).select(
        normalise.model_title(F.col("model")).alias("title"), "scores")


# --- split, impute, scale, encode --------------------------------------------------------------------------------
def _split(v):
    return preprocess.stratified_split(v.applicants, V.APPLICANT_TARGET, "applicant_id")


def _kept_split(v):
    """Several fits read the split's source, so it is computed once."""
    return preprocess.stratified_split(lineage.materialise(v.applicants), V.APPLICANT_TARGET, "applicant_id")


def _fraud_split(v):
    prepared = lineage.materialise(features.fraud_features(v.applicants))
    return preprocess.stratified_split(prepared, V.APPLICANT_TARGET, "applicant_id")


@query("stratified_split")
def _(v):
    return _split(v).select("applicant_id", V.APPLICANT_TARGET, "split")


@query("split_summary")
def _(v):
    return preprocess.split_summary(_split(v), V.APPLICANT_TARGET)


@query("impute_median", digits=6)
def _(v):
    split = _kept_split(v)
    medians = preprocess.column_medians(split.where("split = 'train'"), ["MonthlyIncome", V.DEPENDENTS])
    return preprocess.impute(split, medians).select("applicant_id", "split", "MonthlyIncome", V.DEPENDENTS)


@query("impute_mode")
def _(v):
    accounts = v.accounts.select("account_id", "account_status", "currency_code")
    return preprocess.impute(accounts, preprocess.column_modes(accounts, ["account_status", "currency_code"]))


@query("standard_scale", digits=6)
def _(v):
    split = _kept_split(v)
    fitted = preprocess.fit_columns(split.where("split = 'train'"), ["DebtRatio", V.UTILIZATION, "MonthlyIncome"], [])
    return fitted.transform(split, ["applicant_id", "split"])


@query("onehot_ignore")
def _(v):
    split = _fraud_split(v)
    fitted = preprocess.fit_columns(split.where("split = 'train'"), [], ["AgeBand"])
    return fitted.transform(split, ["applicant_id", "split"])


@query("column_transform", digits=6)
def _(v):
    split = _fraud_split(v)
    fitted = preprocess.fit_columns(split.where("split = 'train'"), NUMERIC_FEATURES, ["AgeBand"])
    return fitted.transform(split, ["applicant_id", "split", V.APPLICANT_TARGET])


@query("encode_stage", digits=5)
def _(v):
    """The encoder as a stage of a pipeline that was fitted, saved and loaded; one row per value of the feature vector."""
    split = _fraud_split(v)
    stages = Pipeline(stages=[ColumnEncoder(numericCols=NUMERIC_FEATURES, categoricalCols=["AgeBand"])])
    path = f"{ensure_checkpoint_dir(v.spark)}/models/{uuid.uuid4().hex}"
    stages.fit(split.where("split = 'train'")).write().save(path)
    encoded = PipelineModel.load(path).transform(split)
    return encoded.select("applicant_id", "split", F.posexplode(vector_to_array("features")).alias("position", "value"))


# --- training ------------------------------------------------------------------------------------------------------
@query("class_weights", digits=9)
def _(v):
    return preprocess.class_weights(v.applicants, V.APPLICANT_TARGET)


DOMAINS: dict[str, Callable[[Views], domains.DomainRun]] = {
    "credit": lambda v: domains.credit_run(v.applicants),
    "fraud": lambda v: domains.fraud_run(v.applicants),
    "transaction_fraud": lambda v: domains.transaction_fraud_run(v.card_transactions, "vec_id"),
    "aml": lambda v: domains.aml_run(v.aml_transfers),
}
_runs: dict[tuple[str, str, str], domains.DomainRun] = {}


def domain_run(v: Views, domain: str) -> domains.DomainRun:
    """The domain trained with all published candidates, once per application and input folder."""
    key = (v.spark.sparkContext.applicationId, v.folder, domain)
    if key not in _runs:
        _runs[key] = DOMAINS[domain](v)
    return _runs[key]


@query("credit_risk_run")
def _(v):
    return domain_run(v, "credit").metrics


@query("fraud_risk_run")
def _(v):
    return domain_run(v, "fraud").metrics


@query("transaction_fraud_run")
def _(v):
    return domain_run(v, "transaction_fraud").metrics


@query("aml_run")
def _(v):
    return domain_run(v, "aml").metrics


@query("batch_score")
def _(v):
    run = domain_run(v, "transaction_fraud")
    return inference.transaction_fraud_inference(
        v.card_transactions, run.preprocessing, run.models[run.best_model], "vec_id", run.threshold)


@query("credit_inference")
def _(v):
    run = domain_run(v, "credit")
    return inference.credit_inference(v.applicants, run.preprocessing, run.models[run.best_model])[0]


@query("rejected_applicants")
def _(v):
    return inference.rejected_applicants(v.applicants)


@query("feature_importance")
def _(v):
    return domain_run(v, "fraud").importance


@query("top_features")
def _(v):
    return training.top_features(domain_run(v, "aml").importance, 10)


@query("explain_features")
def _(v):
    return explain.explain_features(features.fraud_features(v.applicants), domain_run(v, "fraud").importance, "applicant_id")


@query("select_model", digits=9)
def _(v):
    return training.select_model(metrics.compare_models(v.model_scores), "fraud")


# --- metrics -----------------------------------------------------------------------------------------------------------
@query("confusion_at", digits=9)
def _(v):
    return metrics.confusion_at(v.scored, 0.5)


@query("threshold_sweep", digits=9)
def _(v):
    return metrics.threshold_sweep(v.scored, V.FINE_GRID)


@query("threshold_sweep_coarse", digits=9)
def _(v):
    return metrics.threshold_sweep(v.scored, V.COARSE_GRID)


@query("threshold_sweep_credit", digits=9)
def _(v):
    return metrics.threshold_sweep(v.scored, V.CREDIT_GRID)


@query("best_f1_threshold", digits=9)
def _(v):
    return metrics.best_f1_threshold(metrics.threshold_sweep(v.scored))


@query("business_threshold", digits=9)
def _(v):
    return metrics.fraud_business_threshold(metrics.threshold_sweep(v.scored))


@query("aml_business_threshold", digits=9)
def _(v):
    return metrics.aml_business_threshold(metrics.threshold_sweep(v.scored))


@query("recall_floor_threshold", digits=9)
def _(v):
    return metrics.recall_floor_threshold(metrics.threshold_sweep(v.scored, V.CREDIT_GRID), ties="high")


@query("roc_auc", digits=9)
def _(v):
    return metrics.rank_metrics(v.scored).select("positives", "negatives", "roc_auc")


@query("average_precision", digits=9)
def _(v):
    return metrics.rank_metrics(v.scored).select("positives", "negatives", F.col("pr_auc").alias("average_precision"))


@query("threshold_comparison", digits=9)
def _(v):
    return metrics.threshold_comparison(v.scored, STRATEGIES)


@query("model_comparison", digits=9)
def _(v):
    return metrics.compare_models(v.model_scores)


@query("classification_report", digits=9)
def _(v):
    return metrics.classification_report(v.scored, 0.5)


@query("segment_distribution", digits=6)
def _(v):
    return metrics.segment_distribution(v.scored, bands.fraud_segment(_p()))


@query("prediction_table")
def _(v):
    return metrics.prediction_table(
        v.scored, {"0_50": 0.50, "0_24": 0.24, "0_18": 0.18}, bands.credit_segment_closed_right(_p()), keep=["event_id"])


@query("probability_summary", digits=9)
def _(v):
    return metrics.probability_summary(v.scored)


# --- explanations and reports -------------------------------------------------------------------------------------------
def _with_probability(df, key: str):
    return df.withColumn("probability", (F.col(key) * 37 % 101) / F.lit(100.0))


@query("credit_reasons")
def _(v):
    scored = _with_probability(features.credit_features(v.applicants), "applicant_id")
    return explain.explain_credit(scored).select("applicant_id", "reasons")


@query("fraud_reasons")
def _(v):
    scored = _with_probability(features.fraud_features(v.applicants), "applicant_id")
    return explain.explain_fraud(scored).select("applicant_id", "reasons")


@query("aml_reasons")
def _(v):
    return explain.explain_aml(features.aml_features(v.aml_transfers)).select("record_key", "reasons")


def _scored_transfers(v):
    share = F.least((F.col("amount_received") * 100).cast("decimal(18,0)").cast("long"), F.lit(10_000_000)) / F.lit(1e7)
    return v.aml_transfers.select("record_key", share.alias("probability"))


@query("aml_report", digits=8)
def _(v):
    return explain.aml_report(_scored_transfers(v))


@query("aml_alerts", digits=8)
def _(v):
    return explain.aml_alerts(explain.aml_report(_scored_transfers(v)))


AML_FLAGS = ["cross_border_transaction", "currency_conversion", "same_bank", "amount_mismatch_flag", "cross_border_currency_flag"]


def _flag_gaps(v):
    flagged = features.mismatch_flags(features.relation_flags(features.amount_features(v.aml_transfers)))
    return explain.rate_gaps(flagged, "is_laundering", AML_FLAGS)


@query("aml_report_features", digits=6)
def _(v):
    """The features the report names first, from a delivery under other column names."""
    return explain.report_features(_flag_gaps(v).toDF("name", "coefficient"), 3)


@query("rank_importance", digits=9)
def _(v):
    return training.rank_importance(_flag_gaps(v))


APPLICANT_FLAGS = ["HasDelinquency", "HasSevereDelinquency", "HighCreditUtilization", "HighDebtRatio", V.OPEN_LINES, "RiskIndicator"]


@query("explain_applicant_flags", digits=6)
def _(v):
    """Each applicant's own values of the four features whose shares differ most between bad and good ones."""
    rows = lineage.materialise(features.fraud_features(v.applicants))
    gaps = explain.rate_gaps(rows, V.APPLICANT_TARGET, APPLICANT_FLAGS)
    return explain.explain_features(rows, training.rank_importance(gaps.withColumn("feature", F.concat(F.lit("numeric__"), "feature"))),
                                    "applicant_id", 4)


SCORECARD = {"HasDelinquency": 0.75, "HasSevereDelinquency": 1.5, "HighCreditUtilization": 0.5, "HighDebtRatio": 0.25, "RiskIndicator": 0.125}
SCORECARD_BASE = -2.0


@query("scorecard_score", digits=6)
def _(v):
    """Valid applicants scored by given coefficients, with segment and decision."""
    checked = quality.validate_applicants(features.credit_features(v.applicants)).where("is_valid")
    scored = training.score_card(checked, SCORECARD, SCORECARD_BASE, ["applicant_id"])
    return scored.select("applicant_id", F.col("probability").alias("default_probability"),
                         bands.credit_segment(_p()).alias("risk_segment"), bands.credit_decision(_p()).alias("credit_decision"))


@query("aml_dashboard", digits=6)
def _(v):
    return reports.aml_dashboard(v.aml_transfers, "logistic_regression", 0.50, 0.01, 0.01)


@query("executive_summary", digits=6)
def _(v):
    return reports.executive_summary(_assessed(v))


@query("integrated_dashboard", digits=6)
def _(v):
    return reports.integrated_dashboard(_assessed(v))


@query("alert_distribution", digits=6)
def _(v):
    return reports.alert_distribution(_assessed(v))


@query("model_performance_report", digits=9)
def _(v):
    scores = v.applicants.select(F.col(V.APPLICANT_TARGET).alias("label"), F.lit("logistic_regression").alias("model"),
                                 ((F.col("applicant_id") * 37 % 101) / F.lit(100.0)).alias("probability"))
    table = reports.stack_reports({
        "Credit Risk": metrics.compare_models(scores), "Fraud Detection": metrics.compare_models(v.model_scores)})
    return table.withColumn("model", normalise.model_title(F.col("model")))


@query("txn_kpis", digits=6)
def _(v):
    return reports.transaction_kpis(v.transactions)


@query("txn_by_status", digits=6)
def _(v):
    return reports.transactions_by(v.transactions, "transaction_status")


@query("txn_by_channel", digits=6)
def _(v):
    return reports.transactions_by(v.transactions, "transaction_channel")


@query("alert_kpis", digits=6)
def _(v):
    return reports.alert_kpis(v.alerts, v.transactions)


@query("kyc_kpis")
def _(v):
    return reports.kyc_kpis(v.customer_kyc)


@query("risk_mix")
def _(v):
    return reports.risk_mix(v.customers, v.merchants)


@query("txn_trend", digits=4)
def _(v):
    return reports.transaction_trend(v.transactions)


@query("alert_trend", digits=6)
def _(v):
    return reports.alert_trend(v.alerts, v.transactions)


@query("alert_matrix", digits=6)
def _(v):
    return reports.alert_matrix(v.alerts, v.transactions)


@query("channel_risk", digits=6)
def _(v):
    return reports.channel_risk(v.transactions, v.alerts)


@query("vw_transaction_risk")
def _(v):
    return reports.transaction_risk_view(v.scored_transactions)


@query("dim_date")
def _(v):
    return reports.date_dimension(v.transactions, "transaction_timestamp")


# --- event-time rules -------------------------------------------------------------------------------------------------------
def _rule_hits(v, kind):
    hits = aml_rules.evaluate_rules(v.aml_events, v.aml_rules, kind)
    return hits.select("event_id", "account_id", "rule_code", "severity", "window_count", "window_sum")


@query("aml_velocity_rule")
def _(v):
    return _rule_hits(v, "velocity")


@query("aml_structuring_rule")
def _(v):
    return _rule_hits(v, "structuring")


@query("aml_high_value_rule")
def _(v):
    return _rule_hits(v, "high_value")


@query("aml_cross_border_rule")
def _(v):
    hits = aml_rules.evaluate_rules(v.aml_transfers, v.aml_rules, "cross_border", account="from_account", ts="timestamp",
                                    amount="amount_received", country_from="from_country", country_to="to_country")
    return hits.select("record_key", "from_account", "rule_code", "severity", "window_count", "window_sum")
