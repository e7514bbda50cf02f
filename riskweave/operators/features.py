"""Feature engineering for applicants and transfers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import fixed_values as V
from riskweave.functions.bands import age_band
from riskweave.functions.conditions import differs, finite_or_null, flag, is_missing, safe_divide, same
from riskweave.operators import quality
from riskweave.operators.lineage import materialise
from riskweave.operators.preprocess import category_counts
from riskweave.operators.quantiles import quantile_value


def credit_features(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Credit view of the applicants.

    Missing income takes the exact median of ``fit_on`` (default: of the data itself).
    """
    median = quantile_value(df if fit_on is None else fit_on, "MonthlyIncome", 0.5)
    filled = quality.nan_to_null(quality.drop_identifiers(df)).withColumns({
        "MonthlyIncome": F.coalesce(F.col("MonthlyIncome"), median),
        V.DEPENDENTS: F.coalesce(F.col(V.DEPENDENTS), F.lit(0.0)),
    })
    counted = filled.withColumn(
        "TotalDelinquencyEvents", F.col(V.LATE_30_59) + F.col(V.LATE_90) + F.col(V.LATE_60_89))
    flagged = counted.withColumns({
        "HasDelinquency": flag(F.col("TotalDelinquencyEvents") > 0),
        "HasSevereDelinquency": flag(F.col(V.LATE_90) > 0),
        "HighCreditUtilization": flag(F.col(V.UTILIZATION) > V.HIGH_UTILIZATION),
        "HighDebtRatio": flag(F.col("DebtRatio") > V.HIGH_DEBT_RATIO),
        "IncomePerDependent": F.try_divide(F.col("MonthlyIncome"), F.col(V.DEPENDENTS) + 1),
        "TotalCreditLines": F.col(V.OPEN_LINES) + F.col(V.REAL_ESTATE_LINES),
        "AgeBand": age_band(F.col("age"), 17, 120),
    })
    return flagged.withColumn(
        "RiskIndicator",
        F.col("HasDelinquency") + F.col("HasSevereDelinquency") + F.col("HighCreditUtilization") + F.col("HighDebtRatio"),
    )


def fraud_features(df: DataFrame) -> DataFrame:
    """Fraud view of the applicants: missing counts are zero and edges are inclusive."""

    def counted(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    dependents = F.greatest(F.coalesce(F.col(V.DEPENDENTS), F.lit(0.0)), F.lit(0.0))
    counts = quality.nan_to_null(quality.drop_identifiers(df)).withColumn(
        "TotalDelinquencyEvents", counted(V.LATE_30_59) + counted(V.LATE_60_89) + counted(V.LATE_90))
    flagged = counts.withColumns({
        "HasDelinquency": flag(F.col("TotalDelinquencyEvents") > 0),
        "HasSevereDelinquency": flag(F.col(V.LATE_90) > 0),
        "HighCreditUtilization": flag(F.col(V.UTILIZATION) >= V.HIGH_UTILIZATION),
        "HighDebtRatio": flag(F.col("DebtRatio") >= V.HIGH_DEBT_RATIO),
        "IncomePerDependent": safe_divide(F.coalesce(F.col("MonthlyIncome"), F.lit(0.0)), dependents + 1),
        "TotalCreditLines": counted(V.OPEN_LINES) + counted(V.REAL_ESTATE_LINES),
        "AgeBand": age_band(F.col("age"), 0, None),
    })
    indicator = flag(F.col("TotalDelinquencyEvents") >= 2) + F.col("HasSevereDelinquency") \
        + F.col("HighCreditUtilization") + F.col("HighDebtRatio")
    return quality.infinite_to_null(flagged.withColumn("RiskIndicator", indicator))


def time_features(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Hour, day, month, weekday (Monday is 0) and weekend flag; unreadable text gives null."""
    if isinstance(df.schema[column].dataType, T.StringType):
        df = df.withColumn(column, F.try_to_timestamp(F.col(column)))
    moment = F.col(column)
    return df.withColumns({
        "transaction_hour": F.hour(moment),
        "transaction_day": F.dayofmonth(moment),
        "transaction_month": F.month(moment),
        "transaction_day_of_week": F.weekday(moment),
        "is_weekend": flag(F.weekday(moment) >= 5),
    })


def amount_features(df: DataFrame) -> DataFrame:
    paid, received = F.col("amount_paid"), F.col("amount_received")
    ratio = F.try_divide(received, paid)
    return df.withColumns({
        "amount_difference": paid - received,
        "amount_difference_abs": F.abs(paid - received),
        "amount_ratio": F.coalesce(finite_or_null(ratio), F.lit(0.0)),
        "log_amount_received": F.log1p(F.when(received.isNotNull(), F.greatest(received, F.lit(0.0)))),
        "log_amount_paid": F.log1p(F.when(paid.isNotNull(), F.greatest(paid, F.lit(0.0)))),
    })


def relation_flags(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns({
        "cross_border_transaction": flag(differs(c("from_country"), c("to_country"))),
        "same_country": flag(same(c("from_country"), c("to_country"))),
        "currency_conversion": flag(differs(c("payment_currency"), c("receiving_currency"))),
        "same_currency": flag(same(c("payment_currency"), c("receiving_currency"))),
        "same_bank": flag(same(c("from_bank"), c("to_bank"))),
        "same_account": flag(same(c("from_account"), c("to_account"))),
    })


def high_value_flag(df: DataFrame, fit_on: DataFrame | None = None, quantile: float = V.AML_HIGH_VALUE_QUANTILE) -> DataFrame:
    """Received amount above an exact quantile of ``fit_on`` (default: of the data itself)."""
    amounts = materialise((df if fit_on is None else fit_on).select("amount_received"))  # read by every narrowing pass
    limit = quantile_value(amounts, "amount_received", quantile)
    return df.withColumn("high_value_transaction", flag(F.col("amount_received") > limit))


def mismatch_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "amount_mismatch_flag": flag(F.col("amount_difference_abs") > F.col("amount_received") * V.AML_MISMATCH_SHARE),
        "cross_border_currency_flag": flag((F.col("cross_border_transaction") == 1) & (F.col("currency_conversion") == 1)),
    })


#: More payment formats than that are no category.
MOST_FORMATS = 1000


def observed_formats(df: DataFrame, most: int = MOST_FORMATS) -> list[str]:
    """Payment formats of the data, sorted; refuses a column of more than ``most``, which is no category."""
    return sorted(value for value, _ in category_counts(df, ["payment_format"], most)["payment_format"] if value is not None)


def payment_onehot(df: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """One column per payment format of the data, or per given format as at scoring time."""
    names = observed_formats(df) if formats is None else sorted(formats)
    return df.withColumns({f"payment_format_{name}": flag(F.col("payment_format") == name) for name in names})


def aml_features(
    df: DataFrame, fit_on: DataFrame | None = None, formats: list[str] | None = None, strict: bool = False,
    high_value_limit: float | None = None,
) -> DataFrame:
    """The whole transfer feature set, cleaned of leakage, without missing or infinite numbers.

    ``strict`` makes any value that is still missing an error. Scoring passes the formats and the
    high-value limit of the training data.
    """
    df = quality.nan_to_null(df)
    # what both fits read is computed once
    fitted = materialise(df.select("amount_received", "payment_format")) if formats is None or high_value_limit is None and fit_on is None else None
    if formats is None:
        formats = observed_formats(fitted)
    if high_value_limit is None:
        limit = quantile_value(fitted if fit_on is None else materialise(fit_on.select("amount_received")), "amount_received", V.AML_HIGH_VALUE_QUANTILE)
    else:
        limit = F.lit(high_value_limit)
    marked = df.withColumn("high_value_transaction", flag(F.col("amount_received") > limit))
    built = (
        marked.transform(time_features)
        .transform(amount_features)
        .transform(relation_flags)
        .transform(mismatch_flags)
        .transform(payment_onehot, formats)
        .withColumn("is_laundering", flag(F.col("is_laundering").cast("int") == 1))
        .transform(quality.drop_leakage)
        .transform(quality.fill_numeric)
    )
    # numbers were filled; with checks of them all, a row wouldn't fit a method the JVM compiles
    return quality.numeric_gate(built, [c for c in built.columns if c not in quality.numeric_columns(built)]) if strict else built


def feature_summary(df: DataFrame, target: str = V.APPLICANT_TARGET) -> DataFrame:
    """Counts per age band (missing included), risk indicator and target value, and missing values per column that has
    any, in one pass."""
    def item(feature: str, value: Column) -> Column:
        return F.struct(F.lit(feature).alias("feature"), value.alias("value"))

    items = [item("AgeBand", F.coalesce(F.col("AgeBand"), F.lit("(missing)"))),
             item("RiskIndicator", F.col("RiskIndicator").cast("string")), item(target, F.col(target).cast("string"))]
    items += [F.when(is_missing(F.col(f"`{f.name}`"), f.dataType), item("missing_values", F.lit(f.name))) for f in df.schema.fields]
    return (
        df.select(F.explode(F.array_compact(F.array(*items))).alias("item"))
        .groupBy("item.feature", "item.value")
        .agg(F.count("*").alias("count"))
    )
