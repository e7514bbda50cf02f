"""Validation, profiling and quarantine."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import fixed_values as V
from riskweave.functions.conditions import flag, is_finite, is_infinite, is_missing, rate
from riskweave.functions.normalise import to_number
from riskweave.operators.lineage import materialise
from riskweave.operators.quantiles import exact_quantiles


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def unexpected_columns(df: DataFrame, expected: list[str]) -> list[str]:
    return [name for name in df.columns if name not in expected]


def _filled(df: DataFrame) -> DataFrame:
    """Per column its number of values that are neither null nor NaN, in one pass."""
    counts = df.agg(*[F.coalesce(F.sum(flag(~is_missing(_c(f.name), f.dataType))), F.lit(0)).alias(f.name) for f in df.schema.fields])
    return _unpivot_structs(counts, {c: {"filled": _c(c)} for c in df.columns}, "column")


def unexpected_report(df: DataFrame, expected: list[str]) -> DataFrame:
    """Columns of a delivery that its schema doesn't know, with the values that would be ignored."""
    extra = unexpected_columns(df, expected)
    if not extra:
        return df.sparkSession.createDataFrame([], "column string, filled long")
    return _filled(df.select(*[_c(c) for c in extra]))


def column_types(df: DataFrame) -> DataFrame:
    """Every column with its kind (numeric, categorical, boolean, other) and number of values."""
    kinds = {**{c: "numeric" for c in numeric_columns(df)}, **{c: "categorical" for c in categorical_columns(df)},
             **{f.name: "boolean" for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)}}
    kind = F.lit("other")
    for name, label in kinds.items():
        kind = F.when(F.col("column") == name, label).otherwise(kind)
    return _filled(df).select("column", kind.alias("kind"), "filled")


def alignment_report(train: DataFrame, validation: DataFrame) -> DataFrame:
    """Every column of either side: its places (from 0), its values there, and whether both sides agree on the place."""
    def side(df: DataFrame, name: str) -> DataFrame:
        place = F.lit(None).cast("int")
        for at, column in enumerate(df.columns):
            place = F.when(F.col("column") == column, at).otherwise(place)
        return _filled(df).select("column", place.alias(f"{name}_position"), F.col("filled").alias(f"{name}_values"))

    both = side(train, "train").join(side(validation, "validation"), "column", "full")
    return both.withColumn("aligned", F.coalesce(F.col("train_position") == F.col("validation_position"), F.lit(False)))


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError("Required columns are missing: " + ", ".join(missing))
    return df


def check_aligned(train: DataFrame, validation: DataFrame) -> None:
    """Both sides must offer the same features in the same order."""
    if train.columns != validation.columns:
        raise ValueError("Training and validation feature columns are not aligned.")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Every distinct row once with its number of copies ``_copies``.

    Copies collapse before the shuffle, so one row repeated a billion times stays cheap.
    """
    return df.groupBy(*[_c(name) for name in df.columns]).agg(F.count("*").alias("_copies"))


def deduplicate(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def deduplicate_keyed(df: DataFrame, key: str) -> DataFrame:
    """Of rows that are equal but for their key, the one with the smallest key."""
    others = [c for c in df.columns if c != key]
    # text can't be compared in a hash table, so the groups are sorted: a hash in front settles most comparisons
    whole = [_c(c) for c in others if c not in floating_columns(df)]
    return df.groupBy(F.xxhash64(*whole).alias("_hash"), *[_c(c) for c in others]).agg(F.min(_c(key)).alias(key)).select(*[_c(c) for c in df.columns])


def row_fingerprint(df: DataFrame) -> list[Column]:
    """Two independent hashes of all columns, 128 bits; equal rows have equal ones, 0.0 and -0.0 are equal."""
    values = []
    for f in df.schema.fields:
        value = _c(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(value == 0, F.lit(0).cast(f.dataType)).otherwise(value)
        # hashes skip nulls, so that their place is hashed too
        values += [F.isnull(value), value]
    return [F.xxhash64(*values), F.xxhash64(F.lit("other"), *reversed(values))]


def duplicate_count(df: DataFrame, fingerprint: Callable[[DataFrame], list[Column]] = row_fingerprint) -> DataFrame:
    """row_count and duplicate_rows, the rows that repeat another one.

    Fingerprints are shuffled and counted instead of whole rows; only rows whose fingerprint comes more than once are
    compared by all their columns, so a collision costs time and never a wrong count.
    """
    names = ["_fp0", "_fp1"]
    marked = df.withColumns(dict(zip(names, fingerprint(df))))
    counted = marked.groupBy(*names).agg(F.count("*").alias("_n"))
    repeated = marked.join(counted.where("_n > 1").select(*names), names, "left_semi").drop(*names)
    extra = distinct_rows(repeated).agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("n"))
    return counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count")).select("row_count", extra.scalar().alias("duplicate_rows"))


def _unpivot_structs(one_row: DataFrame, rows: dict[str, dict[str, Column]], key: str) -> DataFrame:
    """Turn a one-row aggregate into one row per entry of ``rows``."""
    structs = [
        F.struct(F.lit(name).alias(key), *[value.alias(field) for field, value in fields.items()])
        for name, fields in rows.items()
    ]
    return one_row.select(F.inline(F.array(*structs)))


def _rule_report(df: DataFrame, rules: dict[str, Column], bad_status: str, count_name: str) -> DataFrame:
    """One scan, one row per rule with the number of rows for which it is violated."""
    counts = df.agg(*[F.coalesce(F.sum(flag(rule)), F.lit(0)).alias(name) for name, rule in rules.items()])
    return _unpivot_structs(
        counts,
        {
            name: {count_name: _c(name), "status": F.when(_c(name) == 0, F.lit("PASS")).otherwise(F.lit(bad_status))}
            for name in rules
        },
        "rule",
    )


def credit_rules(age_max: int = V.AGE_MAX_QUARANTINE) -> dict[str, tuple[Column, str, Column]]:
    """Row rules: name -> (violated, message when none, message when some)."""

    def negative(name: str) -> Column:
        return _c(name) < 0

    def counted(text: str) -> Column:
        return F.concat(F.col("failed_rows").cast("string"), F.lit(" " + text))

    rules = {
        "target_values": (
            ~F.coalesce(_c(V.APPLICANT_TARGET).isin(0, 1), F.lit(False)),
            "Target contains only 0 and 1.", F.lit("Invalid target values detected.")),
        "age_range": (
            (_c("age") < V.AGE_MIN) | (_c("age") > age_max),
            f"Age values are within {V.AGE_MIN}-{age_max}.", counted("invalid age values detected.")),
        "monthly_income": (
            negative("MonthlyIncome"), "No negative monthly income values.",
            counted("negative income values detected.")),
        "debt_ratio": (negative("DebtRatio"), "No negative debt ratios.", counted("negative debt ratios detected.")),
        "revolving_utilization": (
            negative(V.UTILIZATION), "No negative utilization values.", counted("negative utilization values.")),
    }
    for name in (V.LATE_30_59, V.LATE_90, V.LATE_60_89):
        rules[f"{name}_non_negative"] = (
            negative(name), f"{name} contains no negative values.", counted("negative values detected."))
    rules["number_of_dependents"] = (
        negative(V.DEPENDENTS), "No negative dependent counts.", counted("negative dependent counts."))
    rules["open_credit_lines"] = (
        negative(V.OPEN_LINES), "No negative credit-line counts.", counted("negative credit-line counts."))
    return rules


def credit_quality_report(df: DataFrame, expected: list[str] = V.APPLICANT_COLUMNS) -> DataFrame:
    """Twelve rules with status, failed rows and message; ``overall_status`` FAIL if any fails.

    Row rules are evaluated on distinct rows weighted by their copies: the duplicate rule and
    all others share one scan and one shuffle.
    """
    missing = missing_columns(df, expected)
    rules = credit_rules()
    checked = distinct_rows(df)
    counts = checked.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        *[F.coalesce(F.sum(flag(bad) * F.col("_copies")), F.lit(0)).alias(name) for name, (bad, _, _) in rules.items()],
    ).withColumn("required_columns", F.lit(len(missing)).cast("long"))
    names = ["required_columns", "duplicate_rows", *rules]
    report = _unpivot_structs(counts, {n: {"failed_rows": _c(n)} for n in names}, "rule")

    passed = {"required_columns": "All required columns are present.", "duplicate_rows": "No duplicate rows found."}
    failed = {
        "required_columns": F.lit(f"Missing columns: {missing}"),
        "duplicate_rows": F.concat(F.col("failed_rows").cast("string"), F.lit(" duplicate rows detected.")),
    }
    for name, (_, good, bad) in rules.items():
        passed[name], failed[name] = good, bad
    message = F.lit(None).cast("string")
    for name in names:
        text = F.when(F.col("failed_rows") == 0, F.lit(passed[name])).otherwise(failed[name])
        message = F.when(F.col("rule") == name, text).otherwise(message)
    failures = F.sum(flag(F.col("failed_rows") > 0)).over(Window.partitionBy())  # twelve rows
    return report.select(
        "rule",
        F.when(F.col("failed_rows") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        "failed_rows",
        message.alias("message"),
        F.when(failures == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("overall_status"),
    )


def sanity_checks(df: DataFrame, age_max: int = V.AGE_MAX_SCORING) -> DataFrame:
    """Business plausibility: violations ask for REVIEW instead of failing."""
    rules = {
        "age_range": (_c("age") < V.AGE_MIN) | (_c("age") > age_max),
        "revolving_utilization": _c(V.UTILIZATION) < 0,
        "debt_ratio": _c("DebtRatio") < 0,
        "monthly_income": _c("MonthlyIncome") < 0,
        "number_of_dependents": _c(V.DEPENDENTS) < 0,
    }
    return _rule_report(df, rules, "REVIEW", "invalid_count")


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: type, nulls, share of nulls and distinct values, beside the dataset's size and repeated rows.

    Columns are unpivoted and counted per (column, value) first, so every distinct count is
    distributed and hot values collapse before the shuffle.
    """
    types = dict(df.dtypes)
    text = df.select(*[
        F.when(~is_missing(_c(f.name), f.dataType), _c(f.name).cast("string")).alias(f.name) for f in df.schema.fields
    ])
    per_value = text.unpivot([], df.columns, "column", "value").groupBy("column", "value").agg(F.count("*").alias("n"))
    per_column = per_value.groupBy("column").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count("value").alias("unique_count"),
    )
    type_of = F.create_map(*[F.lit(part) for pair in types.items() for part in pair])
    return per_column.select(
        "column",
        type_of[F.col("column")].alias("dtype"),
        "null_count",
        F.round(rate(F.col("null_count"), F.col("row_count")) * 100, 4).alias("null_percentage"),
        "unique_count",
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        duplicate_count(df).select("duplicate_rows").scalar().alias("duplicate_rows"),
    )


def profile_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per numeric column: missing, distinct, minimum, maximum and mean."""
    columns = columns or numeric_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    numbers = df.select(
        *[F.when(~is_missing(_c(c), types[c]), _c(c).cast("double")).alias(c) for c in columns]
    )
    per_value = (
        numbers.unpivot([], columns, "column", "value").groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    known = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    type_of = F.create_map(*[F.lit(part) for c in columns for part in (c, types[c].simpleString())])
    return per_value.groupBy("column").agg(
        F.sum(F.col("n") - known).alias("missing"),
        F.count("value").alias("unique_values"),
        F.min("value").alias("minimum"),
        F.max("value").alias("maximum"),
        F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum(known)).alias("mean"),
    ).withColumn("dtype", type_of[F.col("column")])


def quarantine_split(
    df: DataFrame, age_max: int = V.AGE_MAX_QUARANTINE, source_file: str = "applicants", quarantined_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): rows with an age out of range leave with rule, reason and origin."""
    bad = F.coalesce((F.col("age") < V.AGE_MIN) | (F.col("age") > age_max), F.lit(False))
    moment = quarantined_at if quarantined_at is not None else F.current_timestamp()
    quarantined = df.where(bad).select(
        "*",
        F.lit(V.QUARANTINE_RULE).alias("quarantine_rule"),
        F.lit(f"Age outside allowed range {V.AGE_MIN}-{age_max}").alias("quarantine_reason"),
        moment.alias("quarantined_at_utc"),
        F.lit(source_file).alias("source_file"),
    )
    return df.where(~bad), quarantined


def quarantine_audit(df: DataFrame, age_max: int = V.AGE_MAX_QUARANTINE, source_file: str = "applicants") -> DataFrame:
    bad = flag((F.col("age") < V.AGE_MIN) | (F.col("age") > age_max))
    return df.agg(
        F.lit(source_file).alias("dataset"),
        F.count("*").alias("source_rows"),
        F.coalesce(F.sum(1 - bad), F.lit(0)).alias("valid_rows"),
        F.coalesce(F.sum(bad), F.lit(0)).alias("quarantined_rows"),
        F.lit(V.QUARANTINE_RULE).alias("quarantine_rule"),
        F.lit(V.AGE_MIN).alias("age_min"),
        F.lit(age_max).alias("age_max"),
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values, most affected first."""
    fields = df.schema.fields
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.coalesce(F.sum(flag(is_missing(_c(f.name), f.dataType))), F.lit(0)).alias(f.name) for f in fields],
    )
    rows = _unpivot_structs(
        counts,
        {f.name: {"missing_count": _c(f.name), "missing_percentage": rate(_c(f.name), F.col("_rows")) * 100} for f in fields},
        "column",
    )
    return rows.where(F.col("missing_count") > 0).orderBy(F.desc("missing_count"), "column")


def infinite_values(df: DataFrame) -> DataFrame:
    columns = floating_columns(df)
    counts = df.agg(*[F.coalesce(F.sum(flag(is_infinite(_c(c)))), F.lit(0)).alias(c) for c in columns])
    rows = _unpivot_structs(counts, {c: {"infinite_count": _c(c)} for c in columns}, "column")
    return rows.where(F.col("infinite_count") > 0)


def infinite_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.when(~is_infinite(_c(c)), _c(c)) for c in floating_columns(df)})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing here; left alone, Spark would order it above every number."""
    return df.withColumns({c: F.when(~F.isnan(_c(c)), _c(c)) for c in floating_columns(df)})


def numeric_gate(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Raise when a missing or infinite value is left after feature engineering; ``columns``: the only ones where it can be."""
    fields = df.schema.fields if columns is None else [df.schema[c] for c in columns]
    bad = reduce(lambda a, b: a | b, [
        is_missing(_c(f.name), f.dataType) | (is_infinite(_c(f.name)) if f.name in floating_columns(df) else F.lit(False))
        for f in fields
    ])
    return df.where(F.when(bad, F.raise_error(F.lit("Missing or infinite values remain after feature engineering.")).isNull())
                    .otherwise(F.lit(True)))


def fill_numeric(df: DataFrame) -> DataFrame:
    """Booleans to integers, missing and infinite numbers to zero."""
    changed = {}
    for f in df.schema.fields:
        value = _c(f.name)
        if isinstance(f.dataType, T.BooleanType):
            changed[f.name] = flag(value)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            changed[f.name] = F.when(is_finite(value), value).otherwise(0.0)
        elif isinstance(f.dataType, T.NumericType):
            changed[f.name] = F.coalesce(value, F.lit(0).cast(f.dataType))
    return df.withColumns(changed)


def target_check(df: DataFrame, target: str) -> DataFrame:
    """Counts of null and out-of-domain targets; booleans count as 0 and 1."""
    value = _c(target).cast("double")
    return df.agg(
        F.lit(target).alias("target"),
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(flag(value.isNull())), F.lit(0)).alias("null_targets"),
        F.coalesce(F.sum(flag(value.isNotNull() & ~value.isin(0.0, 1.0))), F.lit(0)).alias("invalid_targets"),
    ).withColumn("status", F.when((F.col("null_targets") == 0) & (F.col("invalid_targets") == 0), "PASSED").otherwise("FAILED"))


def require_binary_target(df: DataFrame, target: str) -> DataFrame:
    found = target_check(df, target).first()
    if found["null_targets"] or found["invalid_targets"]:
        raise ValueError(
            f"Target {target}: {found['null_targets']} missing and {found['invalid_targets']} values outside 0/1."
        )
    return df


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    counts = df.groupBy(_c(target).cast("int").alias("target")).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # one row per class
    return counts.select("target", "count", F.round(rate(F.col("count"), total) * 100, 4).alias("percentage"))


def describe_amounts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    numbers = materialise(nan_to_null(df.select(*[_c(c).cast("double").alias(c) for c in columns])))
    basics = (
        numbers.unpivot([], columns, "column", "value")
        .groupBy("column")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    quartiles = exact_quantiles(numbers, columns, [0.25, 0.50, 0.75])

    def quartile(p: float) -> Column:
        known = [F.struct(F.lit(c), F.lit(quartiles[c][p]).cast("double")) for c in columns]
        return F.map_from_entries(F.array(*known))[F.col("column")]

    return basics.withColumns({"q25": quartile(0.25), "q50": quartile(0.50), "q75": quartile(0.75)})


def entity_cardinality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per column, distributed over (column, value) pairs."""
    pairs = df.select(*[_c(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "entity", "value")
    return pairs.distinct().groupBy("entity").agg(F.count("value").alias("distinct_count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.groupBy(_c(column).alias("value")).agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "value")
    )


def orphan_checks(transactions, accounts, merchants, devices, alerts) -> DataFrame:
    """Rows per relationship whose foreign key has no parent. Each table is read once; child keys are counted before the join."""
    def keys(df: DataFrame, columns: dict[str, str]) -> DataFrame:
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("relationship"), _c(c).cast("string").alias("_key")) for name, c in columns.items()])))

    child = keys(transactions, {
        "transaction_account": "account_id", "transaction_merchant": "merchant_id", "transaction_device": "device_id"}
    ).unionByName(keys(alerts, {"alert_transaction": "transaction_id"}))
    parent = reduce(DataFrame.unionByName, [
        keys(accounts, {"transaction_account": "account_id"}), keys(merchants, {"transaction_merchant": "merchant_id"}),
        keys(devices, {"transaction_device": "device_id"}), keys(transactions, {"alert_transaction": "transaction_id"})])
    counted = child.where(F.col("_key").isNotNull()).groupBy("relationship", "_key").agg(F.count("*").alias("n"))
    lost = counted.join(parent, ["relationship", "_key"], "left_anti").select("relationship", "n")
    names = ["transaction_account", "transaction_merchant", "transaction_device", "alert_transaction"]
    none = transactions.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("relationship"), F.lit(0).cast("long").alias("n")) for name in names])))
    return lost.unionByName(none).groupBy("relationship").agg(F.sum("n").alias("orphans"))


def null_checks(df: DataFrame, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.coalesce(F.sum(flag(_c(c).isNull())), F.lit(0)).alias(c) for c in columns])
    return _unpivot_structs(counts, {c: {"null_count": _c(c)} for c in columns}, "column")


def check_constraints(df: DataFrame, table: str, checks: dict[str, Column], unique: list[str], required: list[str] = ()) -> DataFrame:
    """Violations per CHECK, NOT NULL and UNIQUE key, in one pass. As in SQL, an unknown check is no violation.

    A unique key is violated by every row beyond the first with the same non-null value.
    """
    none = F.lit(None).cast("string")
    failed = {**checks, **{f"required_{c}": _c(c).isNotNull() for c in required}}
    entries = [F.struct(F.lit(name).alias("constraint_name"), none.alias("value"), flag(~rule).cast("long").alias("n"))
               for name, rule in failed.items()]
    entries += [F.struct(F.lit(f"unique_{k}").alias("constraint_name"), _c(k).cast("string").alias("value"), F.lit(1).cast("long").alias("n"))
                for k in unique]
    names = [*failed, *[f"unique_{k}" for k in unique]]
    # an entry per name, so that tables without rows are reported as well
    base = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("constraint_name"), none.alias("value"), F.lit(0).cast("long").alias("n")) for name in names])))
    found = df.select(F.inline(F.array(*entries))).unionByName(base).groupBy("constraint_name", "value").agg(F.sum("n").alias("n"))
    copies = F.when(F.col("value").isNotNull(), F.col("n") - 1).otherwise(0)
    violations = F.when(F.col("constraint_name").startswith("unique_"), copies).otherwise(F.col("n"))
    return found.groupBy("constraint_name").agg(F.sum(violations).alias("violations")).select(
        F.lit(table).alias("table_name"), "constraint_name", "violations")


def apply_defaults(df: DataFrame, defaults: dict[str, object], schema: T.StructType | None = None) -> DataFrame:
    """Null values become the column's default. With the table's ``schema``, columns that a delivery leaves out are
    added: with their default where they have one, as nulls of their type otherwise."""
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = df.withColumns({
        name: F.coalesce(_c(name), F.lit(value).cast(types[name])) for name, value in defaults.items() if name in types
    })
    absent = [f for f in schema.fields if f.name not in types] if schema else []
    return filled.withColumns({f.name: F.lit(defaults.get(f.name)).cast(f.dataType) for f in absent})


def validate_applicants(df: DataFrame, age_max: int = V.AGE_MAX_SCORING) -> DataFrame:
    """Adds ``rejection_reasons`` and ``is_valid`` for scoring; missing columns raise."""
    require_columns(df, [c for c in V.APPLICANT_COLUMNS if c != V.APPLICANT_TARGET] + V.APPLICANT_ENGINEERED)
    reasons = F.array_compact(F.array(
        F.when((F.col("age") < V.AGE_MIN) | (F.col("age") > age_max),
               F.concat(F.lit("Invalid age: "), F.col("age").cast("string"),
                        F.lit(f". Expected range: {V.AGE_MIN}-{age_max}."))),
        F.when(F.col("MonthlyIncome") < 0, F.lit("MonthlyIncome cannot be negative.")),
        F.when(F.col("DebtRatio") < 0, F.lit("DebtRatio cannot be negative.")),
        F.when(_c(V.UTILIZATION) < 0, F.lit("Revolving utilization cannot be negative.")),
    ))
    return df.withColumn("rejection_reasons", reasons).withColumn("is_valid", F.size("rejection_reasons") == 0)


def validate_requests(raw: DataFrame) -> DataFrame:
    """Typed assessment requests: defaults fill absent fields, bad amounts are marked invalid."""
    given = F.col("transaction_amount")
    amount = F.when(given.isNull(), F.lit(V.REQUEST_DEFAULTS["transaction_amount"])).otherwise(to_number(given))
    filled = {
        name: F.coalesce(F.col(name).cast("string"), F.lit(V.REQUEST_DEFAULTS[name]))
        for name in ("customer_id", "country_from", "country_to", "currency")
    }
    return (
        raw.withColumns({**filled, "transaction_amount": amount})
        .withColumn("is_valid", F.coalesce(F.col("transaction_amount") >= 0, F.lit(False)))
    )


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text to double; anything that is not a number becomes null."""
    return df.withColumns({c: to_number(_c(c)) for c in columns})


def drop_identifiers(df: DataFrame) -> DataFrame:
    return df.drop("Unnamed: 0")


def drop_leakage(df: DataFrame) -> DataFrame:
    return df.drop(*V.AML_LEAKAGE)


def drop_aml_identifiers(df: DataFrame) -> DataFrame:
    return df.drop(*V.AML_IDENTIFIERS)
