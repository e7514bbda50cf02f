"""Split, impute, scale and encode."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.conditions import is_missing
from riskweave.operators import quality
from riskweave.operators.quantiles import exact_quantiles
from riskweave.session import side_by_side

UNKNOWN = "(missing)"
#: Columns whose moments are taken in one pass; with more, Spark doesn't compile the aggregation.
MOMENTS_A_PASS = 14
#: So many rows of a class under one hash prefix are ordered without counting longer prefixes first.
FEW_TO_ORDER = 10_000


def stratified_split(df: DataFrame, target: str, key: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` so that ``validation`` holds the exact share of both classes (0 and 1) of ``target``.

    Rows are ranked by a hash of their unique key. No task ever orders a class: hash prefixes of three digits are
    counted, then, as long as many rows are under the prefix that holds the cut, those three digits longer under it, and
    only the rows under the last one are ordered. The counts, at most 4096 per class at a time, and one cut per class
    reach the driver, when called; the result is then a plain projection. A class of two rows or more is on both sides.
    Rows without label or key, or with another label, belong to neither side.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    label = F.col(target).cast("int")
    hashed = df.select(label.alias("class"), F.col(key).alias("key"), digest.alias("digest")).where(
        F.col("class").isin(0, 1) & F.col("key").isNotNull())

    def cut(rows: DataFrame, digits: int, wanted: dict[int, int] | None = None) -> dict[int, tuple[str, int, int]]:
        """Per class the prefix that holds the wanted row, the row's position under it, and the rows under it."""
        counted: dict[int, list[tuple[str, int]]] = {}
        for r in rows.groupBy("class", F.substring("digest", 1, digits).alias("prefix")).agg(F.count("*").alias("n")).collect():
            counted.setdefault(r["class"], []).append((r["prefix"], r["n"]))
        found = {}
        for c, prefixes in counted.items():
            left = wanted[c] if wanted else share_of_class(sum(n for _, n in prefixes))
            for prefix, n in sorted(prefixes):
                if 0 < left <= n:
                    found[c] = prefix, left, n
                left -= n
        return found

    def share_of_class(total: int) -> int:
        return min(max(int(Decimal(str(total * share)).quantize(Decimal(1), ROUND_HALF_UP)), 1), total - 1)

    def under(cuts: dict[int, tuple[str, int, int]]) -> DataFrame:
        return hashed.where(reduce(lambda a, b: a | b, [
            (F.col("class") == c) & F.col("digest").startswith(prefix) for c, (prefix, _, _) in cuts.items()]))

    def position(cuts: dict[int, tuple[str, int, int]]) -> Column:
        return reduce(lambda a, c: F.when(F.col("class") == c, cuts[c][1]).otherwise(a), cuts, F.lit(None).cast("long"))

    in_validation = F.lit(False)
    digits = 3
    if cuts := cut(hashed, digits):
        while max(n for _, _, n in cuts.values()) > FEW_TO_ORDER and digits < 30:
            digits += 3
            cuts = cut(under(cuts), digits, {c: place for c, (_, place, _) in cuts.items()})
        ordered = Window.partitionBy("class").orderBy("digest", "key")
        edges = under(cuts).withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") == position(cuts))
        for edge in edges.select("class", "digest", "key").collect():
            before = (digest < edge["digest"]) | ((digest == edge["digest"]) & (F.col(key) <= F.lit(edge["key"])))
            in_validation = in_validation | ((label == edge["class"]) & before)
    known = label.isin(0, 1) & F.col(key).isNotNull()
    return df.withColumn("split", F.when(known, F.when(in_validation, "validation").otherwise("train")))


def split_summary(split: DataFrame, target: str) -> DataFrame:
    positive = F.col(target).cast("int")
    return split.groupBy("split").agg(
        F.count("*").alias("row_count"),
        F.sum(F.when(positive == 1, 1).otherwise(0)).alias("positives"),
        F.sum(F.when(positive == 0, 1).otherwise(0)).alias("negatives"),
    )


def require_positives(df: DataFrame, target: str, minimum: int = 2) -> DataFrame:
    """Raise unless the rare class can be present on both sides of a split."""
    found = df.where(F.col(target).cast("int") == 1).limit(minimum).count()
    if found < minimum:
        raise ValueError(f"Not enough positive rows for a train/validation split: {found} of {minimum}.")
    return df


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights n / (classes * n_class) from one count per class."""
    counts = df.groupBy(F.col(target).cast("int").alias("target")).agg(F.count("*").alias("n"))
    everything = Window.partitionBy()  # one row per class
    weight = F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))
    return counts.select("target", F.col("n").alias("count"), weight.alias("weight"))


def add_class_weights(df: DataFrame, target: str, name: str = "weight") -> DataFrame:
    """Weights are looked up in the per-class counts, which hold one row per class of a checked target."""
    weights = class_weights(df.where(F.col(target).cast("int").isin(0, 1)), target)
    return df.join(
        F.broadcast(weights.select(F.col("target").alias("_class"), F.col("weight").alias(name))),
        F.col(target).cast("int") == F.col("_class"), "left").drop("_class")


def category_counts(df: DataFrame, columns: list[str], most: int | None = None) -> dict[str, list[tuple[str | None, int]]]:
    """Values of categorical columns with their counts, from one distributed count.

    The caller may refuse columns with more than ``most`` values.
    """
    if not columns:
        return {}
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    counts = text.groupBy("column", "value").agg(F.count("*").alias("n"))
    found: dict[str, list[tuple[str | None, int]]] = {c: [] for c in columns}
    for r in (counts if most is None else counts.limit(most * len(columns) + 1)).collect():
        found[r["column"]].append((r["value"], r["n"]))
    for c, values in found.items():
        if most is not None and len(values) > most:
            raise ValueError(f"{c} has more than {most} categories; it is an identifier, not a category.")
    return found


def column_modes(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent value per column, ties to the smallest; counted per value, not gathered."""
    if not columns:
        return {}
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    counts = text.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("order"), "value")).alias("best"))
    found = {r["column"]: r["best"]["value"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


def column_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    if not columns:
        return {}
    return {c: found[0.5] for c, found in exact_quantiles(df, columns, [0.5]).items()}


def impute(df: DataFrame, values: dict[str, object]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: F.when(is_missing(F.col(f"`{c}`"), types[c]), F.lit(v)).otherwise(F.col(f"`{c}`"))
        for c, v in values.items() if v is not None
    })


@dataclass
class FittedColumns:
    """What a column transformer learned from the training rows."""

    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float | None] = field(default_factory=dict)
    modes: dict[str, str | None] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    deviations: dict[str, float] = field(default_factory=dict)
    categories: dict[str, list[str | None]] = field(default_factory=dict)

    def save(self, spark, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark, path: str) -> FittedColumns:
        return cls(**json.loads(spark.read.text(path).first()["value"]))

    @property
    def feature_names(self) -> list[str]:
        """Numeric block first, then one column per category, as the model sees them."""
        encoded = [f"categorical__{c}_{UNKNOWN if v is None else v}" for c in self.categorical for v in self.categories[c]]
        return [f"numeric__{c}" for c in self.numeric] + encoded

    def _numeric(self, column: str):
        value = F.col(f"`{column}`").cast("double")
        if self.medians.get(column) is not None:
            value = F.when(value.isNull() | F.isnan(value), F.lit(self.medians[column])).otherwise(value)
        return (value - F.lit(self.means[column])) / F.lit(self.deviations[column])

    def _categorical(self, column: str, category: str | None):
        value = F.col(f"`{column}`").cast("string")
        if self.modes.get(column) is not None:
            value = F.coalesce(value, F.lit(self.modes[column]))
        hit = value.isNull() if category is None else F.coalesce(value == category, F.lit(False))
        return F.when(hit, 1.0).otherwise(0.0)

    def transform(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Kept columns and the encoded features, one column each; the rest is dropped."""
        quality.require_columns(df, self.numeric + self.categorical)
        return df.select(
            *[F.col(f"`{c}`") for c in keep],
            *[self._numeric(c).alias(f"numeric__{c}") for c in self.numeric],
            *[
                self._categorical(c, v).alias(f"categorical__{c}_{UNKNOWN if v is None else v}")
                for c in self.categorical for v in self.categories[c]
            ],
        )

    def vectors(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Kept columns and one vector of all features; categories are sparse, however many there are."""
        quality.require_columns(df, self.numeric + self.categorical)
        known = {c: [UNKNOWN if v is None else v for v in self.categories[c]] for c in self.categorical if self.categories[c]}
        row = df.select(
            *[F.col(f"`{c}`") for c in keep], *[self._numeric(c).alias(f"_n{i}") for i, c in enumerate(self.numeric)],
            *[self._filled(c).alias(f"_c{i}") for i, c in enumerate(known)])
        inputs = [f"_n{i}" for i in range(len(self.numeric))]
        for i, labels in enumerate(known.values()):
            indexer = StringIndexerModel.from_labels(labels, inputCol=f"_c{i}", outputCol=f"_i{i}", handleInvalid="keep")
            row = indexer.transform(row)
            # the last index, that of unseen values, is dropped: they are zero everywhere
            encoder = OneHotEncoder(inputCol=f"_i{i}", outputCol=f"_v{i}", dropLast=True).fit(row)
            row = encoder.transform(row)
            inputs.append(f"_v{i}")
        assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")
        return assembler.transform(row).select(*[F.col(f"`{c}`") for c in keep], "features")

    def _filled(self, column: str) -> Column:
        value = F.col(f"`{column}`").cast("string")
        if self.modes.get(column) is not None:
            value = F.coalesce(value, F.lit(self.modes[column]))
        return F.coalesce(value, F.lit(UNKNOWN)) if None in self.categories[column] else value


def fit_columns(
    train: DataFrame, numeric: list[str], categorical: list[str], impute_missing: bool = True,
    missing_category: bool = False, most_categories: int | None = None,
) -> FittedColumns:
    """Learn medians, modes, means, population deviations and categories from training rows only.

    ``missing_category`` keeps a missing value as a category of its own instead of imputing it; ``most_categories``
    refuses columns with more values.
    """
    fitted = FittedColumns(list(numeric), list(categorical))

    def learn_numbers() -> None:
        if impute_missing:
            fitted.medians = column_medians(train, fitted.numeric)
        filled = impute(train.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in fitted.numeric]), fitted.medians)
        for at in range(0, len(fitted.numeric), MOMENTS_A_PASS):
            some = fitted.numeric[at:at + MOMENTS_A_PASS]
            moments = filled.agg(
                *[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(some)],
                *[F.stddev_pop(f"`{c}`").alias(f"s{i}") for i, c in enumerate(some)],
            ).first()
            for i, c in enumerate(some):
                fitted.means[c] = moments[f"m{i}"] or 0.0
                fitted.deviations[c] = moments[f"s{i}"] or 1.0

    _, counts = side_by_side(
        train.sparkSession, learn_numbers, lambda: category_counts(train, fitted.categorical, most_categories))
    for c, counted in counts.items():
        known = sorted(value for value, _ in counted if value is not None)
        absent = any(value is None for value, _ in counted)
        if impute_missing and not missing_category and known:
            # most frequent, ties to the smallest
            fitted.modes[c] = min(((-n, value) for value, n in counted if value is not None))[1]
        fitted.categories[c] = known + ([None] if missing_category and absent else [])
    return fitted
