"""Classification metrics and threshold search.

All metrics come from counts per group of scores. Rows are only ever counted; ordered windows
run over those counts. ``by`` evaluates several models or segments in the same pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave import fixed_values as V
from riskweave.functions.conditions import flag, grid_position, rate

ODDS_BUCKETS_PER_E_FOLD = 1000
ODDS_BUCKET_LIMIT = 1_000_000
SLICES = 4096
METRICS = ["accuracy", "precision", "recall", "f1_score"]


def with_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from tn, fp, fn and tp; 0 where undefined."""
    tn, fp, fn, tp = (F.col(n) for n in ("tn", "fp", "fn", "tp"))
    return counts.withColumns({
        "accuracy": rate(tp + tn, tp + tn + fp + fn),
        "precision": rate(tp, tp + fp),
        "recall": rate(tp, tp + fn),
        "f1_score": rate(tp * 2, tp * 2 + fp + fn),
    })


def known(column: str) -> Column:
    """A label or score that must be there: a row without it raises instead of counting as a negative or vanishing."""
    value = F.col(column)
    return F.when(value.isNull(), F.raise_error(F.lit(f"rows without {column} cannot be evaluated"))).otherwise(value)


def confusion_at(df: DataFrame, threshold: float | Column, label: str = "label", probability: str = "probability",
                 by: list[str] = ()) -> DataFrame:
    """Confusion counts and metrics for predictions at one threshold."""
    positive, predicted = flag(known(label) == 1), flag(known(probability) >= threshold)
    counts = df.groupBy(*by).agg(*[
        F.coalesce(F.sum(cell), F.lit(0)).alias(name)
        for name, cell in (
            ("tn", (1 - positive) * (1 - predicted)), ("fp", (1 - positive) * predicted),
            ("fn", positive * (1 - predicted)), ("tp", positive * predicted),
        )
    ])
    return with_metrics(counts)


def threshold_sweep(df: DataFrame, grid: list[float] = V.FINE_GRID, label: str = "label",
                    probability: str = "probability") -> DataFrame:
    """Metrics for every threshold of a grid from one pass over the scores.

    Each row is counted once, under the number of thresholds it reaches; the confusion
    counts of a threshold are sums over those few counts.
    """
    ascending = sorted(grid)
    positive = flag(known(label) == 1)
    reached = df.groupBy(grid_position(known(probability), ascending).alias("reached")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    collected = reached.agg(F.collect_list(F.struct("reached", "pos", "neg")).alias("cells"))  # len(grid) + 1 entries

    def total(field: str, keep) -> Column:
        return F.aggregate(
            F.filter("cells", keep), F.lit(0).cast("long"), lambda acc, cell: acc + cell[field])

    points = F.array(*[F.struct(F.lit(i + 1).alias("rank"), F.lit(t).alias("threshold")) for i, t in enumerate(ascending)])
    swept = collected.select("cells", F.inline(points)).select(
        "threshold",
        total("neg", lambda cell: cell["reached"] < F.col("rank")).alias("tn"),
        total("neg", lambda cell: cell["reached"] >= F.col("rank")).alias("fp"),
        total("pos", lambda cell: cell["reached"] < F.col("rank")).alias("fn"),
        total("pos", lambda cell: cell["reached"] >= F.col("rank")).alias("tp"),
    )
    return with_metrics(swept).withColumn("predicted_positive", F.col("tp") + F.col("fp"))


def _first(sweep: DataFrame, *order: Column) -> DataFrame:
    return sweep.orderBy(*order).limit(1)


def best_f1_threshold(sweep: DataFrame, order: tuple[str, ...] = ("f1_score", "recall", "precision")) -> DataFrame:
    """Fraud breaks F1 ties by recall and precision; pass ``("f1_score",)`` for laundering."""
    return _first(sweep, *[F.desc(name) for name in order], F.asc("threshold"))


def floor_threshold(sweep: DataFrame, floor: float, prefer: tuple[str, ...], fallback: tuple[str, ...],
                    ties: str = "low") -> DataFrame:
    """Best threshold among those reaching a recall floor, else the best by the fallback order."""
    eligible = F.col("recall") >= floor
    order = [F.desc(F.when(eligible, 1).otherwise(0))]
    order += [F.when(eligible, F.col(name)).desc_nulls_last() for name in prefer]
    order += [F.when(~eligible, F.col(name)).desc_nulls_last() for name in fallback]
    order.append(F.asc("threshold") if ties == "low" else F.desc("threshold"))
    return _first(sweep.withColumn("meets_floor", eligible), *order)


def fraud_business_threshold(sweep: DataFrame, floor: float = V.RECALL_FLOOR_FRAUD) -> DataFrame:
    return floor_threshold(sweep, floor, ("precision", "f1_score"), ("recall", "precision"))


def aml_business_threshold(sweep: DataFrame, floor: float = V.RECALL_FLOOR_AML) -> DataFrame:
    return floor_threshold(sweep, floor, ("precision", "f1_score"), ("f1_score",))


def recall_floor_threshold(sweep: DataFrame, floor: float = V.RECALL_FLOOR_CREDIT, ties: str = "low") -> DataFrame:
    """Highest F1 above the recall floor, with the reason. Credit breaks ties upwards."""
    picked = floor_threshold(sweep, floor, ("f1_score", "precision"), ("recall", "f1_score"), ties)
    return picked.withColumn("selection_reason", F.when(
        F.col("meets_floor"),
        f"Selected highest-F1 threshold among thresholds with recall >= {floor:.2f}.",
    ).otherwise(
        "No threshold satisfied the minimum recall requirement. Selected the threshold with highest recall."
    ))


def _odds_bucket(p: Column) -> Column:
    """Monotone bucket on the log-odds scale: fine near 0 and near 1, where scores crowd."""
    odds = F.try_divide(p, 1 - p)
    inner = F.floor(F.ln(odds) * ODDS_BUCKETS_PER_E_FOLD)
    return F.when(p <= 0, -ODDS_BUCKET_LIMIT).when(p >= 1, ODDS_BUCKET_LIMIT).otherwise(inner)


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` in which missing keys are equal; the left side's keys stay."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_right_{k}"]) for k in keys], F.lit(True))
    return left.join(right, condition).drop(*[f"_right_{k}" for k in keys])


def rank_metrics(df: DataFrame, label: str = "label", probability: str = "probability", by: list[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and average precision, exact, per group; rows without a group are one.

    Scores are first counted, so ties collapse before the shuffle. Cumulative counts are taken on three levels, each a
    window over the totals of the one below: log-odds buckets, linear slices of a bucket, scores of a slice. Both
    metrics are null when one class is missing.
    """
    by = list(by)
    positive = flag(known(label) == 1)
    per_score = df.groupBy(*by, known(probability).cast("double").alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    ).withColumn("bucket", _odds_bucket(F.col("score")))

    def offsets(totals: DataFrame, within: list[str], place: str, level: int) -> DataFrame:
        """What the higher places hold, beside the totals of each place."""
        higher = Window.partitionBy(*within).orderBy(F.desc(place)).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(*within, place, *[c for c in ("low", "high") if c in totals.columns],
                             F.coalesce(F.sum("pos").over(higher), F.lit(0)).alias(f"tp{level}"),
                             F.coalesce(F.sum("neg").over(higher), F.lit(0)).alias(f"fp{level}"))

    sums = [F.sum("pos").alias("pos"), F.sum("neg").alias("neg")]
    buckets = offsets(per_score.groupBy(*by, "bucket").agg(*sums, F.min("score").alias("low"), F.max("score").alias("high")), by, "bucket", 0)
    share = F.try_divide(F.col("score") - F.col("low"), F.col("high") - F.col("low"))
    sliced = same_keys(per_score, buckets, [*by, "bucket"]).withColumn(
        "slice", F.least(F.floor(F.coalesce(share, F.lit(0.0)) * SLICES), F.lit(SLICES - 1)))
    slices = offsets(sliced.groupBy(*by, "bucket", "slice").agg(*sums), [*by, "bucket"], "slice", 1)
    inside = Window.partitionBy(*by, "bucket", "slice").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = same_keys(
        sliced.withColumns({"tp2": F.sum("pos").over(inside), "fp2": F.sum("neg").over(inside)}), slices, [*by, "bucket", "slice"]
    ).select(*by, "pos", "neg", *[
        (F.col(f"{c}0") + F.col(f"{c}1") + F.col(f"{c}2")).cast("double").alias(c) for c in ("tp", "fp")])
    beaten = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    precision_mass = F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))
    sums = ranked.groupBy(*by).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.sum(beaten).alias("_wins"), F.sum(precision_mass).alias("_mass"))
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(
        *by, "positives", "negatives",
        F.when(both, F.try_divide(F.col("_wins"), pairs)).alias("roc_auc"),
        F.when(both, F.try_divide(F.col("_mass"), F.col("positives"))).alias("pr_auc"),
    )


def threshold_comparison(df: DataFrame, strategies: dict[str, float], label: str = "label",
                         probability: str = "probability") -> DataFrame:
    """One row per named threshold with its metrics and the threshold-free ones beside them."""
    grid = sorted(set(strategies.values()))
    sweep = threshold_sweep(df, grid, label, probability)
    named = sweep.select("*", F.inline(F.array(*[
        F.struct(F.lit(name).alias("strategy"), F.lit(value).alias("_value")) for name, value in strategies.items()
    ]))).where(F.col("threshold") == F.col("_value")).drop("_value")
    areas = rank_metrics(df, label, probability).select(F.struct("roc_auc", "pr_auc").alias("areas")).scalar()
    return named.withColumn("_areas", areas).withColumns(
        {"roc_auc": F.col("_areas.roc_auc"), "pr_auc": F.col("_areas.pr_auc")}).drop("_areas")


def classification_report(df: DataFrame, threshold: float, label: str = "label", probability: str = "probability") -> DataFrame:
    """Precision, recall, F1 and support per class with macro and weighted averages."""
    counts = confusion_at(df, threshold, label, probability)
    tn, fp, fn, tp = (F.col(n) for n in ("tn", "fp", "fn", "tp"))

    def per_class(hit, false_hit, missed):
        return [rate(hit, hit + false_hit), rate(hit, hit + missed), rate(hit * 2, hit * 2 + false_hit + missed), hit + missed]

    zero, one = per_class(tn, fn, fp), per_class(tp, fp, fn)
    support = zero[3] + one[3]
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])] + [support]
    weighted = [rate(a * zero[3] + b * one[3], support) for a, b in zip(zero[:3], one[:3])] + [support]
    rows = [("0", zero), ("1", one), ("macro avg", macro), ("weighted avg", weighted)]
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("class"), *[v.alias(n) for n, v in zip(("precision", "recall", "f1_score", "support"), values)])
        for name, values in rows
    ])))


def segment_distribution(df: DataFrame, segment: Column, order: list[str] = V.SEGMENTS) -> DataFrame:
    """Count and share for every segment of the list, absent ones as zero, in list order."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.coalesce(F.sum(flag(segment == name)), F.lit(0)).alias(name) for name in order])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("risk_segment"), F.col(f"`{name}`").alias("count"),
                 (rate(F.col(f"`{name}`"), F.col("_rows")) * 100).alias("percentage"))
        for i, name in enumerate(order)
    ])))


def prediction_table(df: DataFrame, thresholds: dict[str, float], segment: Column, label: str = "label",
                     probability: str = "probability", keep: list[str] = ()) -> DataFrame:
    """Actual class, probability, predictions at several thresholds and the segment, per row."""
    return df.select(
        *keep,
        F.col(label).alias("actual_target"),
        F.col(probability).alias("default_probability"),
        *[flag(F.col(probability) >= t).alias(f"prediction_at_{name}") for name, t in thresholds.items()],
        segment.alias("risk_segment"),
    )


def probability_summary(df: DataFrame, probability: str = "probability") -> DataFrame:
    from riskweave.operators.quantiles import quantile_value

    return df.agg(
        F.min(probability).alias("minimum"), F.max(probability).alias("maximum"), F.avg(probability).alias("mean"),
    ).withColumn("median", quantile_value(df, probability, 0.5))


def compare_models(df: DataFrame, threshold: float = V.DEFAULT_THRESHOLD, model: str = "model",
                   label: str = "label", probability: str = "probability") -> DataFrame:
    """Metric table with one row per model from scores in long form (model, label, probability)."""
    return same_keys(
        confusion_at(df, threshold, label, probability, [model]),
        rank_metrics(df, label, probability, [model]).select(model, "roc_auc", "pr_auc"), [model])


def select_model(metrics: DataFrame, domain: str, model: str = "model") -> DataFrame:
    """Best model by the domain's metric priority; equal metrics go to the first name."""
    order = [F.col(name).desc_nulls_last() for name in V.SELECTION_ORDER[domain]]
    return metrics.orderBy(*order, F.asc(model)).limit(1)
