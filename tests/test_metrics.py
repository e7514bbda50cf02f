import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskweave.operators import metrics


def frame(spark, pairs):
    return spark.createDataFrame([(int(y), float(p)) for y, p in pairs], "label int, probability double")


def brute_auc(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total, result, tp, fp = sum(y for y, _ in pairs), 0.0, 0, 0
    for score in sorted({p for _, p in pairs}, reverse=True):
        hits = sum(y for y, p in pairs if p == score)
        tp, fp = tp + hits, fp + sum(1 - y for y, p in pairs if p == score)
        result += hits / total * tp / (tp + fp)
    return result


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 1e-14, 1e-9, 0.2, 0.5, 0.50000001, 0.9999999, 1.0])), min_size=2, max_size=40))
def test_rank_metrics_match_brute_force(spark, pairs):
    row = metrics.rank_metrics(frame(spark, pairs)).first()
    if len({y for y, _ in pairs}) < 2:
        assert row["roc_auc"] is None and row["pr_auc"] is None
    else:
        assert row["roc_auc"] == pytest.approx(brute_auc(pairs))
        assert row["pr_auc"] == pytest.approx(brute_ap(pairs))


def test_rank_metrics_with_a_hot_score(spark):
    """A third of the rows share one score."""
    rng = random.Random(5)
    pairs = [(rng.random() < 0.1, 0.001) for _ in range(300)] + [(rng.random() < 0.4, rng.random()) for _ in range(600)]
    pairs = [(int(y), p) for y, p in pairs]
    row = metrics.rank_metrics(frame(spark, pairs)).first()
    assert row["roc_auc"] == pytest.approx(brute_auc(pairs))
    assert row["pr_auc"] == pytest.approx(brute_ap(pairs))


def test_perfect_and_inverted_ranking(spark):
    pairs = [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)]
    assert metrics.rank_metrics(frame(spark, pairs)).first()["roc_auc"] == 1.0
    assert metrics.rank_metrics(frame(spark, [(1 - y, p) for y, p in pairs])).first()["roc_auc"] == 0.0


def test_groups_are_evaluated_separately(spark):
    df = frame(spark, [(1, 0.9), (0, 0.1)]).withColumn("m", F.lit("a")).unionByName(
        frame(spark, [(0, 0.9), (1, 0.1)]).withColumn("m", F.lit("b")))
    found = {r["m"]: r["roc_auc"] for r in metrics.rank_metrics(df, by=["m"]).collect()}
    assert found == {"a": 1.0, "b": 0.0}


def test_sweep_equals_one_threshold_at_a_time(spark):
    rng = random.Random(1)
    df = frame(spark, [(rng.random() < 0.3, round(rng.random(), 2)) for _ in range(400)]).cache()
    grid = [0.05, 0.29, 0.5, 0.57]
    for row in metrics.threshold_sweep(df, grid).collect():
        single = metrics.confusion_at(df, row["threshold"]).first()
        assert {k: row[k] for k in single.asDict()} == single.asDict()


def test_no_predicted_positive_gives_zero_precision(spark):
    row = metrics.confusion_at(frame(spark, [(1, 0.1), (0, 0.2)]), 0.9).first()
    assert (row["precision"], row["recall"], row["f1_score"]) == (0.0, 0.0, 0.0)


def test_sweep_of_nothing(spark):
    rows = metrics.threshold_sweep(frame(spark, []), [0.5]).collect()
    assert [(r["tn"], r["fp"], r["fn"], r["tp"], r["accuracy"]) for r in rows] == [(0, 0, 0, 0, 0.0)]


def sweep_rows(spark, rows):
    return spark.createDataFrame(rows, "threshold double, precision double, recall double, f1_score double")


def test_threshold_choices(spark):
    rows = sweep_rows(spark, [(0.1, 0.2, 0.95, 0.33), (0.2, 0.4, 0.80, 0.53), (0.3, 0.5, 0.60, 0.53), (0.4, 0.9, 0.20, 0.33)])
    assert metrics.best_f1_threshold(rows).first()["threshold"] == 0.2  # equal F1: higher recall
    assert metrics.best_f1_threshold(rows, ("f1_score",)).first()["threshold"] == 0.2  # equal F1: first
    assert metrics.fraud_business_threshold(rows).first()["threshold"] == 0.3
    assert metrics.aml_business_threshold(rows).first()["threshold"] == 0.1
    assert metrics.recall_floor_threshold(rows).first()["threshold"] == 0.2


def test_threshold_fallbacks(spark):
    rows = sweep_rows(spark, [(0.1, 0.2, 0.40, 0.27), (0.2, 0.4, 0.40, 0.40), (0.3, 0.9, 0.10, 0.18)])
    assert metrics.fraud_business_threshold(rows).first()["threshold"] == 0.2
    assert metrics.aml_business_threshold(rows).first()["threshold"] == 0.2
    picked = metrics.recall_floor_threshold(rows).first()
    assert picked["threshold"] == 0.2 and picked["selection_reason"].startswith("No threshold")


def test_ties_go_up_for_credit_and_down_for_others(spark):
    rows = sweep_rows(spark, [(0.1, 0.5, 0.8, 0.6), (0.2, 0.5, 0.8, 0.6)])
    assert metrics.recall_floor_threshold(rows).first()["threshold"] == 0.1
    assert metrics.recall_floor_threshold(rows, ties="high").first()["threshold"] == 0.2
