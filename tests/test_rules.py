"""The rule engine, its alerts, and the trailing-window rules."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskweave.operators import aml_rules, joins, rules
from riskweave.sources import sinks

COLUMNS = ("transaction_id long, transaction_amount decimal(18,2), merchant_risk string, customer_risk string, kyc_risk string, "
           "trusted_device boolean, card_status string, pep_flag boolean, sanctions_flag boolean, transaction_status string, "
           "transaction_type string")


def score(spark, *rows):
    rows = [(i, Decimal(r[0]), *r[1:]) for i, r in enumerate(rows)]
    return rules.score_transactions(spark.createDataFrame(rows, COLUMNS))


EMPTY = (None, None, None, None, None, None, None)


def test_amount_steps_and_unknown_dimensions(spark):
    scored = score(spark, *[(a, *EMPTY, "Success", "UPI") for a in ("49999.99", "50000", "100000", "150000")])
    assert [r["risk_score"] for r in scored.orderBy("transaction_id").collect()] == [0, 10, 15, 25]


def test_everything_at_once_is_200_and_capped_at_one(spark):
    scored = score(spark, ("150000", "High", "High", "High", False, "Blocked", True, True, "Failed", "IMPS"))
    row = scored.first()
    assert (row["risk_score"], row["risk_level"]) == (200, "Critical")
    alert = rules.rule_alerts(scored).first()
    assert alert["fraud_score"] == Decimal("1.0000")
    assert alert["investigation_notes"] == (
        "Very high transaction amount; High-risk merchant; High-risk customer; High KYC risk; Untrusted device; Blocked card; "
        "PEP flag; Sanctions flag; Transaction status: Failed; Risk-sensitive transaction type: IMPS")


def test_unknown_device_is_not_untrusted(spark):
    known, unknown = score(
        spark, ("1", None, None, None, False, None, None, None, "Success", "UPI"),
        ("1", None, None, None, None, None, None, None, "Success", "UPI")).orderBy("transaction_id").collect()
    assert (known["risk_score"], unknown["risk_score"]) == (15, 0)


def test_alerts_are_appended_once(spark, tmp_path):
    alerts = rules.rule_alerts(score(
        spark, ("150000", "High", "High", None, None, None, None, None, "Success", "UPI"),
        ("150000", "High", "High", "High", None, None, None, None, "Success", "UPI"),
        ("10", None, None, None, None, None, None, None, "Success", "UPI")))
    path = str(tmp_path / "alerts")
    assert sinks.append_alerts(alerts, path) == {"created": 2, "skipped": 0}
    assert sinks.append_alerts(alerts, path) == {"created": 0, "skipped": 2}
    assert spark.read.parquet(path).count() == 2


def test_optional_lookup_keeps_rows_without_a_key(spark):
    facts = spark.createDataFrame([(i, None if i % 3 else i) for i in range(300)], "id long, k long")
    dim = spark.createDataFrame([(i, f"v{i}") for i in range(-5000, 300)], "d long, name string")
    found = joins.optional_lookup(facts, dim, "k", "d", "id").collect()
    assert len(found) == 300
    assert all(r["name"] == (None if r["k"] is None else f"v{r['k']}") for r in found)


def brute_windows(events, minutes, large):
    result = {}
    for key, account, ts, amount in events:
        seen = [a for _, acc, t, a in events if acc == account and ts - dt.timedelta(minutes=minutes) <= t <= ts]
        result[key] = (len(seen), sum(seen), sum(a >= large for a in seen))
    return result


@pytest.mark.parametrize("step", [60_000_000, 10_000, 1])
def test_trailing_window_equals_brute_force_with_a_hot_account(spark, step):
    """One account holds a third of the events; times repeat, crowd in seconds and lie exactly a window apart."""
    rng = random.Random(11)
    start = dt.datetime(2024, 1, 1)
    events = []
    for i in range(240):
        account = 1 if i % 3 == 0 else rng.randrange(2, 12)
        events.append((i, account, start + dt.timedelta(microseconds=step * rng.randrange(0, 300)), Decimal(rng.randrange(1, 20000)) / 100))
    df = spark.createDataFrame(events, "event_id long, account_id long, ts timestamp, amount decimal(18,2)")
    for minutes in (30, 7):
        seen = aml_rules.trailing_windows(df, [7, 30]).where(F.col("window_minutes") == minutes)
        want = brute_windows(events, minutes, Decimal("100"))
        assert {r["event_id"]: (r["window_count"], r["window_sum"]) for r in seen.collect()} == {k: v[:2] for k, v in want.items()}
        rule = aml_rules.AmlRule("S", "High", Decimal("100"), 3, minutes)
        fired = {r["event_id"] for r in aml_rules.evaluate_rules(df, [rule]).collect()}
        assert fired == {k for k, (n, total, large) in want.items() if n >= 3 and total >= 100 and not large}


def test_rules_come_from_their_table_and_inactive_ones_do_not_fire(spark):
    table = spark.createDataFrame(
        [("HV", "High", Decimal("150"), None, None, True), ("VEL", "Low", None, 2, 10, True), ("OFF", "Low", None, 1, 10, False)],
        "rule_code string, severity string, threshold_amount decimal(18,2), threshold_count int, time_window_minutes int, is_active boolean")
    active = aml_rules.active_rules(table)
    assert [(r.rule_code, r.kind) for r in active] == [("HV", "high_value"), ("VEL", "velocity")]
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, 7, t0, 200.0), (2, 7, t0 + dt.timedelta(minutes=10), 1.0), (3, 7, t0 + dt.timedelta(minutes=21), 1.0)],
        "event_id long, account_id long, ts timestamp, amount double")
    hits = aml_rules.evaluate_rules(df, active)
    assert {(r["event_id"], r["rule_code"]) for r in hits.collect()} == {(1, "HV"), (2, "VEL")}


def test_events_without_account_or_time_stay(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, None, t0, 5.0), (2, None, t0, 5.0), (3, 7, None, 5.0), (4, None, None, 5.0), (5, 7, t0, None)]
    df = spark.createDataFrame(rows, "event_id long, account_id long, ts timestamp, amount double")
    seen = {r["event_id"]: r["window_count"] for r in aml_rules.trailing_windows(df, [30]).collect()}
    assert seen == {1: 2, 2: 2, 3: None, 4: None, 5: 1}
    hits = aml_rules.evaluate_rules(df, [aml_rules.AmlRule("V", "Low", threshold_count=2, time_window_minutes=30)])
    assert sorted(r["event_id"] for r in hits.collect()) == [1, 2]


def test_malformed_rules_are_refused(spark):
    for rule in (aml_rules.AmlRule("A", "Low", threshold_count=2), aml_rules.AmlRule("B", "Low"), aml_rules.AmlRule("C", "Low", Decimal(1), None, 5)):
        with pytest.raises(ValueError):
            rule.kind


def test_structuring_needs_only_small_amounts(spark):
    rule = aml_rules.AmlRule("S", "High", Decimal("100"), 3, 60)
    t0 = dt.datetime(2024, 1, 1)
    amounts = {1: [40.0, 40.0, 40.0], 2: [40.0, 40.0, 100.0], 3: [10.0, 10.0, 10.0]}
    rows = [(a * 10 + i, a, t0 + dt.timedelta(minutes=i), v) for a, vs in amounts.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "event_id long, account_id long, ts timestamp, amount double")
    assert [r["event_id"] for r in aml_rules.evaluate_rules(df, [rule]).collect()] == [12]


def test_a_thousand_rules_are_rows_in_a_plan_of_fixed_size(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    events = [(i, rng.choice([1, 1, 2, 3]), start + dt.timedelta(minutes=rng.randrange(400)), Decimal(rng.randrange(0, 30000)) / 100,
               rng.choice(["IN", "DE", None]), rng.choice(["IN", "DE"])) for i in range(60)]
    df = spark.createDataFrame(events, "event_id long, account_id long, ts timestamp, amount decimal(18,2), country_from string, country_to string")
    rules = []
    for n in range(250):
        amount, count, minutes = Decimal(rng.randrange(1, 40000)) / 100, rng.randint(1, 6), rng.choice([5, 30, 90, 400])
        rules += [(f"V{n}", "Low", None, count, minutes, True, None), (f"S{n}", "High", amount, count, minutes, True, None),
                  (f"H{n}", "Low", amount, None, None, True, None), (f"X{n}", "Low", amount if n % 5 else None, None, None, True, "cross_border")]
    table = spark.createDataFrame(rules, aml_rules.RULE_SCHEMA)
    want = set()
    for key, account, ts, value, a, b in events:
        for code, _, amount, count, minutes, _, kind in rules:
            if minutes is not None:
                seen = [v for _, acc, t, v, _, _ in events if acc == account and ts - dt.timedelta(minutes=minutes) <= t <= ts]
                fires = len(seen) >= count and (amount is None or sum(seen) >= amount and max(seen) < amount)
            else:
                fires = (amount is None or value >= amount) and (kind is None or a is not None and a != b)
            if fires:
                want.add((key, code))
    found = aml_rules.evaluate_rules(df, table)
    assert {(r["event_id"], r["rule_code"]) for r in found.collect()} == want

    def size(frame):
        return len(frame._jdf.queryExecution().optimizedPlan().toString().splitlines())

    few = spark.createDataFrame([r for r in rules if int(r[0][1:]) in (0, 1)], aml_rules.RULE_SCHEMA)
    assert size(found) == size(aml_rules.evaluate_rules(df, few))


def test_velocity_takes_two_wide_exchanges(spark):
    df = spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 1), 1.0)], "event_id long, account_id long, ts timestamp, amount double")
    seen = aml_rules.trailing_windows(df, [30]).where("window_count > 0")
    plan = seen._jdf.queryExecution().executedPlan().toString()
    # the range exchange is behind the checkpoint; what is left are the shards' exchange and small tables of two rows a shard
    assert plan.count("Window ") + plan.count("Window [") <= 4 and plan.count("SortMergeJoin") == 0
