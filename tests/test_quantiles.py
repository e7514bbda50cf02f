import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskweave.operators import quantiles
from riskweave.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.25, 0.5, 0.95, 1.0]


def check(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    known = [v for v in values if v is not None and not math.isnan(v)]
    found = exact_quantiles(df, ["v"], PROBABILITIES)["v"]
    for p in PROBABILITIES:
        if known:
            assert found[p] == pytest.approx(float(np.quantile(known, p)), rel=1e-12, abs=1e-300)
        else:
            assert found[p] is None


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e12, 1e12, allow_nan=False), st.just(float("nan"))), max_size=40))
def test_matches_numpy(spark, values):
    check(spark, values)


def test_published_example(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "v double")
    assert exact_quantiles(df, ["v"], [0.95])["v"][0.95] == pytest.approx(9.2)


@pytest.mark.parametrize("slices", [4096, 3])
def test_crowded_range_with_a_hot_value(spark, monkeypatch, slices):
    """A third of all rows share one value, the rest crowd next to it; few slices take many passes."""
    monkeypatch.setattr(quantiles, "SLICES", slices)
    rng = np.random.default_rng(7)
    crowd = (1000.0 + rng.random(1500) * 1e-3).tolist()
    check(spark, [1000.0] * 1000 + crowd + (rng.random(500) * 1e-9).tolist())


def test_several_columns(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=400) * 1e5, rng.exponential(size=400)
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b)], "a double, b double, c double")
    found = exact_quantiles(df, ["a", "b", "c"], [0.25, 0.5])
    assert found["a"][0.25] == pytest.approx(np.quantile(a, 0.25))
    assert found["b"][0.5] == pytest.approx(np.quantile(b, 0.5))
    assert found["c"] == {0.25: None, 0.5: None}


def test_integer_column(spark):
    df = spark.range(1, 102).selectExpr("cast(id as int) as v")
    assert exact_quantiles(df, ["v"], [0.5])["v"][0.5] == 51.0


def test_magnitudes_signs_and_infinities(spark):
    rng = np.random.default_rng(5)
    sizes = (10.0 ** rng.uniform(-308, 308, 3000)).tolist()
    values = sizes + [-v for v in sizes[:1000]] + [0.0, -0.0, 5e-324, 1e-323, 1.7976931348623157e308] * 3
    check(spark, values)
    infinite = spark.createDataFrame([(v,) for v in [*values, math.inf, math.inf, -math.inf]], "v double")
    found = exact_quantiles(infinite, ["v"], [0.0, 0.5, 1.0])["v"]
    assert found[0.0] == -math.inf and found[1.0] == math.inf
    assert found[0.5] == pytest.approx(float(np.quantile([*values, math.inf, math.inf, -math.inf], 0.5, method="midpoint")), rel=1e-9)


def passes(spark, df, columns, probabilities):
    """Result and number of scans of the rows: sketch, count, and what follows."""
    calls = []
    narrow = quantiles._narrow
    try:
        quantiles._narrow = lambda *a: calls.append(1) or narrow(*a)
        return exact_quantiles(df, columns, probabilities), 2 + len(calls)
    finally:
        quantiles._narrow = narrow


def test_two_passes_for_many_columns_with_heavy_ties(spark):
    rng = np.random.default_rng(11)
    columns = {f"c{i}": np.where(rng.random(20000) < 0.4, 7.0, np.round(rng.exponential(10.0 ** i, 20000), 2)) for i in range(8)}
    df = spark.createDataFrame([tuple(map(float, row)) for row in zip(*columns.values())], ", ".join(f"{c} double" for c in columns)).repartition(6)
    found, scans = passes(spark, df, list(columns), [0.25, 0.5, 0.95])
    for c, values in columns.items():
        for p in (0.25, 0.5, 0.95):
            assert found[c][p] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert scans <= 3


def test_ranks_are_proven_by_counts_when_the_sketch_is_wrong(spark, monkeypatch):
    """Bounds beside every wanted rank cost passes, not the result."""
    rng = np.random.default_rng(13)
    values = rng.normal(size=3000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    monkeypatch.setattr(quantiles, "_sketched", lambda df, columns, probabilities: ({"v": 3000}, [quantiles._Range("v", 50.0, 60.0)]))
    for p, found in exact_quantiles(df, ["v"], PROBABILITIES)["v"].items():
        assert found == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_no_columns_and_empty_table(spark):
    assert exact_quantiles(spark.range(3), [], [0.5]) == {}
    assert exact_quantiles(spark.createDataFrame([], "v double"), ["v"], [0.5]) == {"v": {0.5: None}}
