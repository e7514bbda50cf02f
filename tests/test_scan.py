"""Running totals and row numbers over a distributed sort, against plain loops."""

from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskweave.operators import scan


def _rows(n=4000, hot=3):
    """A third of the rows under one key, many keys of one row, null keys and orders, ties."""
    out = []
    for i in range(n):
        key = "hot" if i % hot == 0 else None if i % 17 == 0 else f"k{i % 997}"
        out.append((i, key, None if i % 23 == 0 else (i * 7919) % 500, (i * 31) % 13 - 4))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_rows(), "id long, k string, o long, v long")


def _sort_key(o):
    return (o is not None, o or 0)


def test_positions_number_the_rows_of_each_key(spark, table):
    got = scan.positions(table, ["k"], ["o", "id"], "place", "n").collect()
    groups = defaultdict(list)
    for i, k, o, _ in _rows():
        groups[k].append((_sort_key(o), i))
    want = {i: (p, len(g)) for g in groups.values() for p, (_, i) in enumerate(sorted(g))}
    assert {r["id"]: (r["place"], r["n"]) for r in got} == want


def test_positions_without_keys_number_all_rows(spark, table):
    got = scan.positions(table, [], ["id"], "place").collect()
    assert all(r["place"] == r["id"] for r in got) and len(got) == 4000


def test_running_sums_count_ties_for_each_other(spark, table):
    got = scan.running(table, ["k"], ["o"], {"s": F.col("v"), "n": F.lit(1)}, {"m": F.col("v")})
    rows = _rows()
    by_key = defaultdict(list)
    for r in rows:
        by_key[r[1]].append(r)
    want = {}
    for group in by_key.values():
        for r in group:
            upto = [x for x in group if _sort_key(x[2]) <= _sort_key(r[2])]
            want[r[0]] = (sum(x[3] for x in upto), len(upto), max(x[3] for x in upto))
    assert {r["id"]: (r["s"], r["n"], r["m"]) for r in got.collect()} == want
    assert got.columns == ["id", "k", "o", "v", "s", "n", "m"]


def test_running_sums_keep_decimals_and_null_measures(spark):
    df = spark.createDataFrame([("a", 1, Decimal("1.10")), ("a", 2, None), ("a", 3, Decimal("2.05"))], "k string, o int, v decimal(18,2)")
    got = scan.running(df, ["k"], ["o"], {"s": F.col("v")}).orderBy("o").collect()
    assert [str(r["s"]) for r in got] == ["1.10", "1.10", "3.15"]


def test_a_hot_key_is_spread_over_shards(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("o"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in scan._ranged(df, ["k", "o"]).groupBy("_shard").count().collect()]
        got = scan.running(df, ["k"], ["o"], {"s": F.lit(1)})
        assert got.where("s <> o + 1").isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 9000


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, o int, v int")
    assert scan.positions(df, ["k"], ["o"]).isEmpty() and scan.running(df, ["k"], ["o"], {"s": F.col("v")}).isEmpty()
