"""What the transfers shuffle, and what their features cost."""

import re
from unittest import mock

from pyspark.sql import functions as F

from riskweave.functions.conditions import finite_or_null
from riskweave.operators import features, quality
from riskweave.plans.catalog import QUERIES
from riskweave.sources.views import Views

FOLDER = "/root/testdata/sf0.001"


def test_lines_are_dealt_by_order_and_taker_only_and_places_are_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Views(spark, FOLDER).aml_transfers._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 3 and plan.count("BroadcastHashJoin") == 4


def test_formats_are_counted_once(spark):
    with mock.patch.object(features, "category_counts", wraps=features.category_counts) as counted:
        QUERIES["aml_payment_onehot"](spark, FOLDER)
    assert counted.call_count == 1


def test_the_features_of_a_row_fit_a_method_that_is_compiled(spark):
    """The JVM interprets methods of more than 8000 bytes, which takes three times as long."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = QUERIES["aml_features"](spark, FOLDER)._jdf.queryExecution()
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", spark._jvm.PythonSQLUtils.explainString(execution, "codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sizes and max(map(int, sizes)) < 8000


def test_missing_and_infinite_numbers_are_told_apart_from_the_others(spark):
    inf, nan = float("inf"), float("nan")
    rows = spark.createDataFrame([(0, 1.5), (1, -2.0), (2, inf), (3, -inf), (4, nan), (5, None)], "k int, x double")
    found = rows.select("k", finite_or_null(F.col("x")).alias("x")).orderBy("k").collect()
    assert [r["x"] for r in found] == [1.5, -2.0, None, None, None, None]
    assert [r["x"] for r in quality.fill_numeric(rows).orderBy("k").collect()] == [1.5, -2.0, 0.0, 0.0, 0.0, 0.0]
