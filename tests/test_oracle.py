"""Every query with reference SQL gives the same schema, rows and values as DuckDB."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from riskweave.plans.catalog import QUERIES
from verification.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="input tables are not available")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_same_as_sql(spark, duck, name):
    assert compare(queries()[name](spark, FOLDER), duck, oracle_sql()[name]) == ""


def test_entry_lists_alerts_with_reasons(spark):
    alerts = entry(spark)
    assert {"transaction_id", "risk_level", "investigation_notes"} <= set(alerts.columns)
    assert alerts.count() > 0


def test_only_models_lack_sql():
    own = set(QUERIES)
    assert own - set(oracle_sql()) == {
        "credit_risk_run", "fraud_risk_run", "transaction_fraud_run", "aml_run", "batch_score", "credit_inference",
        "feature_importance", "top_features", "explain_features"}
    assert own <= set(queries())
