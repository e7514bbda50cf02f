import os

import pytest
from pyspark.sql import DataFrame

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("input tables are not available")
    return FOLDER


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns that clash with those the operators add."""
    def make(rows, lang=None) -> DataFrame:
        schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, component_id string, count string"
        return spark.createDataFrame([(i, t, lang, "s", None, "x", "y", "z") for i, t in rows], schema)
    return make
