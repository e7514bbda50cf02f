"""Rows that several passes read come from the checkpoint folder."""

import glob

from pyspark.sql import functions as F

from riskweave.operators import preprocess
from riskweave.operators.lineage import materialise
from riskweave.session import ensure_checkpoint_dir
from riskweave.sources import sinks


def test_materialised_rows_come_from_the_checkpoint_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    assert folder == spark.sparkContext.getCheckpointDir() == ensure_checkpoint_dir(spark)
    df = materialise(spark.range(100).withColumn("y", (F.col("id") < 20).cast("int")))
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert glob.glob(f"{folder.removeprefix('file:')}/**/part-*", recursive=True)
    split = preprocess.stratified_split(df, "y", "id")
    assert split.where("split = 'validation'").count() == 20

    rows = spark.createDataFrame([(1, "x", "p"), (2, "y", "p"), (3, "y", "q")], "id long, a string, b string")
    added = sinks.insert_ignoring_conflicts(rows, rows.where("id > 9"), ["a", "b"], "id")
    assert sorted(r["id"] for r in added.collect()) == [1, 3]
