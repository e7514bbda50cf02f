"""Cutting the lineage of results that several passes read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskweave.session import ensure_checkpoint_dir


def materialise(df: DataFrame) -> DataFrame:
    """Compute once, read often: the rows are written to the checkpoint folder and survive lost executors.

    They go when nothing refers to them any more (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
