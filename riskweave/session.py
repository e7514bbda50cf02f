"""Spark session with the settings the operators rely on."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot join keys: split them at run time, even if that costs one more shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # building a plan should not record the Python call site of every expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "riskweave", **extra: str) -> SparkSession:
    """Session for tests and benchmarks; on a cluster ``master`` stays None and comes from submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What independent steps return, each of which runs small jobs that leave most of a cluster idle one after another.

    All have ended when this returns, or raises what the first of them raised.
    """
    with ThreadPool(len(steps)) as pool:
        running = [pool.apply_async(inheritable_thread_target(spark)(step)) for step in steps]
        for step in running:
            step.wait()
        return [step.get() for step in running]


def own_folder(spark: SparkSession) -> str:
    """A new folder of this machine, for tests and single machines; executors elsewhere couldn't see it."""
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("Set spark.checkpoint.dir to a folder that driver and executors share.")
    return tempfile.mkdtemp(prefix="riskweave-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for ``DataFrame.checkpoint``: that of ``spark.checkpoint.dir``; one of this machine only in local mode where it is unset."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or own_folder(spark))
    return context.getCheckpointDir()
