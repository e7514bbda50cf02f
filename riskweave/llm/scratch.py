"""Tables written between steps, in the folder that all executors share.

``spark.checkpoint.dir`` names that folder on a cluster. Only where it is unset in local mode a folder of this machine
is made. Tables stay until `clear`, which a caller uses once the results are written. A written table cuts the lineage, survives lost executors and forgets how its rows were dealt
out, so the joins that follow shuffle plainly and adaptive execution can split their hot keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskweave.session import own_folder

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + own_folder(spark)
    return _local[app]


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``; from here on the session sends at most ``rows`` rows at once to Python.

    Whole texts make rows of kilobytes to megabytes, and a batch is held several times on both sides.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= rows:
        df.sparkSession.conf.set(key, str(rows))
    return df


def new_folder(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses."""
    return f"{_own(spark)}/{name}-{uuid.uuid4().hex}"


def _own(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/riskweave/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete the tables that this application has written here; results that still read them can't be computed again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
