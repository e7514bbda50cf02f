"""Writers with a rule: append once per key, quarantine, insert ignoring conflicts."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.lineage import materialise
from riskweave.operators.quality import quarantine_audit, quarantine_split
from riskweave.operators.rules import ALERT_KEY, new_alerts


def table_or_empty(spark, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


#: Buckets of an alert table and transaction ids per partition of it. A table keeps the numbers it was begun with.
ALERT_BUCKETS, ALERT_SPAN = 32, 1_000_000
ALERT_RANGE = "transaction_range"


def alert_table(spark: SparkSession, path: str, schema: T.StructType, buckets: int = ALERT_BUCKETS) -> str:
    """Name of the alert table at ``path``, declared to this session and begun if nothing is there.

    It is partitioned by ranges of transaction_id, which a replayed alert can't change, and bucketed by the alert key.
    """
    name = f"alerts_{hashlib.md5(path.encode()).hexdigest()[:16]}_{buckets}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != ALERT_RANGE)
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} ({columns}, {ALERT_RANGE} BIGINT) USING parquet PARTITIONED BY ({ALERT_RANGE})
        CLUSTERED BY ({", ".join(ALERT_KEY)}) SORTED BY (transaction_id) INTO {buckets} BUCKETS LOCATION '{path}'""")
    spark.catalog.refreshTable(name)
    return name


def known_alerts(alerts: DataFrame, table: str, ranges: list[int | None], buckets: int = ALERT_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """``alerts`` dealt out as ``table`` is bucketed, and the keys that the table has in the given ranges."""
    wanted = F.col(ALERT_RANGE).isin([r for r in ranges if r is not None])
    existing = alerts.sparkSession.table(table).where(wanted if None not in ranges else wanted | F.col(ALERT_RANGE).isNull())
    return alerts.repartition(buckets, *ALERT_KEY), existing.select(*ALERT_KEY)


def append_alerts(alerts: DataFrame, path: str, buckets: int = ALERT_BUCKETS, span: int = ALERT_SPAN) -> dict[str, int]:
    """Append the alerts that are not in the table at ``path`` yet and report created and skipped ones.

    Running it twice, or again after a lost job, adds nothing twice: whatever was committed is found by the next run's
    anti join. One writer at a time is assumed; the committer decides whether a job that dies leaves part of an append,
    which the next run completes. Only the partitions of the alerts' own transactions are read, each bucket meets the
    alerts of its keys in place, and what is new is written in the same layout, so the cost follows the alerts and the
    ranges they touch, not the table. ``buckets`` and ``span`` must be those the table was begun with.
    """
    once = materialise(alerts.dropDuplicates(ALERT_KEY).withColumn(ALERT_RANGE, F.floor(F.col("transaction_id") / span).cast("long")))
    table = alert_table(alerts.sparkSession, path, once.schema, buckets)
    # no more ranges than partitions of the table, whose names the driver holds to read it
    ranges = [r[0] for r in once.select(ALERT_RANGE).distinct().collect()]
    dealt, existing = known_alerts(once, table, ranges, buckets)
    fresh = materialise(new_alerts(dealt, existing))
    created = fresh.count()
    if created:
        fresh.write.mode("append").format("parquet").partitionBy(ALERT_RANGE).bucketBy(buckets, *ALERT_KEY).sortBy(
            "transaction_id").option("path", path).saveAsTable(table)
    return {"created": created, "skipped": once.count() - created}


def write_quarantine(df: DataFrame, clean_path: str, quarantine_path: str, audit_path: str, source_file: str) -> None:
    """The input is evaluated once; the audit, written last, tells that the other two tables are complete."""
    df = materialise(df)
    valid, quarantined = quarantine_split(df, source_file=source_file)
    valid.write.mode("overwrite").parquet(clean_path)
    quarantined.write.mode("overwrite").parquet(quarantine_path)
    audit = quarantine_audit(df, source_file=source_file).withColumns({
        "processed_at_utc": F.current_timestamp(),
        "quarantine_file": F.lit(quarantine_path),
        "clean_staging_file": F.lit(clean_path),
    })
    audit.write.mode("overwrite").json(audit_path)


def insert_ignoring_conflicts(rows: DataFrame, existing: DataFrame, unique_keys: list[str], order_by: str) -> DataFrame:
    """Rows a conflict-ignoring insert would add, taking them in ``order_by`` order, which tells rows apart.

    A row clashes with the table or with an earlier *inserted* row on any unique key; null keys clash with nothing. A row
    that waits for one earlier row does the opposite of that row, so rows in a chain of clashes find the row at its head
    by pointer doubling: a chain of n takes about log n steps. A row that waits for several is decided once enough of
    them are; each round decides the first of every clash, and what a round has decided is written, so plans don't grow.
    """
    for key in unique_keys:
        rows = rows.join(existing.where(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti").select(*rows.columns)
    rows = materialise(rows)
    waiting = rows.select(F.col(order_by).alias("id"), *[F.col(k).alias(f"k{n}") for n, k in enumerate(unique_keys)])
    keys = [f"k{n}" for n in range(len(unique_keys))]
    inserted = waiting.limit(0).select("id")
    while not waiting.isEmpty():
        fates = _fates(waiting, keys)
        inserted = materialise(inserted.unionByName(fates.where("fate").select("id")))
        chosen = waiting.join(fates.where("fate"), "id", "left_semi")
        waiting = waiting.join(fates, "id", "left_anti")
        for key in keys:
            waiting = waiting.join(chosen.where(F.col(key).isNotNull()).select(key), key, "left_anti")
        waiting = materialise(waiting.select("id", *keys))
    return rows.join(inserted.withColumnRenamed("id", "_inserted"), F.col(order_by) == F.col("_inserted"), "left_semi")


def _fates(waiting: DataFrame, keys: list[str]) -> DataFrame:
    """(id, fate) of the rows that are decided by now: those without an earlier clash, and those in chains below them."""
    seen = waiting.select("id", *keys)
    for key in keys:
        # the first two rows of a key tell whether a row waits for none, one or more of that key
        first = seen.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("id").alias(f"{key}_a"))
        seen = seen.join(first, key, "left")
        second = seen.where(F.col("id") > F.col(f"{key}_a")).groupBy(key).agg(F.min("id").alias(f"{key}_b"))
        seen = seen.join(second, key, "left")

    def of(key: str) -> Column:
        a, b = F.col(f"{key}_a"), F.col(f"{key}_b")
        return F.when(F.col("id") > b, F.array(a, b)).when(F.col("id") > a, F.array(a)).otherwise(F.array().cast(f"array<{kind}>"))

    kind = waiting.schema["id"].dataType.simpleString()
    before = F.array_distinct(F.flatten(F.array(*[of(k) for k in keys])))
    heads = materialise(seen.select("id", before.alias("before")).where(F.size("before") < 2))
    free = heads.where(F.size("before") == 0).select("id")
    chain = heads.where(F.size("before") == 1).select("id", F.col("before")[0].alias("to"), F.lit(True).alias("opposite"))
    while True:
        ahead = chain.select(F.col("id").alias("to"), F.col("to").alias("further"), F.col("opposite").alias("again"))
        doubled = materialise(chain.join(ahead, "to", "left").select(
            "id", F.coalesce("further", "to").alias("to"), (F.col("opposite") != F.coalesce("again", F.lit(False))).alias("opposite"),
            F.col("further").isNotNull().alias("moved")))
        chain = doubled.drop("moved")
        if doubled.where("moved").isEmpty():
            break
    ends = chain.join(free.select(F.col("id").alias("to")), "to", "left_semi")
    return materialise(free.select("id", F.lit(True).alias("fate")).unionByName(ends.select("id", (~F.col("opposite")).alias("fate"))))
