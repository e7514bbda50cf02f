"""Running totals and row numbers over a distributed sort.

Rows are dealt out by ranges of (keys, order) and sorted in each range, a shard, so no key is bound to one task: one
that holds a third of all rows covers a third of the shards. Inside a shard totals run locally; what earlier shards
hold of the key that a shard begins with comes from a table of two rows per shard, which is small whatever the keys
are. The sorted rows are written to the checkpoint folder, so shards stay what they are in all passes that follow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.operators.lineage import materialise

#: ``monotonically_increasing_id`` keeps the partition above this bit and the row in it below.
ROW_BITS = 33
EARLIER = (Window.unboundedPreceding, -1)


def _ranged(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` sorted over shards, with ``_row`` ascending over all of them and ``_shard``.

    Rows equal in all columns are in one shard. ``df`` is read twice, first for the borders.
    """
    placed = df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("_row", F.monotonically_increasing_id())
    return materialise(placed).withColumn("_shard", F.shiftright("_row", ROW_BITS))


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which missing keys are equal; the right side's keys go."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_right_{k}"]) for k in keys], F.lit(True))
    return left.join(right, same, how).drop(*[f"_right_{k}" for k in keys])


def positions(df: DataFrame, keys: list[str], order: list[str], out: str = "position", total: str | None = None) -> DataFrame:
    """``df`` with its row number, from 0, among the rows of its keys in ``order``; ``total``: how many these are.

    Null keys are a key and nulls come first in ``order``; rows equal in everything named take any order.
    """
    rows = _ranged(df, [*keys, *order])
    runs = rows.groupBy("_shard", *keys).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    own = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_n").over(own.orderBy("_shard").rowsBetween(*EARLIER)), F.lit(0))
    runs = runs.select("_shard", *keys, (before - F.col("_first")).alias("_base"), F.sum("_n").over(own).alias("_total"))
    found = _join(rows, runs, ["_shard", *keys]).withColumn(out, F.col("_row") + F.col("_base"))
    if total:
        found = found.withColumn(total, F.col("_total"))
    return found.drop("_row", "_shard", "_base", "_total")


def running(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column] | None = None,
            maxima: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with, per entry of ``sums`` and ``maxima``, that of the column over the rows of its keys up to its own in ``order``.

    Rows equal in ``order`` count for each other. Null keys are a key, null measures count as nothing: a sum of none is
    0, a maximum of none null. Two exchanges of the rows: by range, and by shard for the local totals.
    """
    sums, maxima = sums or {}, maxima or {}
    names = [*sums, *maxima]
    fold = {n: F.sum if n in sums else F.max for n in names}
    types = df.select(*[fold[n](c).alias(n) for n, c in {**sums, **maxima}.items()]).schema
    zero = {n: F.lit(0 if n in sums else None).cast(types[n].dataType) for n in names}
    rows = _ranged(df.withColumns({f"_m_{n}": c for n, c in {**sums, **maxima}.items()}), [*keys, *order])
    key = F.struct(*[F.col(f"`{k}`") for k in keys]) if keys else F.struct(F.lit(1).alias("_all"))
    rows = rows.withColumn("_key", key)
    # the first and the last key of each shard, and what the shard holds of them
    ends = rows.groupBy("_shard").agg(F.min_by("_key", "_row").alias("a"), F.max_by("_key", "_row").alias("b"))
    ends = ends.select("_shard", F.explode(F.array_distinct(F.array("a", "b"))).alias("_key"))
    measures = [F.coalesce(fold[n](f"_m_{n}"), zero[n]).alias(f"_t_{n}") for n in names]
    held = _join(rows.select("_shard", "_key", *[f"_m_{n}" for n in names]), F.broadcast(ends), ["_shard", "_key"]).groupBy(
        "_shard", "_key").agg(*measures)
    earlier = Window.partitionBy("_key").orderBy("_shard").rowsBetween(*EARLIER)
    base = held.select("_shard", "_key", *[
        F.coalesce(fold[n](f"_t_{n}").over(earlier), zero[n]).cast(types[n].dataType).alias(f"_b_{n}") for n in names])
    local = Window.partitionBy("_shard", *keys).orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    run = rows.withColumns({n: F.coalesce(fold[n](f"_m_{n}").over(local), zero[n]) for n in names})
    # two rows a shard, however many rows or keys there are
    found = _join(run, F.broadcast(base), ["_shard", "_key"], "left")
    whole = {n: (F.col(n) + F.coalesce(F.col(f"_b_{n}"), zero[n]) if n in sums else F.greatest(n, f"_b_{n}")).cast(types[n].dataType)
             for n in names}
    return found.withColumns(whole).drop("_row", "_shard", "_key", *[f"_{p}_{n}" for p in "mb" for n in names])
