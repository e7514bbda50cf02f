"""Exact quantiles without gathering a column in one task.

The built-in ``percentile`` keeps every distinct value of a column in one aggregation buffer. Here two passes do for any
number of columns that have few values about a rank, and three or more for others. The first merges a quantile sketch per
column, of a fixed size, and takes from it bounds between which each wanted rank lies almost surely. The second counts the
values below and up to the bounds, which proves whether a rank lies between them, whatever the sketch said. Where the bounds
are one value, it is the rank's; else the few values between them are counted in slices. Ranks at the ends of their slice
are its least or greatest value, which ends the search unless a slice holds three distinct values or more; such slices are
counted again, at most eight times for doubles of any magnitude.

Only the bounds of the groups that hold a rank travel to the driver, at most two per column and quantile, and they return
as range filters the scan can use. Like every fit, this runs when it is called.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICES = 65_536
#: With more, the counts of a pass don't fit what Spark compiles.
RANGES_A_PASS = 40
#: Size of a sketch (about 100 KB a column and task) and the share of rows by which its ranks are taken to be wrong at most;
#: the published error at 99 % is a third of that. A worse error costs a pass, not the result.
SKETCH_K, SKETCH_ERROR = 4096, 0.003


@dataclass
class _Range:
    """Rows of a column between two values, those before them, and the ranks wanted among them."""

    column: str
    low: float
    high: float
    before: int = 0
    rows: int = 0
    ranks: set[int] = field(default_factory=set)


def _known(df: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    known = value.isNotNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        known = known & ~F.isnan(value)
    return known


def _values(df: DataFrame, columns: list[str], ranges: list[_Range] | None = None) -> DataFrame:
    """Long form (column, value) of the known values, restricted to the given ranges."""

    def number(c: str) -> Column:
        return F.col(f"`{c}`").cast("double")

    if ranges is not None:
        wanted = [number(r.column).between(r.low, r.high) for r in ranges]
        df = df.where(reduce(lambda a, b: a | b, wanted))
    if len(columns) == 1:
        column = columns[0]
        long = df.where(_known(df, column)).select(F.lit(column).alias("column"), number(column).alias("value"))
    else:
        known = df.select(*[F.when(_known(df, c), number(c)).alias(c) for c in columns])
        long = known.unpivot([], columns, "column", "value").where(F.col("value").isNotNull())
    if ranges is None:
        return long
    place = F.lit(None).cast("int")
    for i, r in enumerate(ranges):
        inside = (F.col("column") == r.column) & F.col("value").between(r.low, r.high)
        place = F.when(inside, i).otherwise(place)
    return long.withColumn("range", place).where(F.col("range").isNotNull())


def _magnitude(value: float) -> float:
    """Rises with the value: octaves, so that no magnitude takes more slices than another. See `_magnitudes`."""
    return 0.0 if value == 0 else math.copysign(1100 + (1025.0 if math.isinf(value) else math.log2(abs(value))), value)


def _magnitudes(value: Column) -> Column:
    return F.when(value == 0, F.lit(0.0)).otherwise(F.signum(value) * (F.least(F.log2(F.abs(value)), F.lit(1025.0)) + 1100))


def _place(r: _Range) -> Column:
    """Slice of a value inside its range: even steps within an octave, else even steps of magnitude."""
    if r.low == r.high:
        return F.lit(0).cast("long")
    if 0 < r.low and r.high <= 2 * r.low < math.inf or r.high < 0 and -math.inf < 2 * r.high <= r.low:
        share = (F.col("value") - r.low) / (r.high - r.low)
    else:
        low, high = _magnitude(r.low), _magnitude(r.high)
        share = (_magnitudes(F.col("value")) - low) / (high - low)
    return F.greatest(F.lit(0), F.least(F.floor(share * SLICES), F.lit(SLICES - 1)))


def _earlier(keys: list[str], order: list[str]) -> Column:
    """Rows in earlier groups; the window runs over group counts, not over rows."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(window), F.lit(0))


def _counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


def _sketched(df: DataFrame, columns: list[str], probabilities: list[float]) -> tuple[dict[str, int], list[_Range]]:
    """Number of known values per column that has some, and disjoint ranges, ascending per column, that should hold the ranks."""
    shares = [min(max(p + error, 0.0), 1.0) for p in probabilities for error in (-SKETCH_ERROR, SKETCH_ERROR)]
    values = [F.when(_known(df, c), F.col(f"`{c}`").cast("double")) for c in columns]
    sketches = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(columns))],
        *[F.kll_sketch_agg_double(f"v{i}", F.lit(SKETCH_K)).alias(f"s{i}") for i in range(len(columns))])
    row = sketches.select(*[f"n{i}" for i in range(len(columns))], *[
        F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.array(*[F.lit(s) for s in shares]))).alias(f"q{i}")
        for i in range(len(columns))]).first()
    totals = {c: row[f"n{i}"] for i, c in enumerate(columns) if row[f"n{i}"]}
    ranges: list[_Range] = []
    for i, c in enumerate(columns):
        bounds = row[f"q{i}"] or []
        for low, high in sorted(zip(bounds[::2], bounds[1::2])):
            if ranges and ranges[-1].column == c and low <= ranges[-1].high:
                ranges[-1].high = max(ranges[-1].high, high)
            else:
                ranges.append(_Range(c, low, high))
    return totals, ranges


def _located(df: DataFrame, ranges: list[_Range], ranks: dict[str, set[int]], totals: dict[str, int]) -> list[_Range]:
    """The ranges that hold the wanted ranks, proven by counts of what is below and up to them; where none holds a rank,
    all values of its column are the range of all its ranks."""
    counted = []
    for at in range(0, len(ranges), RANGES_A_PASS):
        some = ranges[at:at + RANGES_A_PASS]
        values = [F.col(f"`{r.column}`").cast("double") for r in some]
        row = df.agg(*[F.count_if(v < r.low).alias(f"b{i}") for i, (v, r) in enumerate(zip(values, some))],
                     *[F.count_if(v <= r.high).alias(f"u{i}") for i, (v, r) in enumerate(zip(values, some))]).first()
        counted += [replace(r, before=row[f"b{i}"], rows=row[f"u{i}"] - row[f"b{i}"]) for i, r in enumerate(some)]
    located = [replace(r, ranks={k for k in ranks[r.column] if r.before <= k < r.before + r.rows}) for r in counted]
    held = {(r.column, k) for r in located for k in r.ranks}
    missed = {c for c, own in ranks.items() if any((c, k) not in held for k in own)}
    return [r for r in located if r.ranks and r.column not in missed] + [
        _Range(c, -math.inf, math.inf, 0, totals[c], set(ranks[c])) for c in sorted(missed)]


def _narrow(df: DataFrame, ranges: list[_Range]) -> list[_Range]:
    """Replace every range by the slices that hold its wanted ranks."""
    group = F.lit(0).cast("long")
    for i, r in enumerate(ranges):
        group = F.when(F.col("range") == i, _place(r)).otherwise(group)
    rows = _values(df, sorted({r.column for r in ranges}), ranges).withColumn("group", group)
    counted = _counted(rows, ["range", "group"]).withColumn("before", _earlier(["range"], ["group"]))
    holds = F.lit(False)
    for i, r in enumerate(ranges):
        for rank in r.ranks:
            inside = (F.col("before") <= rank - r.before) & (F.col("before") + F.col("n") > rank - r.before)
            holds = holds | ((F.col("range") == i) & inside)
    found = []
    for row in counted.where(holds).select("range", "n", "low", "high", "before").collect():
        outer = ranges[row["range"]]
        before = outer.before + row["before"]
        ranks = {k for k in outer.ranks if before <= k < before + row["n"]}
        found.append(_Range(outer.column, row["low"], row["high"], before, row["n"], ranks))
    return found


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, dict[float, float | None]]:
    """Quantiles per column with linear interpolation between ranks; missing values are skipped, infinite ones are values.

    ``df`` is read twice or more, and must give the same rows each time.
    """
    columns = list(columns)
    if not columns or not probabilities:
        return {c: {} for c in columns}
    totals, ranges = _sketched(df, columns, probabilities)

    def around(column: str, probability: float) -> tuple[int, int, float]:
        position = probability * (totals[column] - 1)
        return int(position // 1), int(-(-position // 1)), position - position // 1

    ranks = {c: {k for p in probabilities for k in around(c, p)[:2]} for c in totals}
    found: dict[tuple[str, int], float] = {}
    ranges = _located(df, ranges, ranks, totals) if ranks else []
    wide = [r for r in ranges if r.low < r.high]
    ranges = [r for r in ranges if r.low == r.high] + (_narrow(df, wide) if wide else [])
    while ranges:
        for r in ranges:
            for k in r.ranks:
                if r.low == r.high or k == r.before:
                    found[r.column, k] = r.low
                elif k == r.before + r.rows - 1:
                    found[r.column, k] = r.high
        ranges = [replace(r, ranks=rest) for r in ranges if (rest := {k for k in r.ranks if (r.column, k) not in found})]
        if ranges:
            ranges = _narrow(df, ranges)

    def interpolated(column: str, probability: float) -> float | None:
        if column not in totals:
            return None
        low, high, share = around(column, probability)
        low, high = found[column, low], found[column, high]
        return low if low == high else low + (high - low) * share

    return {c: {p: interpolated(c, p) for p in probabilities} for c in columns}


def quantile_value(df: DataFrame, column: str, probability: float) -> Column:
    """One exact quantile as a literal, ready to be used next to row columns."""
    return F.lit(exact_quantiles(df, [column], [probability])[column][probability]).cast("double")
