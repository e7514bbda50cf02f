"""Event-time rules over an account's trailing window: velocity, structuring, high value, cross-border.

Rules are rows of a table and stay rows: events meet them in joins through bands, so a plan is as large for one rule as
for a thousand. A trailing window is a difference of running totals: an event enters at its time and leaves one
microsecond after its window has passed. Running totals come from a distributed sort (`scan.running`) that spreads a
single very busy account over many tasks; no frame is re-evaluated row by row.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.scan import running

KINDS = ("velocity", "structuring", "high_value", "cross_border")
RULE_SCHEMA = ("rule_code string, severity string, threshold_amount decimal(18,2), threshold_count int, time_window_minutes int, "
               "is_active boolean, rule_kind string")
MICROS_A_MINUTE = 60_000_000


@dataclass(frozen=True)
class AmlRule:
    rule_code: str
    severity: str
    threshold_amount: Decimal | None = None
    threshold_count: int | None = None
    time_window_minutes: int | None = None
    rule_kind: str | None = None

    @property
    def kind(self) -> str:
        """Count alone is velocity, count and amount is structuring, amount alone is high value; cross-border says so."""
        if self.rule_kind == "cross_border":
            if self.threshold_count is not None or self.time_window_minutes is not None:
                raise ValueError(f"{self.rule_code}: a cross-border rule looks at one transfer, not at a window.")
            return "cross_border"
        if (self.threshold_count is None) != (self.time_window_minutes is None):
            raise ValueError(f"{self.rule_code}: a count needs a window and a window needs a count.")
        if self.threshold_count is not None:
            return "structuring" if self.threshold_amount is not None else "velocity"
        if self.threshold_amount is None:
            raise ValueError(f"{self.rule_code}: neither a count nor an amount to reach.")
        return "high_value"


def rule_table(spark: SparkSession, rules: list[AmlRule]) -> DataFrame:
    """Rules given as objects as a table."""
    return spark.createDataFrame([
        (r.rule_code, r.severity, r.threshold_amount, r.threshold_count, r.time_window_minutes, True, r.kind) for r in rules], RULE_SCHEMA)


def active_rules(rules: DataFrame) -> list[AmlRule]:
    """The active rows of the rule table, which is configuration; malformed rules raise."""
    kind = F.col("rule_kind") if "rule_kind" in rules.columns else F.lit(None).cast("string")
    found = [
        AmlRule(r["rule_code"], r["severity"], r["threshold_amount"], r["threshold_count"], r["time_window_minutes"], r["rule_kind"])
        for r in sorted(rules.where("is_active").withColumn("rule_kind", kind).collect(), key=lambda r: r["rule_code"])]
    for rule in found:
        rule.kind  # noqa: B018  raises
    return found


def _cents(amount: Column) -> Column:
    return amount.cast("decimal(18,2)")


def amount_band(amount: Column) -> Column:
    """Powers of two: a larger amount is never in a lower band. Amounts under 1, missing ones too, are in band 0."""
    return F.when(amount >= 1, F.length(F.bin(F.floor(amount).cast("long")))).otherwise(0)


def reached(events: DataFrame, rules: DataFrame, amount: str = "amount") -> DataFrame:
    """Each event with each rule whose threshold_amount its amount reaches; a rule without one is reached by all.

    A rule is filed under the band of its threshold. An event asks its own band and those below it that hold a rule, so
    what it is compared with and not matched lies in one band.
    """
    filed = rules.withColumn("_band", F.when(F.col("threshold_amount").isNull(), -1).otherwise(amount_band(F.col("threshold_amount"))))
    bands = [r[0] for r in filed.select("_band").distinct().collect()]  # 60 at most
    asked = events.withColumn("_cents", _cents(F.col(amount))).withColumn(
        "_band", F.explode(F.filter(F.lit(bands).cast("array<int>"), lambda b: b <= amount_band(F.col("_cents")))))
    found = asked.join(F.broadcast(filed), "_band")  # the rule table is configuration
    return found.where(F.col("threshold_amount").isNull() | (F.col("_cents") >= F.col("threshold_amount"))).drop("_band", "_cents")


def trailing_windows(events: DataFrame, minutes: list[int], account: str = "account_id", ts: str = "ts", amount: str = "amount") -> DataFrame:
    """A row per event and window length with window_minutes, window_count and window_sum over its account's trailing window.

    The window includes both ends and every event of the same instant; events without account share one. Events
    without a time have no window: their count and sum are null. Columns of these names are replaced.
    """
    kept = [c for c in events.columns if c not in ("window_minutes", "window_count", "window_sum")]
    rows = events.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_event"), F.col(f"`{account}`").alias("_account"),
        F.unix_micros(F.col(f"`{ts}`").cast("timestamp")).alias("_at"), F.coalesce(_cents(F.col(f"`{amount}`")), F.lit(0)).alias("_cents"),
        F.explode(F.lit(minutes).cast("array<int>")).alias("_minutes"))
    enters = F.struct(F.col("_at").alias("at"), F.lit(1).alias("n"), F.col("_event").alias("event"))
    leaves = F.struct((F.col("_at") + F.col("_minutes").cast("long") * MICROS_A_MINUTE + 1).alias("at"), F.lit(-1).alias("n"),
                      F.lit(None).cast(rows.schema["_event"].dataType).alias("event"))
    changes = rows.where("_at IS NOT NULL").select("_account", "_minutes", "_cents", F.explode(F.array(enters, leaves)).alias("_c")).select(
        "_account", "_minutes", "_c.*", (F.col("_cents") * F.col("_c.n")).cast("decimal(18,2)").alias("s"))
    totals = running(changes, ["_minutes", "_account"], ["at"], {"window_count": F.col("n").cast("long"), "window_sum": F.col("s")})
    own = [F.col(f"_event.`{c}`").alias(c) for c in kept]
    counted = totals.where("n = 1").withColumnRenamed("event", "_event").select(
        *own, F.col("_minutes").alias("window_minutes"), "window_count", F.col("window_sum").cast("decimal(28,2)").alias("window_sum"))
    timeless = rows.where("_at IS NULL").select(
        *own, F.col("_minutes").alias("window_minutes"), F.lit(None).cast("long").alias("window_count"),
        F.lit(None).cast("decimal(28,2)").alias("window_sum"))
    return counted.unionByName(timeless)


def _without_large(hits: DataFrame, events: DataFrame, rules: DataFrame, account: str, ts: str, amount: str) -> DataFrame:
    """The hits of structuring rules in whose window no amount reaches the rule's threshold.

    Per threshold and account the latest large amount so far comes from one scan over large amounts and hits.
    """
    def at(frame: DataFrame) -> DataFrame:
        return frame.withColumn("_at", F.unix_micros(F.col(f"`{ts}`").cast("timestamp")))

    limits = rules.select("threshold_amount").distinct()
    large = at(reached(events.select(account, ts, amount), limits, amount)).where("_at IS NOT NULL")
    both = at(hits).withColumn("_hit", F.lit(True)).unionByName(
        large.withColumn("_large", F.col("_at")), allowMissingColumns=True)
    seen = running(both, ["threshold_amount", account], ["_at"], maxima={"_last": F.col("_large")})
    outside = F.col("_last") < F.col("_at") - F.col("window_minutes").cast("long") * MICROS_A_MINUTE
    return seen.where("_hit").where(F.col("_last").isNull() | outside).select(*[F.col(f"`{c}`") for c in hits.columns])


def evaluate_rules(events: DataFrame, rules: DataFrame | list[AmlRule], kind: str | None = None, account: str = "account_id", ts: str = "ts",
                   amount: str = "amount", country_from: str = "country_from", country_to: str = "country_to") -> DataFrame:
    """Events on which rules fire, one row per event and rule: rule_code, severity, window_count and window_sum.

    A velocity rule fires when the window holds its count; a structuring rule when it also reaches the amount in sum
    and no single amount does; a high value rule on an amount; a cross-border rule on a transfer between two known,
    different countries, from its amount on if it has one. ``rules`` is a table like aml_rules, whose optional rule_kind
    names the cross-border ones, or a list. Columns of events named like those of a rule or a window are replaced.
    """
    spark = events.sparkSession
    chosen = [r for r in (rules if isinstance(rules, list) else active_rules(rules)) if kind is None or r.kind == kind]
    if not chosen:
        raise ValueError(f"No active rule of kind {kind!r}.")
    table = rule_table(spark, chosen).drop("is_active")
    added = {f.name for f in table.schema.fields} | {"window_minutes", "window_count", "window_sum"}
    kept = [c for c in events.columns if c not in added]
    events = events.select(*[F.col(f"`{c}`") for c in kept])
    out = [*[F.col(f"`{c}`") for c in kept], F.col("rule_code"), F.col("severity")]
    present = {r.kind for r in chosen}
    parts = []
    single = table.where(F.col("rule_kind").isin("high_value", "cross_border"))
    if present & {"high_value", "cross_border"}:
        found = reached(events, single, amount)
        if "cross_border" in present:
            abroad = F.coalesce(F.col(f"`{country_from}`") != F.col(f"`{country_to}`"), F.lit(False))
            found = found.where((F.col("rule_kind") != "cross_border") | abroad)
        parts.append(found.select(*out, F.lit(1).cast("long").alias("window_count"), _cents(F.col(f"`{amount}`")).cast("decimal(28,2)").alias("window_sum")))
    windowed = table.where(F.col("rule_kind").isin("velocity", "structuring")).withColumnRenamed("time_window_minutes", "window_minutes")
    if present & {"velocity", "structuring"}:
        lengths = sorted({r.time_window_minutes for r in chosen if r.time_window_minutes is not None})
        seen = trailing_windows(events, lengths, account, ts, amount)
        # rules of a window length; a sum has to reach what structuring asks for
        hits = seen.join(F.broadcast(windowed), "window_minutes").where(
            (F.col("window_count") >= F.col("threshold_count")) & (F.col("threshold_amount").isNull() | (F.col("window_sum") >= F.col("threshold_amount"))))
        if "velocity" in present:
            parts.append(hits.where("rule_kind = 'velocity'").select(*out, "window_count", "window_sum"))
        if "structuring" in present:
            own = hits.where("rule_kind = 'structuring'")
            parts.append(_without_large(own, events, table.where("rule_kind = 'structuring'"), account, ts, amount).select(
                *out, "window_count", "window_sum"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
