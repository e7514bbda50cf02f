"""URL filters: pattern rules indexed by their rarest literal token.

Rules are configuration: host and path rules, of which the longest that fits decides, and patterns for what no such
rule judges. Every rule carries a regular expression and the literal tokens that any URL it fits must contain. How
often these tokens occur is counted over all URLs, and each rule is filed under its rarest one, in a hash table of
array slots that the plan carries as a literal. A URL's tokens fetch the rules filed under them; only those run their
expression. Everything is column expressions, in one pass, without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Between tokens.
BREAKS = r"[./]"
#: Rules in one hash table; more rules make more tables, all looked up in the same pass.
TABLE_RULES = 2_000


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    expression: str
    tokens: tuple[str, ...]
    rank: int
    path_rule: bool


def path_rule(verdict: str, name: str) -> Rule:
    """``host/path``: fits the host and its subdomains where the path starts so. The longer name wins."""
    host, slash, path = name.partition("/")
    host = host.translate(str.maketrans(UPPER, LOWER))  # as host_of
    whole = re.split(BREAKS, path)[:-1]  # the last part may go on in the URL
    return Rule(name, verdict, rf"(?s)^([^/]*\.)?{re.escape(host)}/{re.escape(path)}" if slash else rf"(?s)^([^/]*\.)?{re.escape(host)}(/|$)",
                tuple(t for t in (*host.split("."), *whole) if t), len(name), True)


def pattern(verdict: str, expression: str, *tokens: str) -> Rule:
    """A pattern over host and path that holds the given tokens (parts between dots and slashes)."""
    return Rule(expression, verdict, expression, tokens, 0, False)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(key: Column) -> Column:
    """Different parts between dots and slashes of host and path."""
    return F.array_distinct(F.split(key, BREAKS))


def count_tokens(keys: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """Rows of ``keys`` (key) in which each token of the rules occurs."""
    wanted = sorted({t for r in rules for t in r.tokens})
    found = keys.select(F.explode(tokens_of(F.col("key"))).alias("token")).where(F.col("token").isin(wanted))
    return {r["token"]: r["count"] for r in found.groupBy("token").count().collect()}  # as many rows as rules have tokens


def candidates(key: Column, rules: list[Rule], counts: dict[str, int]) -> Column:
    """The rules that fit ``key``, as structs; those filed under no token of it are not looked at."""
    tables = []
    for at in range(0, len(rules), TABLE_RULES):
        part = rules[at: at + TABLE_RULES]
        slots: list[list[Column]] = [[] for _ in range(1 << max(3, len(part).bit_length()))]
        spark_hash = _slots([min(r.tokens, key=lambda t: (counts.get(t, 0), t)) for r in part], len(slots))
        for rule, (token, slot) in zip(part, spark_hash):
            slots[slot].append(F.struct(
                F.lit(rule.rank).alias("rank"), F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"),
                F.lit(rule.path_rule).alias("path_rule"), F.lit(rule.expression).alias("expression"), F.lit(token).alias("token")))
        kind = "array<struct<rank:int,name:string,verdict:string,path_rule:boolean,expression:string,token:string>>"
        table = F.array(*[F.array(*s).cast(kind) if s else F.array().cast(kind) for s in slots])
        fetched = F.flatten(F.transform(tokens_of(key), lambda t: F.filter(
            F.element_at(table, _slot(t, len(slots)) + 1), lambda rule: rule["token"] == t)))
        tables.append(fetched)
    fetched = reduce(F.concat, tables)
    return F.filter(fetched, lambda rule: F.rlike(key, rule["expression"]))


def _slot(token: Column, count: int) -> Column:
    return F.pmod(F.crc32(token), F.lit(count)).cast("int")


def _slots(tokens: list[str], count: int) -> list[tuple[str, int]]:
    return [(t, zlib.crc32(t.encode()) % count) for t in tokens]


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """All columns of ``pages`` and host, path, rule (name of the path rule that decides, else null), verdict.

    The longest path rule that fits decides, of equally long ones the first by name; without one, a pattern that fits
    blocks or allows (block wins); without any, ``default``. Null urls and urls without ``://`` have an empty host and
    path, so no rule fits. Columns of ``pages`` with these four names are replaced. Repeated rows, long urls and empty
    tables need no care: rows are independent.
    """
    if not all(r.tokens for r in rules):
        raise ValueError("a rule needs a literal token to be filed under")
    if any(re.search(BREAKS, t) for r in rules for t in r.tokens):
        raise ValueError("no url has a token with a dot or slash")
    keys = pages.select(F.concat(host_of(F.col(f"`{url}`")), path_of(F.col(f"`{url}`"))).alias("key"))
    counts = count_tokens(keys, rules) if rules else {}
    names = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    kept = [F.col(f"`{n}`") for n in names]
    parts = pages.select(*kept, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    key = F.concat("host", "path")
    if not rules:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    fitting = parts.withColumn("_fit", candidates(key, rules, counts))
    longest = F.array_sort(F.filter("_fit", lambda r: r["path_rule"]), lambda a, b: F.when(a["rank"] != b["rank"], b["rank"] - a["rank"]).when(
        a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0))
    by_pattern = F.filter("_fit", lambda r: ~r["path_rule"])["verdict"]
    verdict = F.coalesce(F.get(F.col("_longest"), 0)["verdict"], F.when(F.array_contains("_patterns", "block"), "block").when(
        F.size("_patterns") > 0, "allow"), F.lit(default))
    return fitting.withColumns({"_longest": longest, "_patterns": by_pattern}).select(
        *kept, "host", "path", F.get(F.col("_longest"), 0)["name"].alias("rule"), verdict.alias("verdict"))
