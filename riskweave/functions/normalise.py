"""Normalisation of scores, labels and free-form values delivered by the risk domains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import fixed_values as V
from riskweave.functions.conditions import clamp

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(value: Column, default: float | None = None) -> Column:
    """Number in a string; anything that is not one becomes ``default``."""
    text = F.trim(value.cast("string"))
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return number if default is None else F.coalesce(number, F.lit(default))


def normalize_probability(value: Column) -> Column:
    """``25%``, ``25`` and ``0.25`` all mean a quarter; the rest is clamped to 0..1."""
    number = to_number(F.replace(value.cast("string"), F.lit("%"), F.lit("")), 0.0)
    return clamp(F.when(number > 1, number / 100).otherwise(number), 0.0, 1.0)


def normalize_score(value: Column) -> Column:
    """Scores up to 1 are shares and scaled by 100; the rest is clamped to 0..100."""
    number = to_number(value, 0.0)
    return clamp(F.when(number <= 1, number * 100).otherwise(number), 0.0, 100.0)


def first_present(schema: T.StructType, names: list[str], default: Column) -> Column:
    """First non-null of the listed columns that exist, else ``default``."""
    known = [F.col(name) for name in names if name in schema.fieldNames()]
    return F.coalesce(*known, default) if known else default


def normalize_segment(value: Column, default: str = "UNKNOWN") -> Column:
    text = F.trim(value)
    names = F.create_map(*[F.lit(part) for pair in V.SEGMENT_NAMES.items() for part in pair])
    return F.coalesce(F.try_element_at(names, F.lower(text)), text, F.lit(default))


def clean_decision(value: Column, default: str = "UNKNOWN") -> Column:
    """Decision label, also when it arrives inside the text of a whole prediction record."""

    def inside(key: str) -> Column:
        return F.nullif(F.regexp_extract(value, f"'{key}': '(LOW_RISK|REVIEW|HIGH_RISK)'", 1), F.lit(""))

    return F.coalesce(inside("credit_decision"), inside("fraud_decision"), value, F.lit(default))


def model_title(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


#: A JSON text's tokens: strings with their escapes, brackets, colons and commas, and whatever stands between them.
JSON_TOKENS = r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s{}\[\]:,"]+'
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _string_value(token: Column) -> Column:
    """What a quoted token stands for."""
    plain = F.substring(token, F.lit(2), F.length(token) - 2)
    return F.when(token.contains("\\"), F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")[0]).otherwise(plain)


def threshold_in(metadata: Column, names: list[str], default: float) -> Column:
    """First number stored under one of ``names`` at any depth of a JSON text, in the order of the text.

    Upper and lower case and the separators dash, underscore and blank make no difference; white space around a key is
    ignored. Numbers may be given as text, true and false count as 1 and 0; anything else under a name is searched
    further. Only a string before a colon is a key, so what stands inside other strings is none. Texts that aren't
    JSON, or repeat a key in one object, have no threshold.
    """
    tokens = F.regexp_extract_all(metadata, F.lit(JSON_TOKENS), F.lit(0))

    def found(token: Column, n: Column) -> Column:
        key = F.translate(F.lower(F.trim(_string_value(token))), "- ", "__")
        value = F.get(tokens, n + 2)
        text = F.trim(F.when(value.startswith('"'), _string_value(value)).otherwise(value))
        number = F.when(text.rlike(NUMBER), text.try_cast("double")).when(value == "true", 1.0).when(value == "false", 0.0)
        return F.when(token.startswith('"') & (F.get(tokens, n + 1) == ":") & key.isin(names), number)

    first = F.get(F.array_compact(F.transform(tokens, found)), F.lit(0))
    return F.coalesce(F.when(F.try_parse_json(metadata).isNotNull(), first), F.lit(default))


def padded(text: Column, width: int) -> Column:
    """Zeros in front up to ``width``; longer texts stay whole, so different keys stay different."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
