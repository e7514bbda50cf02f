"""Masking of personal data: reports show tokens and tails, never the values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DROPPED = ["first_name", "last_name", "email", "mobile_number", "ip_address", "date_of_birth", "address_line_1", "address_line_2", "postal_code"]
TOKENISED = ["pan_number", "aadhaar_number", "device_fingerprint"]
TAIL_ONLY = ["account_number", "card_number"]


def token(value: Column, key: str) -> Column:
    """Stable pseudonym that still joins. Numbers this short can be listed, so only the secret ``key`` keeps them unreadable.

    The digest is taken twice with the key, inside and outside, as keyed digests are.
    """
    inner = F.sha2(F.concat(F.lit(f"{key}:in:"), value.cast("string")), 256)
    return F.sha2(F.concat(F.lit(f"{key}:out:"), inner), 256)


def tail(value: Column, shown: int = 4) -> Column:
    return F.concat(F.lit("****"), F.right(value, F.lit(shown)))


def mask_personal_data(df: DataFrame, key: str) -> DataFrame:
    """Drop names, contacts and addresses, tokenise identifiers with ``key``, keep only the tail of numbers."""
    masked = df.drop(*DROPPED)
    for name in df.columns:
        if name in TOKENISED:
            masked = masked.withColumn(name, token(F.col(name), key))
        elif name in TAIL_ONLY:
            masked = masked.withColumn(name, tail(F.col(name)))
    return masked
