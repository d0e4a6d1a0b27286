"""Column protection: hash, encrypt, mask, redact, tag."""

from __future__ import annotations

import base64
import binascii
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.functions.values import col
from stratiform.spec import Policy

# What a redacted value and a masked character look like.
REDACTED = "[REDACTED]"
MASK_CHARACTER = "*"


def hashed(c: str | Column) -> Column:
    """Deterministic, so hashed columns still join."""
    return F.sha2(col(c).cast("string"), 256)


def masked(c: str | Column) -> Column:
    """One mask character per character of any kind, newlines included."""
    return F.repeat(F.lit(MASK_CHARACTER), F.length(col(c).cast("string")))


def redacted() -> Column:
    return F.lit(REDACTED)


def key_bytes(encoded: str | None) -> bytes:
    """Decode and check a base64 AES key. A missing or unusable key is an error, never cleartext."""
    if not encoded:
        raise ValueError("encryption key is missing")
    try:
        key = base64.b64decode(encoded, validate=True)
    except binascii.Error as e:
        raise ValueError("encryption key is not valid base64") from e
    if len(key) not in (16, 24, 32):
        raise ValueError("encryption key must have 16, 24 or 32 bytes")
    return key


def key_column(df: DataFrame, encoded: str | None) -> Column:
    """The key as a scalar subquery over a one-row table, which keeps it out of plan texts and logs."""
    one_row = df.sparkSession.createDataFrame([(bytearray(key_bytes(encoded)),)], "key binary")
    return one_row.scalar()


def encrypted(c: str | Column, key: Column) -> Column:
    """AES-GCM with a random vector per value."""
    return F.aes_encrypt(col(c).cast("string"), key, F.lit("GCM"))


def decrypted(c: str | Column, key: Column, dtype: str = "string") -> Column:
    return F.aes_decrypt(col(c), key, F.lit("GCM")).cast("string").cast(dtype)


def protect(
    df: DataFrame,
    policies: Iterable[Policy],
    layer: str = "silver",
    keys: Mapping[str, str] | None = None,
) -> DataFrame:
    """Apply the policies in force at a layer, in order, as one projection."""
    expressions = {name: F.col(f"`{name}`") for name in df.columns}
    tags: dict[str, dict] = {}
    for policy in policies:
        if not policy.applies_at(layer):
            continue
        if policy.column not in expressions:
            raise ValueError(f"policy for missing column {policy.column!r}")
        current = expressions[policy.column]
        if policy.kind == "hash":
            current = hashed(current)
        elif policy.kind == "mask":
            current = masked(current)
        elif policy.kind == "redact":
            current = redacted()
        elif policy.kind == "encrypt":
            current = encrypted(current, key_column(df, (keys or {}).get(policy.key_ref or "")))
        expressions[policy.column] = current
        tags.setdefault(policy.column, {})["policy"] = policy.kind
        if policy.classification:
            tags[policy.column]["classification"] = policy.classification
    return df.select(
        *[
            c.alias(name, metadata={**df.schema[name].metadata, **tags[name]}) if name in tags else c.alias(name)
            for name, c in expressions.items()
        ]
    )
