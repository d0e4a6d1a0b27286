"""Column protection."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.functions import protect
from stratiform.plans.catalogue.registry import query, table
from stratiform.spec import Policy

# A made-up key for the queries; jobs take theirs from a secret store.
_KEYS = {"demo-key": "c3RyYXRpZm9ybS1kZW1vIQ=="}


def _customer(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query("policy_hash", "SELECT c_custkey, sha256(c_name) AS c_name, c_acctbal, c_mktsegment FROM customer")
def policy_hash(spark, d):
    return protect.protect(_customer(spark, d), [Policy("c_name", "hash")])


@query(
    "policy_hash_join",
    """SELECT o_orderkey, c_custkey, c_mktsegment FROM orders
       JOIN customer ON c_name = 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')""",
)
def policy_hash_join(spark, d):
    """Hashed names on both sides still join."""
    named = table(spark, d, "orders").select(
        "o_orderkey", F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("c_name")
    )
    policy = [Policy("c_name", "hash")]
    return (
        protect.protect(named, policy)
        .join(protect.protect(_customer(spark, d), policy), "c_name")
        .select("o_orderkey", "c_custkey", "c_mktsegment")
    )


@query(
    "policy_mask",
    "SELECT c_custkey, regexp_replace(c_name, '(?s).', '*', 'g') AS c_name, c_acctbal, c_mktsegment FROM customer",
)
def policy_mask(spark, d):
    return protect.protect(_customer(spark, d), [Policy("c_name", "mask")])


@query(
    "policy_redact",
    "SELECT c_custkey, '[REDACTED]' AS c_name, c_acctbal, c_mktsegment FROM customer",
)
def policy_redact(spark, d):
    """Redaction hides NULLs too."""
    some_null = _customer(spark, d).withColumn("c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_name")))
    return protect.protect(some_null, [Policy("c_name", "redact")])


@query("policy_tag_only", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def policy_tag_only(spark, d):
    return protect.protect(_customer(spark, d), [Policy("c_name", "tag_only", classification="pii")])


@query(
    "policy_encrypt_roundtrip",
    "SELECT c_custkey, c_name, c_acctbal, length(c_name) + 28 AS n_cipher_bytes FROM customer",
)
def policy_encrypt_roundtrip(spark, d):
    """Encrypt a text and a number column and read them back; cipher text is vector, text and tag."""
    policies = [Policy("c_name", "encrypt", "demo-key"), Policy("c_acctbal", "encrypt", "demo-key")]
    customer = _customer(spark, d)
    hidden = protect.protect(customer, policies, keys=_KEYS)
    key = protect.key_column(customer, _KEYS["demo-key"])
    return hidden.select(
        "c_custkey",
        protect.decrypted("c_name", key).alias("c_name"),
        protect.decrypted("c_acctbal", key, "double").alias("c_acctbal"),
        F.length("c_name").cast("bigint").alias("n_cipher_bytes"),
    )


@query(
    "policy_apply_all",
    """SELECT c_custkey, sha256(c_name) AS c_name, c_acctbal, repeat('*', length(c_mktsegment)) AS c_mktsegment
       FROM customer""",
)
def policy_apply_all(spark, d):
    """Policies of one entity at silver; the one that starts at gold does not apply yet."""
    policies = [
        Policy("c_name", "hash", classification="pii", start_layer="bronze"),
        Policy("c_mktsegment", "mask"),
        Policy("c_acctbal", "redact", start_layer="gold"),
        Policy("c_custkey", classification="internal"),
    ]
    return protect.protect(_customer(spark, d), policies, "silver")
