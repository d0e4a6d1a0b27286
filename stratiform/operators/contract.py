"""Contracts: conform, prune, check, and contract documents held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.operators.dedupe import latest_version
from stratiform.spec import Contract

# Shape of a contract document; columns sit at the top or under ``schema``.
_COLUMN = "struct<name:string,type:string,nullable:boolean,primary_key:boolean>"
_DOCUMENT = f"schema struct<columns:array<{_COLUMN}>>, columns array<{_COLUMN}>"


def conform(df: DataFrame, contract: Contract, cast: bool = False) -> DataFrame:
    """Add missing contract columns as typed NULLs; ``cast`` also brings the others to contract types."""
    wanted = {c.name: c.type for c in contract.columns}
    present = [
        F.col(n).cast(wanted[n]).alias(n) if cast and n in wanted else F.col(n) for n in df.columns
    ]
    missing = [F.lit(None).cast(t).alias(n) for n, t in wanted.items() if n not in df.columns]
    return df.select(*present, *missing)


def prune(df: DataFrame, contract: Contract) -> DataFrame:
    """Keep contract columns and technical columns, which start with an underscore."""
    keep = set(contract.names)
    return df.select(*[c for c in df.columns if c in keep or c.startswith("_")])


def preserve_dropped(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored and incoming rows together; a column missing on either side is NULL there."""
    return stored.unionByName(incoming, allowMissingColumns=True)


def check(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract violations as (column_name, issue, n_rows): schema differences and one pass over the rows."""
    actual = {f.name: f.dataType for f in df.schema}
    found, counters, issues = [], [F.count(F.lit(1)).alias("_n")], []
    for c in contract.columns:
        if c.name not in actual:
            found.append((c.name, "missing_column"))
            continue
        if actual[c.name] != c.type:
            found.append((c.name, "wrong_type"))
        if not c.nullable or c.primary_key:
            counters.append(F.count_if(F.col(c.name).isNull()).alias(f"_c{len(issues)}"))
            issues.append((c.name, "unexpected_null"))
        if c.allowed_values:
            outside = ~F.col(c.name).isin(list(c.allowed_values))
            counters.append(F.count_if(outside).alias(f"_c{len(issues)}"))
            issues.append((c.name, "value_not_allowed"))
    found += [(name, "not_in_contract") for name in actual if name not in contract.names and not name.startswith("_")]

    lines = [
        F.struct(F.lit(n).alias("column_name"), F.lit(i).alias("issue"), F.col("_n").alias("n_rows")) for n, i in found
    ] + [
        F.struct(F.lit(n).alias("column_name"), F.lit(i).alias("issue"), F.col(f"_c{k}").alias("n_rows"))
        for k, (n, i) in enumerate(issues)
    ]
    empty = F.array().cast("array<struct<column_name:string,issue:string,n_rows:bigint>>")
    listed = F.array(*lines) if lines else empty
    violated = F.filter(listed, lambda x: (x["n_rows"] > 0) | x["issue"].isin("missing_column", "wrong_type"))
    return df.agg(*counters).select(F.inline(violated))


def columns_from_json(contracts: DataFrame, key: str = "entity_key", document: str = "contract_json") -> DataFrame:
    """Columns of the newest contract per entity, one row each in contract order."""
    newest = latest_version(contracts, [key])
    parsed = newest.select(key, "version", F.from_json(document, _DOCUMENT).alias("doc"))
    columns = F.coalesce("doc.schema.columns", "doc.columns")
    return parsed.select(key, "version", F.posexplode(columns).alias("position", "c")).select(
        key, "version", "position", F.col("c.name").alias("column_name"), F.col("c.type").alias("column_type")
    )
