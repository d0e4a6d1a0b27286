"""Declarations: what an entity, rule, policy, contract and reprocess request look like."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any, Mapping

from pyspark.sql import types as T

# The vocabulary of the declarations.
LAYERS = ("bronze", "silver", "gold")
LAYER_SCHEMAS = ("bronze", "silver", "gold", "bronze_restricted", "silver_restricted", "gold_restricted")
ACTIONS = ("fail", "warn", "drop", "quarantine", "log_only")
POLICY_KINDS = ("encrypt", "hash", "mask", "redact", "tag_only")
REPROCESS_MODES = ("full", "window", "keys")


@dataclass(frozen=True)
class Rule:
    """A quality rule: a SQL expression, or a named check with parameters.

    An expression rule fails the load by default and a named check only warns. A missing or
    unknown action warns too.
    """

    name: str
    expression: str | None = None
    check: str | None = None
    action: str | None = None
    params: Mapping[str, Any] = field(default_factory=dict)
    severity: str = "medium"
    layer: str = "silver"

    def __post_init__(self) -> None:
        if (self.expression is None) == (self.check is None):
            raise ValueError(f"rule {self.name!r} needs either an expression or a check")

    @property
    def effect(self) -> str:
        if self.action is None:
            return "fail" if self.expression is not None else "warn"
        return self.action if self.action in ACTIONS else "warn"


@dataclass(frozen=True)
class Policy:
    """Protection of one column from a layer onwards."""

    column: str
    kind: str = "tag_only"
    key_ref: str | None = None
    classification: str | None = None
    start_layer: str = "silver"

    def __post_init__(self) -> None:
        if self.kind not in POLICY_KINDS:
            raise ValueError(f"unknown policy kind {self.kind!r} for column {self.column!r}")
        if self.start_layer not in LAYERS:
            raise ValueError(f"unknown layer {self.start_layer!r} for column {self.column!r}")

    def applies_at(self, layer: str) -> bool:
        return LAYERS.index(layer) >= LAYERS.index(self.start_layer)


@dataclass(frozen=True)
class Column_:
    """One contract column."""

    name: str
    type: T.DataType
    nullable: bool = True
    primary_key: bool = False
    allowed_values: tuple = ()


# Contract type names. Others are read as Spark type text.
CONTRACT_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "text": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "datetime": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal": T.DecimalType(18, 2),
}


@dataclass(frozen=True)
class Contract:
    entity: str
    columns: tuple[Column_, ...]
    version: int = 1

    @classmethod
    def from_json(cls, document: str) -> "Contract":
        """Read a contract document; columns sit at the top or under ``schema``."""
        doc = json.loads(document)
        listed = (doc.get("schema") or {}).get("columns") or doc.get("columns") or []
        columns = []
        for item in listed:
            name = str(item.get("type", "string")).lower()
            columns.append(
                Column_(
                    item["name"],
                    CONTRACT_TYPES[name] if name in CONTRACT_TYPES else T.DataType.fromDDL(name),
                    bool(item.get("nullable", True)),
                    bool(item.get("primary_key", False)),
                    tuple(item.get("allowed_values") or ()),
                )
            )
        return cls(doc.get("entity_key", ""), tuple(columns), int(doc.get("version", 1)))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.primary_key]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])


@dataclass(frozen=True)
class Entity:
    """A logical table and how it is refined."""

    key: str
    primary_key: tuple[str, ...]
    watermark_column: str = "_source_extract_ts"
    source_system: str = "unknown"
    restricted: bool = False
    rules: tuple[Rule, ...] = ()
    policies: tuple[Policy, ...] = ()
    contract: Contract | None = None
    # How silver is cut for merging: a column that depends on the key, or a number of key buckets.
    partition: str | None = None
    buckets: int | None = None

    def layer_schema(self, layer: str) -> str:
        return f"{layer}_restricted" if self.restricted else layer


@dataclass(frozen=True)
class Request:
    """An approved reprocess request for one entity."""

    request_id: str
    mode: str = "full"
    from_watermark: Any = None
    to_watermark: Any = None

    def __post_init__(self) -> None:
        if self.mode not in REPROCESS_MODES:
            raise ValueError(f"unknown reprocess mode {self.mode!r}")
