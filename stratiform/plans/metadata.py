"""From control tables to declarations: what the rows about entities, rules, policies and contracts say, as ``Entity`` objects that jobs run.

Control tables are read in bulk, never entity by entity: Spark picks effective configurations, live
rules and newest contracts and sends one row for each entity, which holds all that belongs to it.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.operators import control
from stratiform.operators.dedupe import latest_version
from stratiform.operators.keyed import widened
from stratiform.spec import Contract, Entity, Policy, Rule

# Columns of the control tables that are read; missing ones are NULL.
ENTITIES = (
    "entity_key string, subject_area_key string, source_key string, primary_key_columns string, watermark_column string, "
    "restricted boolean, is_active boolean"
)
CONFIGS = "entity_key string, environment string, custom_extract_params string, auto_loader_options string, bronze_schema_evolution_mode string"
RULES = (
    "rule_id string, entity_key string, layer string, rule_name string, enforcement_method string, expression string, library_reference string, "
    "parameters string, action_on_failure string, severity string, is_default boolean, is_active boolean"
)
POLICIES = (
    "entity_key string, column_name string, policy_type string, encryption_key_vault_ref string, apply_starting_layer string, classification string, "
    "is_active boolean"
)
CONTRACTS = "entity_key string, version int, contract_json string"

# Methods of enforcement, and library rules with their checks.
NATIVE, LIBRARY = ("native_lakeflow", "both"), ("external_library", "both")
LIBRARY_CHECKS: dict[str, str] = {
    "best_practices.not_null": "not_null",
    "best_practices.freshness_24h": "freshness",
    "best_practices.no_future_dates": "no_future",
    "best_practices.unique_business_key": "unique",
}
DEFAULT_WATERMARK = "_source_extract_ts"

_ANY_COLUMN = re.compile(r"\s*col\s+is\s+not\s+null\s*", re.IGNORECASE)


@dataclass(frozen=True)
class ControlTables:
    """The control tables as DataFrames; those that a lake lacks may be left out."""

    entities: DataFrame
    configs: DataFrame | None = None
    rules: DataFrame | None = None
    policies: DataFrame | None = None
    contracts: DataFrame | None = None


@dataclass(frozen=True)
class Declared:
    """An entity and its effective load configuration: environment, JSON fields read."""

    entity: Entity
    subject: str | None = None
    config: Mapping[str, Any] = field(default_factory=dict)


def parsed(value: Any) -> Any:
    """A JSON object or array as its value; other text as it is, blank text as None."""
    if not isinstance(value, str):
        return value
    text = value.strip()
    if not text:
        return None
    if text[0] not in "{[":
        return value
    try:
        return json.loads(text)
    except ValueError:
        return value


def _names(value: Any) -> tuple[str, ...]:
    """Column names from a JSON array, an array, or text with commas."""
    listed = parsed(value)
    if isinstance(listed, str):
        listed = listed.split(",")
    return tuple(n for n in (str(x).strip() for x in listed or ()) if n)


def _library(row: Row, keys: Sequence[str]) -> tuple[str, dict[str, Any]] | None:
    """The check of a library rule with its parameters; None for a name the library does not have."""
    check = LIBRARY_CHECKS.get(row["library_reference"])
    params = dict(parsed(row["parameters"]) or {})
    if check == "not_null":
        return ("key_present", {"keys": list(keys)}) if "column" not in params else (check, {"column": params["column"]})
    if check == "freshness":
        return check, {k: params[k] for k in ("column", "max_age_hours") if k in params} | ({"column": params["timestamp_col"]} if "timestamp_col" in params else {})
    if check == "no_future":
        return check, {"column": params.get("date_col", params.get("column", "date"))}
    if check == "unique":
        return check, {"columns": _names(params.get("key_columns")) or tuple(keys)}
    return None


def compiled_rules(row: Row, keys: Sequence[str], strict: bool = True) -> list[Rule]:
    """The rules of one row: its expression where the method is native, its library check where it is the library, and both for ``both``.

    An expression fails by default and a library check warns. A library check without a column means the key, and so does the
    placeholder ``col`` of a default rule. The second rule of a row is named after the first. A library name nobody knows is an
    error, or nothing if not ``strict``.
    """
    found, name, severity = [], row["rule_name"], row["severity"] or "medium"
    method, action = row["enforcement_method"], row["action_on_failure"]
    if method in NATIVE and row["expression"]:
        text = row["expression"]
        if _ANY_COLUMN.fullmatch(text) and keys:
            text = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
        found.append(Rule(name, text, action=action or "fail", severity=severity, layer=row["layer"]))
    if method in LIBRARY and row["library_reference"]:
        known = _library(row, keys)
        if known:
            check, params = known
            found.append(Rule(f"{name}.library" if found else name, check=check, action=action or "warn", params=params, severity=severity, layer=row["layer"]))
        elif strict:
            raise ValueError(f"rule {name!r} names an unknown library rule {row['library_reference']!r}")
    return found


def _with(df: DataFrame | None, schema: str, beside: DataFrame) -> DataFrame:
    """The columns of ``schema``, nested ones as JSON; a table or a column that is missing is empty or NULL."""
    wanted = T.StructType.fromDDL(schema)
    if df is None:
        return beside.sparkSession.createDataFrame([], wanted)
    nested = {f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    full = widened(df, wanted)
    return full.select(*[(F.to_json(f.name) if f.name in nested else F.col(f.name).cast(f.dataType)).alias(f.name) for f in wanted])


def _listed(df: DataFrame, name: str, order: Sequence[Column | str]) -> DataFrame:
    """All rows of an entity as one array, in order."""
    rest = [c for c in df.columns if c != "entity_key"]
    one = F.struct(*[F.col(o).alias(f"_o{n}") if isinstance(o, str) else o.alias(f"_o{n}") for n, o in enumerate(order)], *rest)
    return df.groupBy("entity_key").agg(F.array_sort(F.collect_list(one)).alias(name))


def described(tables: ControlTables, environment: str = "all", layer: str = "silver") -> DataFrame:
    """One row for each active entity: its own columns, ``config`` (preferred environment), ``rules`` (own ones, then the defaults), ``policies``, ``contract_json`` (newest version)."""
    entities = control.active(_with(tables.entities, ENTITIES, tables.entities))
    configs, rules = (_with(t, s, tables.entities) for t, s in ((tables.configs, CONFIGS), (tables.rules, RULES)))
    policies, contracts = (_with(t, s, tables.entities) for t, s in ((tables.policies, POLICIES), (tables.contracts, CONTRACTS)))
    config_names = [c for c in configs.columns if c != "entity_key"]
    chosen = control.entities_with_config(entities.select("entity_key"), configs, environment).select("entity_key", F.struct(*config_names).alias("config"))
    live = control.rules_for_all(rules, entities, layer)
    newest = latest_version(contracts.filter(F.col("contract_json").isNotNull()), ["entity_key"]).select("entity_key", "contract_json")
    return (
        entities.join(chosen, "entity_key", "left")
        .join(_listed(live, "rules", [F.coalesce("is_default", F.lit(False)), "rule_id", "rule_name"]), "entity_key", "left")
        .join(_listed(control.active(policies), "policies", ["column_name"]), "entity_key", "left")
        .join(newest, "entity_key", "left")
    )


def _entity(row: Row, strict: bool) -> Entity:
    contract = Contract.from_json(row["contract_json"]) if row["contract_json"] else None
    keys = _names(row["primary_key_columns"]) or tuple(contract.keys if contract else ())
    if not keys:
        raise ValueError(f"entity {row['entity_key']!r} has no primary key")
    rules = [rule for r in row["rules"] or () for rule in compiled_rules(r, keys, strict)]
    own: dict[str, Rule] = {}
    for rule in rules:  # of equal names the entity's own rule, which comes first, stays
        own.setdefault(rule.name, rule)
    policies = [
        Policy(p["column_name"], p["policy_type"] or "tag_only", p["encryption_key_vault_ref"], p["classification"], p["apply_starting_layer"] or "silver")
        for p in row["policies"] or ()
    ]
    return Entity(
        row["entity_key"], keys, row["watermark_column"] or DEFAULT_WATERMARK, row["source_key"] or "unknown", bool(row["restricted"]),
        tuple(own.values()), tuple(policies), contract,
    )


def declared(
    tables: ControlTables, environment: str = "all", layer: str = "silver", subject: str | None = None, keys: Iterable[str] = (), strict: bool = True
) -> list[Declared]:
    """Active entities of the control tables, optionally of one subject or some keys, by key."""
    rows, wanted = described(tables, environment, layer), list(keys)
    if subject is not None:
        rows = rows.filter(F.col("subject_area_key") == subject)
    if wanted:
        rows = rows.filter(F.col("entity_key").isin(wanted))
    found = sorted(rows.collect(), key=lambda r: r["entity_key"])
    missing = sorted(set(wanted) - {r["entity_key"] for r in found})
    if missing:
        raise ValueError(f"no active entities: {missing}")
    return [
        Declared(_entity(r, strict), r["subject_area_key"], {k: parsed(v) for k, v in (r["config"].asDict() if r["config"] else {}).items() if v is not None})
        for r in found
    ]


def entities(tables: ControlTables, environment: str = "all", **picked: Any) -> list[Entity]:
    """The entities alone, to be run by ``refresh.refresh_all``."""
    return [d.entity for d in declared(tables, environment, **picked)]
