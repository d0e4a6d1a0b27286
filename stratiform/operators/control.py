"""Control tables in bulk: rules, policies, watermarks, reprocess requests, audit."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.operators.dedupe import environment_rank, latest_per_key, preferred_row
from stratiform.operators.keyed import append, update_where, upsert

# Request states and the moves between them.
TRANSITIONS = {
    "submitted": ("approved",),
    "approved": ("executing",),
    "executing": ("completed", "failed"),
}
ACTIVE_STATES = ("approved", "executing")
BEGINNING = "1900-01-01 00:00:00"

# Defaults of a flattened rule.
RULE_DEFAULTS = {
    "layer": "silver",
    "rule_type": "expectation",
    "enforcement_method": "external_library",
    "action_on_failure": "warn",
    "severity": "medium",
    "is_default": False,
    "is_active": True,
}


def active(df: DataFrame, condition: Column | None = None, flag: str = "is_active") -> DataFrame:
    """Active rows of a control table."""
    kept = df.filter(F.col(flag))
    return kept if condition is None else kept.filter(condition)


def is_global(column: str = "entity_key") -> Column:
    """Rows that belong to no entity: the key is NULL or empty."""
    return F.coalesce(F.col(column), F.lit("")) == ""


def entities_with_config(entities: DataFrame, configs: DataFrame, environment: str, key: str = "entity_key") -> DataFrame:
    """Every entity with its load configuration for the environment, or the one for 'all'; one join."""
    known = configs.filter(F.col("environment").isin(environment, "all"))
    effective = preferred_row(known, [key], environment_rank("environment", environment))
    return entities.join(effective, key, "left")


def rules_for(rules: DataFrame, entity: str, layer: str, include_defaults: bool = True) -> DataFrame:
    """Rules of one entity at a layer, then the global defaults.

    A bag union: a default that equals an entity rule stays beside it.
    """
    live = active(rules).filter(F.col("layer") == layer)
    own = live.filter(F.col("entity_key") == entity)
    return own.unionByName(live.filter(is_global() & F.col("is_default"))) if include_defaults else own


def rules_for_all(rules: DataFrame, entities: DataFrame, layer: str) -> DataFrame:
    """``rules_for`` in bulk: own rules by key, and the few global defaults unfolded beside each entity."""
    live = active(rules).filter(F.col("layer") == layer)
    columns = [c for c in rules.columns if c != "entity_key"]
    own = live.filter(~is_global()).join(entities.select("entity_key"), "entity_key", "left_semi")
    defaults = live.filter(is_global() & F.col("is_default")).agg(F.collect_list(F.struct(*columns))).scalar()
    shared = entities.select("entity_key", F.inline(defaults))
    return own.select("entity_key", *columns).unionByName(shared)


def policies_for(policies: DataFrame, entity: str) -> DataFrame:
    return active(policies, F.col("entity_key") == entity)


def flatten_rules(documents: DataFrame, rules: str = "rules") -> DataFrame:
    """One row per rule of each document, with defaults filled in and a derived ``rule_id``.

    A rule's own layer goes before its document's layer, and that before the default.
    """
    fields = {f.name for f in documents.schema[rules].dataType.elementType}
    parent_layer = F.col("_layer") if "layer" in documents.columns else F.lit(None).cast("string")
    kept = documents.select(
        "entity_key",
        *([F.col("layer").alias("_layer")] if "layer" in documents.columns else []),
        F.explode(rules).alias("r"),
    )

    def own(name: str, dtype: str = "string") -> Column:
        return F.col(f"r.{name}") if name in fields else F.lit(None).cast(dtype)

    defaulted = {
        name: F.coalesce(own(name, "boolean" if isinstance(d, bool) else "string"), F.lit(d))
        for name, d in RULE_DEFAULTS.items()
    }
    defaulted["layer"] = F.coalesce(own("layer"), parent_layer, F.lit(RULE_DEFAULTS["layer"]))
    owner = F.when(is_global(), "global").otherwise(F.col("entity_key"))
    return kept.select(
        F.concat_ws("_", owner, defaulted["layer"], F.col("r.rule_name")).alias("rule_id"),
        "entity_key",
        F.col("r.rule_name").alias("rule_name"),
        own("expression").alias("expression"),
        own("library_reference").alias("library_reference"),
        *[c.alias(n) for n, c in defaulted.items()],
    )


def contract_rows(documents: DataFrame) -> DataFrame:
    """Key a contract document by entity and version; the version is 1 when it names none."""
    version = F.coalesce(F.get_json_object("contract_json", "$.version").cast("int"), F.lit(1))
    return documents.select(
        F.concat(F.col("entity_key"), F.lit("_v"), version).alias("contract_id"),
        "entity_key",
        version.alias("version"),
        "contract_json",
    )


# Watermark state: entity_key, current_watermark, last_row_count, last_successful_run_id,
# last_successful_ts, is_reprocessing, reprocess_request_id, updated_ts and, for watermarks of any
# type, current_mark.


def watermarks(state: DataFrame, entities: DataFrame) -> DataFrame:
    """State of every entity; an entity without state has no watermark and is not reprocessing."""
    return entities.select("entity_key").join(state, "entity_key", "left").withColumn(
        "is_reprocessing", F.coalesce("is_reprocessing", F.lit(False))
    )


def load_result(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """New watermark and row count of a load, per group."""
    return df.groupBy(*by).agg(F.max(column).alias("current_watermark"), F.count("*").alias("last_row_count"))


def advance(state: DataFrame, results: DataFrame, run_id: str, as_of: Column | None = None) -> DataFrame:
    """Record successful loads (entity_key, current_watermark, last_row_count) and clear reprocess flags.

    A watermark never moves back, except that a finished reprocess may leave it where it ended.
    ``current_mark`` (see ``functions.marks``) moves along if state and results have it.
    """
    now = F.current_timestamp() if as_of is None else as_of
    held = [c for c in ("current_watermark", "current_mark") if c in state.columns and c in results.columns]
    before = state.select(
        "entity_key", *[F.col(c).alias(f"_old_{c}") for c in held], F.col("is_reprocessing").alias("_again")
    )
    moved = results.join(before, "entity_key", "left").select(
        "entity_key",
        *[
            F.when(F.col("_again"), F.coalesce(c, f"_old_{c}")).otherwise(F.greatest(c, f"_old_{c}")).alias(c)
            for c in held
        ],
        "last_row_count",
        F.lit(run_id).alias("last_successful_run_id"),
        now.alias("last_successful_ts"),
        F.lit(False).alias("is_reprocessing"),
        F.lit(None).cast("string").alias("reprocess_request_id"),
        now.alias("updated_ts"),
    )
    return upsert(state, moved, ["entity_key"])


def rewind(state: DataFrame, requests: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Set requested entities (entity_key, request_id, from_watermark) back and flag them as reprocessing.

    A start that is no time, as that of an entity with another kind of watermark, goes back to the
    beginning; a mark is forgotten until the run has set it again.
    """
    now = F.current_timestamp() if as_of is None else as_of
    dtype = state.schema["current_watermark"].dataType
    source = requests.select(
        "entity_key",
        F.coalesce(F.col("from_watermark").try_cast(dtype), F.lit(BEGINNING).cast(dtype)).alias("current_watermark"),
        *([F.lit(None).cast("string").alias("current_mark")] if "current_mark" in state.columns else []),
        F.lit(True).alias("is_reprocessing"),
        F.col("request_id").alias("reprocess_request_id"),
        now.alias("updated_ts"),
    )
    return upsert(state, source, ["entity_key"])


def clear_flags(state: DataFrame, entities: Sequence[str], as_of: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return update_where(
        state,
        F.col("entity_key").isin(list(entities)),
        {"is_reprocessing": F.lit(False), "reprocess_request_id": F.lit(None), "updated_ts": now},
    )


def active_requests(requests: DataFrame) -> DataFrame:
    """Newest approved or executing request of every entity it names."""
    live = requests.filter(F.col("status").isin(*ACTIVE_STATES))
    each = live.withColumn("entity_key", F.explode("requested_entities")).drop("requested_entities")
    return latest_per_key(each, ["entity_key"], ["created_ts", "request_id"], tiebreak=[])


def requests_naming(requests: DataFrame, entity: str) -> DataFrame:
    """Live requests that name one entity."""
    named = F.array_contains("requested_entities", entity)
    return requests.filter(named & F.col("status").isin(*ACTIVE_STATES))


def queue_pick(requests: DataFrame, limit: int = 10) -> DataFrame:
    """The oldest approved requests; the id breaks ties."""
    return requests.filter(F.col("status") == "approved").orderBy("created_ts", "request_id").limit(limit)


def top_recent(df: DataFrame, times: Sequence[str], tiebreak: str, limit: int = 20) -> DataFrame:
    """Most recent rows by the first time that is set."""
    return df.orderBy(F.coalesce(*times).desc(), F.col(tiebreak)).limit(limit)


def transition(requests: DataFrame, changes: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Move requests (changes: request_id, to_status, run_id, summary) along their lifecycle.

    Only completion stamps ``executed_at``. A move the lifecycle does not know fails the job.
    """
    now = F.current_timestamp() if as_of is None else as_of
    moves = F.create_map(
        *[x for s, nexts in TRANSITIONS.items() for x in (F.lit(s), F.array(*[F.lit(n) for n in nexts]))]
    )
    moving = F.col("to_status").isNotNull()
    legal = F.coalesce(F.array_contains(moves[F.col("status")], F.col("to_status")), F.lit(False))
    abort = F.raise_error(F.concat_ws(" ", F.lit("illegal move"), "status", F.lit("to"), "to_status"))
    joined = requests.join(changes.select("request_id", "to_status", "run_id", "summary"), "request_id", "left")
    status = F.when(moving & ~legal, abort).when(moving, F.col("to_status")).otherwise(F.col("status"))
    sets: Mapping[str, Column] = {
        "status": status,
        "updated_ts": F.when(moving, now).otherwise(F.col("updated_ts")),
        "executed_at": F.when(F.col("to_status") == "completed", now).otherwise(F.col("executed_at")),
        "execution_run_id": F.when(moving, F.coalesce("run_id", "execution_run_id")).otherwise(
            F.col("execution_run_id")
        ),
        "result_summary": F.when(moving, F.coalesce("summary", "result_summary")).otherwise(F.col("result_summary")),
    }
    return joined.select(*[sets[c].alias(c) if c in sets else F.col(c) for c in requests.columns])


# Audit: deployment_id, status, started_ts, completed_ts, tables_applied, error_details.


def open_audit(audit: DataFrame, starts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add running entries with no tables applied yet."""
    now = F.current_timestamp() if as_of is None else as_of
    return append(
        audit,
        starts.withColumns(
            {"status": F.lit("running"), "started_ts": now, "tables_applied": F.array().cast("array<string>")}
        ),
    )


def close_audit(
    audit: DataFrame,
    deployment_id: str,
    tables: Sequence[str],
    error: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    names = F.array(*[F.lit(t) for t in tables]).cast("array<string>")
    sets = {
        "status": F.lit("success" if error is None else "failed"),
        "completed_ts": now,
        "tables_applied": names,
    }
    if error is not None:
        sets["error_details"] = F.lit(error)
    return update_where(audit, F.col("deployment_id") == deployment_id, sets)
