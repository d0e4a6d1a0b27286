"""Entity refreshes with their state: watermark, reprocess request, silver table."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any, Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions import marks
from stratiform.functions.values import Typed
from stratiform.operators import control, keyed
from stratiform.plans.silver import run_silver
from stratiform.sources import commits, tables
from stratiform.spec import Entity, Request

STATE_SCHEMA = (
    "entity_key string, current_watermark timestamp_ntz, last_row_count bigint, last_successful_run_id string, "
    "last_successful_ts timestamp_ntz, is_reprocessing boolean, reprocess_request_id string, updated_ts timestamp_ntz, "
    "current_mark string"
)
CONSUMED_SCHEMA = "entity_key string, generation bigint, commit bigint, run_id string, updated_ts timestamp_ntz"
REQUEST_SCHEMA = (
    "request_id string, requested_entities array<string>, reprocess_mode string, from_watermark timestamp_ntz, "
    "to_watermark timestamp_ntz, status string, created_ts timestamp_ntz, updated_ts timestamp_ntz, "
    "executed_at timestamp_ntz, execution_run_id string, result_summary string"
)


@dataclass(frozen=True)
class Lake:
    """Where the tables of a lake are."""

    root: str

    @property
    def state(self) -> str:
        return f"{self.root}/control/watermark_state"

    @property
    def consumed(self) -> str:
        return f"{self.root}/control/consumed_commits"

    @property
    def requests(self) -> str:
        return f"{self.root}/control/reprocess_requests"

    def table(self, entity: Entity, layer: str) -> str:
        return f"{self.root}/{entity.layer_schema(layer)}/{entity.key}"

    def quarantine(self, entity: Entity) -> str:
        return f"{self.root}/{entity.layer_schema('silver')}/{entity.key}__quarantine"


def in_scope(entities: Iterable[Entity], restricted: bool, keys: Iterable[str] = ()) -> list[Entity]:
    """Declared entities of one scope, optionally some of them; every key may be declared once."""
    listed, wanted = list(entities), set(keys)
    repeated = sorted(k for k, n in Counter(e.key for e in listed).items() if n > 1)
    if repeated:
        raise ValueError(f"entities declared more than once: {repeated}")
    return [e for e in listed if e.restricted == restricted and (not wanted or e.key in wanted)]


def _stored(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """A control table; columns that an older version lacks are NULL."""
    known, empty = tables.current(spark, base), spark.createDataFrame([], schema)
    return empty if known is None else keyed.widened(known, empty.schema)


def _last(state: Row, dtype: T.DataType | None) -> Any:
    """Where an entity stands, as a value of its watermark's type; a state without a mark has a time or nothing."""
    if dtype is None:
        return None
    if state["current_mark"]:
        return Typed(marks.value(state["current_mark"], dtype))
    timed = isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))
    return state["current_watermark"] if timed else None


def _consumed(spark: SparkSession, lake: Lake, entity: Entity) -> commits.Position | None:
    known = _stored(spark, lake.consumed, CONSUMED_SCHEMA).filter(F.col("entity_key") == entity.key).first()
    return commits.Position(known["generation"], known["commit"]) if known else None


def _store(df: DataFrame, base: str) -> None:
    tables.publish(df, base)
    tables.expire(df.sparkSession, base, keep=10)


def _move(spark: SparkSession, lake: Lake, request_id: str, status: str, run_id: str, now: Column) -> None:
    change = spark.createDataFrame(
        [(request_id, status, run_id, None)], "request_id string, to_status string, run_id string, summary string"
    )
    _store(control.transition(_stored(spark, lake.requests, REQUEST_SCHEMA), change, now), lake.requests)


def refresh_entity(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    bronze: DataFrame | commits.Commits,
    run_id: str,
    key_set: DataFrame | None = None,
    encryption_keys: Mapping[str, str] | None = None,
    as_of: Column | None = None,
) -> dict[str, Any]:
    """Refresh one entity and then commit its watermark.

    A live reprocess request for the entity decides the slice: it is marked executing and the
    watermark goes back before the run, and it ends completed or failed with the flags cleared.
    The watermark moves only after silver is published, so a broken run is simply run again.

    Bronze given as ``Commits`` is read by arrival: the commits after the last one consumed, whatever
    the times in them, so nothing late, tied or without a time is passed over. A request reads
    the newest generation; only a full one counts as having consumed it.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of
    live = control.active_requests(_stored(spark, lake.requests, REQUEST_SCHEMA))
    found = live.filter(F.col("entity_key") == entity.key).first()
    request = None
    if found:
        request = Request(found["request_id"], found["reprocess_mode"], found["from_watermark"], found["to_watermark"])
        if found["status"] == "approved":
            _move(spark, lake, request.request_id, "executing", run_id, now)
        asked = live.filter(F.col("entity_key") == entity.key).select("entity_key", "request_id", "from_watermark")
        _store(control.rewind(_stored(spark, lake.state, STATE_SCHEMA), asked, now), lake.state)

    state = control.watermarks(
        _stored(spark, lake.state, STATE_SCHEMA), spark.createDataFrame([(entity.key,)], "entity_key string")
    ).first()
    silver = lake.table(entity, "silver")
    rows, upto = bronze, None
    if isinstance(bronze, commits.Commits):
        upto = commits.newest(spark, bronze.base)
        after = _consumed(spark, lake, entity) if request is None else upto and commits.Position(upto.generation, -1)
        rows = commits.read_after(spark, bronze.base, after, upto) if upto else None
    try:
        if rows is None:
            report = {"counts": {"n_read": 0}, "violations": {}, "watermark": None, "mark": None}
        else:
            dtype = rows.schema[entity.watermark_column].dataType if entity.watermark_column in rows.columns else None
            report = run_silver(
                spark, rows, entity, silver, lake.quarantine(entity),
                _last(state, dtype), request, key_set, encryption_keys, as_of, by_arrival=upto is not None,
            )
    except Exception:
        if request:
            _move(spark, lake, request.request_id, "failed", run_id, now)
            kept = control.clear_flags(_stored(spark, lake.state, STATE_SCHEMA), [entity.key], now)
            _store(kept, lake.state)
        raise

    shown = report["watermark"] if isinstance(report["watermark"], (date, datetime)) else None
    result = spark.createDataFrame(
        [(entity.key, shown and shown.isoformat(), report["mark"], report["counts"]["n_read"])],
        "entity_key string, current_watermark string, current_mark string, last_row_count bigint",
    ).withColumn("current_watermark", F.col("current_watermark").cast("timestamp_ntz"))
    _store(control.advance(_stored(spark, lake.state, STATE_SCHEMA), result, run_id, now), lake.state)
    if upto and (request is None or request.mode == "full"):
        seen = spark.createDataFrame([(entity.key, upto.generation, upto.commit, run_id)], "entity_key string, generation bigint, commit bigint, run_id string")
        _store(keyed.upsert(_stored(spark, lake.consumed, CONSUMED_SCHEMA), seen.withColumn("updated_ts", now), ["entity_key"]), lake.consumed)
    if request:
        _move(spark, lake, request.request_id, "completed", run_id, now)
    return report


def refresh_all(
    spark: SparkSession,
    lake: Lake,
    entities: Iterable[Entity],
    bronze_of: Callable[[Entity], DataFrame | commits.Commits],
    run_id: str,
    restricted: bool = False,
    keys: Iterable[str] = (),
    **kwargs: Any,
) -> dict[str, dict[str, Any]]:
    """Refresh the declared entities of one scope, one job after another."""
    return {
        e.key: refresh_entity(spark, lake, e, bronze_of(e), run_id, **kwargs) for e in in_scope(entities, restricted, keys)
    }
