"""Silver refresh: slice, key check, dedupe, conform, rules, protection, upsert, new watermark."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Any, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions import lineage, marks
from stratiform.functions.checks import all_not_null
from stratiform.functions.protect import protect
from stratiform.operators import contract, quality, slices
from stratiform.operators.dedupe import latest_per_key
from stratiform.operators.keyed import not_older, upsert
from stratiform.session import discard, materialize, scanned_bytes, scratch_dir, size_shuffles
from stratiform.sources import tables
from stratiform.sources.commits import COMMIT, GENERATION
from stratiform.spec import Entity, Request, Rule


@dataclass(frozen=True)
class Refresh:
    """Lazy results of a refresh; ``silver`` is the whole table after the upsert."""

    silver: DataFrame
    changed: DataFrame
    quarantine: DataFrame
    metrics: DataFrame
    watermark: DataFrame


def refined(piece: DataFrame, entity: Entity) -> tuple[DataFrame, list[Rule], list[str]]:
    """Rows with a complete key, conformed to the contract, latest per key; the rules as they are to be evaluated, and their helper columns.

    Rules that look at other rows, such as a unique key, see the rows before the dedupe, which would hide what they ask for.
    """
    keys = list(entity.primary_key)
    missing = [k for k in keys if k not in piece.columns]
    if missing:
        raise ValueError(f"key columns missing from {entity.key}: {missing}")
    by = [entity.watermark_column] if entity.watermark_column in piece.columns else []
    arrived = [c for c in (GENERATION, COMMIT) if c in piece.columns]  # of equal times, the later commit is newer
    rest = [c for c in piece.columns if c not in (*keys, *by, *arrived)]
    keyed_rows = piece.filter(all_not_null(keys))
    conformed = contract.conform(keyed_rows, entity.contract) if entity.contract else keyed_rows
    rows, rules, early = quality.with_helpers(conformed, entity.rules, keys, quality.looks_at_other_rows)
    latest = latest_per_key(rows, keys, [*by, *arrived], rest).drop(*arrived)
    rows, rules, late = quality.with_helpers(latest, rules, keys)
    return rows, rules, [*early, *late]


def _evaluated(
    rows: DataFrame,
    entity: Entity,
    rules: Sequence[Rule],
    helpers: Sequence[str],
    keys: Mapping[str, str] | None,
    as_of: Column | None,
) -> DataFrame:
    """Rows with their rule results. Rules see clear values; everything kept is protected."""
    results = quality.with_results(rows, rules, entity.primary_key, as_of).drop(*helpers)
    return lineage.stamp(protect(results, entity.policies, "silver", keys), lineage.SILVER_TS, as_of)


def silver_refresh(
    bronze: DataFrame,
    entity: Entity,
    silver: DataFrame | None = None,
    last: Any = None,
    request: Request | None = None,
    key_set: DataFrame | None = None,
    encryption_keys: Mapping[str, str] | None = None,
    as_of: Column | None = None,
    stage: bool = False,
) -> Refresh:
    """The new watermark is that of the slice, not of the clean rows, so rejected rows are not read again.

    ``stage`` writes the evaluated slice first; clean rows, quarantine and upsert then share it.
    """
    keys = list(entity.primary_key)
    piece = slices.for_run(bronze, entity.watermark_column, last, request, key_set, keys)
    rows, rules, helpers = refined(piece, entity)
    passed = quality.gate(rows, rules, keys, as_of)
    results = _evaluated(passed, entity, rules, helpers, encryption_keys, as_of)
    if stage:
        results = materialize(results, "silver-stage")
    changed = _current_only(quality.clean_rows(results), silver, entity, request)
    mark = F.max(entity.watermark_column) if entity.watermark_column in piece.columns else F.lit(None).cast("string")
    return Refresh(
        silver=changed if silver is None else upsert(silver, changed, keys, unique=True, widen=True),
        changed=changed,
        quarantine=quality.quarantined_rows(results),
        metrics=quality.metrics(rows, rules, keys, as_of),
        watermark=piece.agg(mark.alias("current_watermark"), F.count("*").alias("last_row_count")),
    )


class QualityFailure(RuntimeError):
    """A rule with action ``fail`` found violations; nothing was published."""


def _current_only(
    changed: DataFrame, silver: DataFrame | None, entity: Entity, request: Request | None, by_arrival: bool = False
) -> DataFrame:
    """A reprocessed window, and what has arrived, may hold rows older than what silver has for the key; those stay out."""
    mark = entity.watermark_column
    old_rows = by_arrival if request is None else request.mode == "window"
    if silver is None or not old_rows or mark not in silver.columns or mark not in changed.columns:
        return changed
    return not_older(changed, silver, entity.primary_key, mark)


def _merge(spark: SparkSession, changed: DataFrame, entity: Entity, base: str) -> None:
    """Merge into silver; columns that are new stay, columns that vanished keep their values."""
    keys = list(entity.primary_key)
    if entity.buckets or entity.partition:
        cut = entity.partition or "_bucket"
        rows = changed if entity.partition else changed.withColumn(cut, tables.key_bucket(keys, entity.buckets))
        tables.upsert_partitions(spark, base, rows, keys, cut, unique=True, widen=True)
        return
    before = tables.current(spark, base)
    tables.publish(changed if before is None else upsert(before, changed, keys, unique=True, widen=True), base)


def read_silver(spark: SparkSession, entity: Entity, base: str) -> DataFrame | None:
    """The silver table as last published; None before the first run."""
    if not (entity.buckets or entity.partition):
        return tables.current(spark, base)
    return tables.read_partitioned(spark, base).drop("_bucket") if tables.exists(spark, base) else None


def run_silver(
    spark: SparkSession,
    bronze: DataFrame,
    entity: Entity,
    base: str,
    quarantine_base: str,
    last: Any = None,
    request: Request | None = None,
    key_set: DataFrame | None = None,
    encryption_keys: Mapping[str, str] | None = None,
    as_of: Column | None = None,
    by_arrival: bool = False,
) -> dict[str, Any]:
    """Run a refresh as a job: stage the evaluated rows once, gate, publish, report.

    ``by_arrival`` takes all of ``bronze``, which then holds the new commits only, whatever the times in
    it: rows before the last watermark, at it and without a time are counted and compared
    with silver key by key. A key keeps its newest row, of equal times the one that arrived last.

    Quarantine gets one version per run; silver keeps its newest two. The stage goes even if the gate fails. Violations are counted in the tasks that write the staged table, so the slice is evaluated
    once and every later step starts from files that survive lost executors. What was read is
    counted by a scan of key and watermark columns: counters ahead of a shuffle could count a
    recomputed task twice. The returned counts add up: rows read = key missing + duplicates +
    quarantined + dropped + clean.
    """
    keys = list(entity.primary_key)
    by_arrival = by_arrival and request is None
    piece = bronze if by_arrival else slices.for_run(bronze, entity.watermark_column, last, request, key_set, keys)
    size_shuffles(spark, scanned_bytes(piece))
    how = slices.arrivals(piece, entity.watermark_column, last) if by_arrival else {}
    read = piece.agg(
        F.count("*").alias("n_read"),
        F.count_if(~all_not_null(keys)).alias("n_key_missing"),
        *[c.alias(n) for n, c in how.items()],
        *_newest(piece, entity.watermark_column),
    ).first()
    prepared, rules, helpers = refined(piece, entity)
    rows, violations = quality.observe(prepared, rules, keys, as_of)
    outcomes = Observation()
    clean, dropped = F.size(quality.FAILED) == 0, F.col(quality.DROPPED)
    stage = scratch_dir(spark, "silver-stage")
    _evaluated(rows, entity, rules, helpers, encryption_keys, as_of).observe(
        outcomes,
        F.count_if(clean).alias("n_clean"),
        F.count_if(dropped).alias("n_dropped"),
        F.count_if(~clean & ~dropped).alias("n_quarantined"),
    ).write.parquet(stage)

    failed = quality.observed_failures(entity.rules, violations)
    blocked = {r.name: failed[r.name] for r in entity.rules if r.effect == "fail" and failed[r.name]}
    try:
        if blocked:
            raise QualityFailure(f"{entity.key}: {blocked}")
        staged = spark.read.parquet(stage)
        changed = _current_only(quality.clean_rows(staged), read_silver(spark, entity, base), entity, request, by_arrival)
        _merge(spark, changed, entity, base)
        tables.publish(quality.quarantined_rows(staged), quarantine_base)
    finally:
        discard(spark, stage)
    if not (entity.buckets or entity.partition):
        tables.expire(spark, base)
    counts = {**read.asDict(), **outcomes.get}
    counts["n_duplicates"] = counts["n_read"] - counts["n_key_missing"] - sum(
        counts[k] for k in ("n_clean", "n_dropped", "n_quarantined")
    )
    mark, shown = counts.pop("mark"), counts.pop("shown")
    return {"counts": counts, "violations": failed, "watermark": _shown(shown), "mark": mark}


def _newest(piece: DataFrame, column: str) -> list[Column]:
    """The largest watermark as its mark and to be shown; times leave Spark as text, so no zone of the driver moves them."""
    if column not in piece.columns:
        return [F.lit(None).cast("string").alias("mark"), F.lit(None).cast("string").alias("shown")]
    dtype, top = piece.schema[column].dataType, F.max(column)
    zoned = isinstance(dtype, (T.TimestampType, T.TimestampNTZType))
    return [marks.mark(top, dtype).alias("mark"), (top.cast("timestamp_ntz").cast("string") if zoned else top).alias("shown")]


def _shown(value: Any) -> Any:
    """A time as a datetime if Python has it."""
    try:
        return datetime.fromisoformat(value) if isinstance(value, str) else value
    except ValueError:
        return value
