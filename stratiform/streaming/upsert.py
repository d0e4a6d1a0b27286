"""Micro-batches merged into a keyed table.

A merge rewrites the table, or the partitions it touches, so one for each micro-batch costs batches times table.
Micro-batches are therefore written as they come, and merged together once they weigh ``OUTWEIGH`` times as much as the
table, and when the run ends. So a run rewrites the table once, and besides that a bounded multiple of what came in, however it was cut.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratiform.functions.checks import all_not_null
from stratiform.operators.dedupe import latest_per_key
from stratiform.operators.keyed import not_older, upsert
from stratiform.session import file_system, stored_bytes
from stratiform.sources import tables

# Micro-batches wait for others until they weigh so many times as much as the table.
OUTWEIGH = 4
_BATCH = "_upsert_batch"


def _waiting(base: str) -> str:
    """Where the micro-batches are that the table lacks; scans of the table pass over this name."""
    return f"{base}/_waiting"


def upsert_available(
    stream: DataFrame,
    base: str,
    checkpoint: str,
    keys: Sequence[str],
    by: Sequence[str],
    partition: str | None = None,
    keep: int = 2,
) -> StreamingQuery:
    """Merge the micro-batches, newest row per key and none without a key, into the versioned table at ``base``.

    A row older than the one held stays out, so the result does not depend on the cut into batches; of
    equal ones in several batches the last stays.

    Batches wait beside the table until they outweigh it by far, or until the run ends, and are then merged together.
    The table holds all of them when this returns, and when the stream fails too; what a lost driver has left waiting the next run merges first.

    The id of the last batch in it is the version number: a replayed batch that a complete version
    holds is passed over, any other overwrites what it has left waiting, so a restart after a lost driver does not merge twice. The table and
    the checkpoint belong together; the newest ``keep`` versions stay.

    With ``partition``, a column that depends on the key, the table at ``base`` is partitioned
    instead and each merge rewrites the partitions it touches; a replayed merge gives the same.
    """
    if keep < 2:
        raise ValueError("a replay needs the version before the last")
    spark, waiting = stream.sparkSession, _waiting(base)
    weight = {"table": 0, "waiting": 0}

    def merge(rows: DataFrame, version: int) -> None:
        order = [*by, _BATCH] if _BATCH in rows.columns else by
        newest = latest_per_key(rows, keys, order).drop(_BATCH)
        if partition:
            tables.upsert_partitions(spark, base, newest, keys, partition, unique=True, by=by)
            return
        before = tables.current(spark, base, below=version)
        if before is None:
            tables.publish(newest, base, version)
            return
        newest.persist()
        try:
            tables.publish(upsert(before, not_older(newest, before, keys, by), keys, unique=True), base, version)
        finally:
            newest.unpersist()
        tables.expire(spark, base, keep)

    def held() -> int:
        """The last batch in the versioned table."""
        known = [] if partition else tables.versions(spark, base)
        return known[-1] if known else -1

    def merge_waiting() -> None:
        left, last = tables.versions(spark, waiting), held()
        new = [n for n in left if n > last]
        if new:
            merge(spark.read.parquet(*(tables.version_path(waiting, n) for n in new)), new[-1])
        _forget(spark, waiting, left)
        last = held()
        path = tables.version_path(base, last) if last >= 0 else base
        weight.update(table=stored_bytes(spark, path) if tables.exists(spark, path) else 0, waiting=0)

    def take(batch: DataFrame, batch_id: int) -> None:
        if held() >= batch_id:
            return
        rows = batch.filter(all_not_null(keys))
        if not weight["table"]:
            merge(rows, batch_id)
            merge_waiting()
            return
        tables.publish(rows.withColumn(_BATCH, F.lit(batch_id).cast("long")), waiting, batch_id)
        weight["waiting"] += stored_bytes(spark, tables.version_path(waiting, batch_id))
        if weight["waiting"] >= OUTWEIGH * weight["table"]:
            merge_waiting()

    merge_waiting()
    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        if not query.isActive:
            merge_waiting()
    return query


def _forget(spark: SparkSession, waiting: str, batches: list[int]) -> None:
    """Delete merged batches, oldest first and each at one stroke, since the next run merges again what a lost driver leaves of them.

    A row in a later batch that was merged already is older than the one held, or is that one.
    """
    for n in batches:
        path = tables.version_path(waiting, n)
        for part in (f"{path}/_SUCCESS", path):
            fs, target = file_system(spark, part)
            fs.delete(target, True)
