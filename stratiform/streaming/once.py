"""Streamed rows once per key, with late rows and repeats kept apart instead of lost.

``ingest.dedupe_within`` keeps its state in memory and forgets: a unique row that comes later than the
delay vanishes. Here the keys that were seen are a table, in buckets of the key's hash, so no key is ever
forgotten and a row is lost by none of its possible fates: it is stored, late, or a repeat. All three are
tables of commits with the number of the micro-batch, so a replayed batch leaves what it left before.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratiform.functions import marks
from stratiform.operators.dedupe import first_per_key
from stratiform.session import discard, scratch_dir
from stratiform.sources import commits
from stratiform.sources.commits import Position
from stratiform.sources.tables import key_bucket

FATES = ("stored", "late", "repeated")
_FATE, _BUCKET, _MARK = "_fate", "_bucket", "_newest"


@dataclass(frozen=True)
class Once:
    """Where the tables of a stream are: rows by fate, and the keys seen so far."""

    base: str

    def table(self, fate: str) -> str:
        return f"{self.base}/{fate}"

    @property
    def keys(self) -> str:
        return f"{self.base}/keys"

    def read(self, spark: SparkSession, fate: str) -> DataFrame | None:
        """Rows of a fate over all batches; None before the first."""
        rows = commits.read_after(spark, self.table(fate))
        return rows.drop(commits.COMMIT, commits.GENERATION) if rows is not None else None


def _seen(spark: SparkSession, out: Once, batch_id: int, buckets: list[int]) -> DataFrame | None:
    """Keys of the batches before, in some buckets."""
    if batch_id == 0:
        return None
    known = commits.read_after(spark, out.keys, None, Position(0, batch_id - 1))
    return None if known is None else known.filter(F.col(_BUCKET).isin(buckets))


def _newest_before(spark: SparkSession, out: Once, batch_id: int) -> str | None:
    """The mark of the newest time of all batches before."""
    before = [p for p in commits.positions(spark, f"{out.base}/times") if p.commit < batch_id]
    return commits.read_after(spark, f"{out.base}/times", Position(0, before[-1].commit - 1), before[-1]).first()[_MARK] if before else None


def once_available(stream: DataFrame, out: Once, checkpoint: str, keys: Sequence[str], time: str, delay: str, buckets: int = 64) -> StreamingQuery:
    """Sort what is available now into stored rows, late rows and repeats.

    The first row of a key, by time, is stored, or is late if its time lies more than ``delay`` (an interval) before the newest
    time of the batches before; rows of one batch are not late to each other. Any other row of the key is a repeat, of whatever batch. NULL is a key; a
    row without a time is late from the second batch on. A batch reads the keys of the buckets that it touches, and
    hot keys meet once per task. The tables and the checkpoint belong together.
    """
    keys = list(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, at, dtype = batch.sparkSession, Position(0, batch_id), batch.schema[time].dataType
        path = scratch_dir(spark, "once")
        batch.withColumns({_BUCKET: key_bucket(keys, buckets), "_row": F.monotonically_increasing_id()}).write.parquet(path)
        rows = spark.read.parquet(path)
        rest = [F.col(c).asc_nulls_last() for c in batch.columns if c not in (*keys, time)]
        first = first_per_key(rows, keys, [F.col(time).asc_nulls_last(), *rest, F.col("_row")]).select("_row", F.lit(True).alias("_first"))
        touched = [r[0] for r in rows.select(_BUCKET).distinct().collect()]  # at most ``buckets``
        seen = _seen(spark, out, batch_id, touched)
        marked = rows.join(first, "_row", "left")
        if seen is None:
            marked = marked.withColumn("_known", F.lit(False))
        else:
            asked = rows.select(*[F.col(k).alias(f"_a_{k}") for k in keys]).distinct()
            # the keys of all time are cut down to those asked for, which a small batch does by a broadcast
            known = seen.join(asked, [F.col(k).eqNullSafe(F.col(f"_a_{k}")) for k in keys], "left_semi").select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.lit(True).alias("_known"))
            marked = marked.join(known, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left")
        newest = _newest_before(spark, out, batch_id)
        bound = None if newest is None else marks.value(newest, dtype) - F.expr(f"INTERVAL {delay}")
        behind = F.lit(False) if bound is None else F.coalesce(F.col(time) < bound, F.lit(True))
        fate = F.when(F.coalesce("_known", F.lit(False)) | F.col("_first").isNull(), "repeated").when(behind, "late").otherwise("stored")
        sorted_path = scratch_dir(spark, "once")
        marked.withColumn(_FATE, fate).select(*batch.columns, _BUCKET, _FATE).write.partitionBy(_FATE).parquet(sorted_path)
        fated = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField(_BUCKET, T.IntegerType()), T.StructField(_FATE, T.StringType())])).parquet(sorted_path)
        for name in FATES:
            commits.append_commit(fated.filter(F.col(_FATE) == name).select(*batch.columns), out.table(name), at)
        commits.append_commit(_newest_time(fated, time, dtype, newest), f"{out.base}/times", at)
        # last, since a batch looks at the keys of those before it alone
        new = fated.filter(F.col(_FATE) != "repeated").select(*keys, _BUCKET)
        commits.append_commit(new.repartition(_BUCKET).sortWithinPartitions(_BUCKET, *keys), out.keys, at)
        for done in (path, sorted_path):
            discard(spark, done)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _newest_time(rows: DataFrame, time: str, dtype: T.DataType, before: str | None) -> DataFrame:
    """The mark of the newest time so far, as one row."""
    own = marks.mark(F.max(time), dtype)
    return rows.agg(own.alias(_MARK)).select(F.greatest(F.col(_MARK), F.lit(before).cast("string")).alias(_MARK))
