"""Exactly-once file ingest into append-only bronze tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratiform.functions import lineage
from stratiform.sources import commits
from stratiform.sources.evolve import evolved, of_variants, widen
from stratiform.sources.landing import infer_schema, options, with_rescued, with_rescued_nested


_LINE = "_line"
RESCUED = "_rescued_data"


def file_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    fmt: str = "json",
    max_files: int | None = None,
    archive: str | None = None,
    extra: Mapping[str, str] | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Each landed file once. ``max_files`` or ``max_bytes`` cap a micro-batch, so a long backlog runs in steps.

    ``archive`` moves files of committed batches out of the landing folder on later runs; it
    must lie outside of it. A folder per run date gives a dated archive.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options(fmt, extra))
    if max_files and max_bytes:
        raise ValueError("cap micro-batches by files or by bytes, not both")
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(landing)


def append_available(
    stream: DataFrame, table: str, checkpoint: str, partition_by: tuple[str, ...] = (), wait: bool = True
) -> StreamingQuery:
    """Append what is available now to a Parquet table and stop."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    query = (writer.partitionBy(*partition_by) if partition_by else writer).start()
    if wait:
        query.awaitTermination()
    return query


def ingest(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    schema: T.StructType,
    source: str,
    entity: str,
    fmt: str = "json",
    run_id: str = "unknown",
    as_of: Column | None = None,
    max_files: int | None = None,
    archive: str | None = None,
    extra: Mapping[str, str] | None = None,
    rescue: bool = False,
    partition_by: tuple[str, ...] = (),
    max_bytes: int | None = None,
) -> StreamingQuery:
    """One triggered run: new files, lineage columns, append.

    ``rescue`` reads JSON line by line and keeps what does not fit the schema in
    ``_rescued_data`` instead of losing it.
    """
    if rescue and fmt != "json":
        raise ValueError("only JSON lines can be rescued")
    line = T.StructType([T.StructField("value", T.StringType())])
    stream = file_stream(
        spark, landing, line if rescue else schema, "text" if rescue else fmt, max_files, archive, extra, max_bytes
    )
    rows = lineage.from_files(stream, source, entity, run_id=run_id, as_of=as_of)
    if rescue:
        lines = rows.withColumnRenamed("value", _LINE).filter(F.trim(_LINE) != "")
        rows = with_rescued(lines, _LINE, schema).drop(_LINE)
    return append_available(rows, table, checkpoint, partition_by)


def ingest_evolving(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    stored: T.StructType,
    source: str,
    entity: str,
    fmt: str = "json",
    since: str | None = None,
    **kwargs,
) -> tuple[T.StructType, list[str]]:
    """Widen the stored schema by columns found in the landing folder, then ingest with it.

    Only files modified after ``since`` are looked at, if given. Returns the schema to store for the
    next run and the columns whose type conflicts; JSON values that do not fit are rescued. Rows
    written before keep NULL in added columns; read the table with ``read_bronze``. ``ingest_commits`` does without looking at
    the folder beforehand.
    """
    kwargs.setdefault("rescue", fmt == "json")
    newer = {"modifiedAfter": since} if since else {}
    found = infer_schema(spark, landing, fmt, extra={**(kwargs.get("extra") or {}), **newer})
    schema, conflicts = widen(stored, found)
    ingest(spark, landing, table, checkpoint, schema, source, entity, fmt, **kwargs)
    return schema, conflicts


@dataclass
class Evolution:
    """What a run has found: the schema of the payload and the fields, by path, whose types conflict with it."""

    schema: T.StructType
    conflicts: list[str] = field(default_factory=list)


def ingest_commits(
    spark: SparkSession,
    landing: str,
    base: str,
    checkpoint: str,
    source: str,
    entity: str,
    start: T.StructType | None = None,
    generation: int = 0,
    run_id: str = "unknown",
    as_of: Column | None = None,
    max_files: int | None = None,
    archive: str | None = None,
    max_bytes: int | None = None,
) -> Evolution:
    """One triggered run of JSON lines into a table of commits (see ``sources.commits``), whose schema grows with what arrives.

    The types in a micro-batch are aggregated over its own new files, in the run itself, so nothing is
    inferred beforehand and no old file is read. New fields are added, in structs too; values that conflict with a
    stored type, at any depth, and lines that are no JSON object go to ``_rescued_data``. New fields of several types become text. The
    ledger holds the schema, ``start`` is that of a table without commits.
    """
    line = T.StructType([T.StructField("value", T.StringType())])
    stream = file_stream(spark, landing, line, "text", max_files, archive, max_bytes=max_bytes)
    lines = lineage.from_files(stream, source, entity, run_id=run_id, as_of=as_of).withColumnRenamed("value", _LINE).filter(F.trim(_LINE) != "")
    technical = {*(c for c in lines.columns if c != _LINE), RESCUED}
    found = Evolution(_payload(spark, base, technical, start))

    def write(batch: DataFrame, batch_id: int) -> None:
        at = commits.Position(generation, batch_id)
        objects = batch.select(F.try_parse_json(_LINE).alias("v")).filter(F.try_variant_get("v", F.lit("$"), "map<string,variant>").isNotNull())
        types = objects.agg(F.schema_of_variant_agg("v")).first()[0]
        found.schema, conflicts = evolved(found.schema, of_variants(types))
        found.conflicts += [c for c in conflicts if c not in found.conflicts]
        commits.append_commit(with_rescued_nested(batch, _LINE, found.schema, RESCUED).drop(_LINE), base, at)

    query = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return found


def _payload(spark: SparkSession, base: str, technical: set[str], start: T.StructType | None) -> T.StructType:
    """The schema of the newest commit without what the ingest itself adds."""
    known = commits.schema(spark, base)
    return T.StructType([f for f in known if f.name not in technical]) if known else start or T.StructType()


def read_bronze(spark: SparkSession, table: str) -> DataFrame:
    """The bronze snapshot with columns of all files; silver starts here, as a batch."""
    return spark.read.option("mergeSchema", "true").parquet(table)


def full_refresh_paths(base: str, generation: int) -> tuple[str, str]:
    """Table and checkpoint of a generation. A full refresh takes the next one, so every file is read anew."""
    return f"{base}/generation={generation}/table", f"{base}/generation={generation}/checkpoint"


def dedupe_within(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of each other; the state stays bounded.

    Event time must be a zoned timestamp for a watermark, so zone-less times go through the
    session zone and back.
    """
    dtype = stream.schema[time].dataType
    zoned = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return zoned.dropDuplicatesWithinWatermark(keys).withColumn(time, F.col(time).cast(dtype))
