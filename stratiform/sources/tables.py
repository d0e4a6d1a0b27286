"""Writing layered tables as Parquet: versions, touched partitions, clustering, tags."""

from __future__ import annotations

import json
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from stratiform.operators.keyed import not_older, require_unique_keys, upsert
from stratiform.session import file_system, materialize

_VERSION = "version="
_SCHEMA = "_schema.json"


def version_path(base: str, version: int) -> str:
    return f"{base}/{_VERSION}{version}"


def versions(spark: SparkSession, base: str) -> list[int]:
    """Complete versions of a table, oldest first. Spark's ``_SUCCESS`` file marks a version complete."""
    fs, root = file_system(spark, base)
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(_VERSION)]
    done = [p.getName()[len(_VERSION):] for p in found if exists(spark, f"{base}/{p.getName()}/_SUCCESS")]
    return sorted(int(v) for v in done)


def current(spark: SparkSession, base: str, below: int | None = None) -> DataFrame | None:
    """Newest complete version, optionally below a number; None if there is none."""
    known = [v for v in versions(spark, base) if below is None or v < below]
    return spark.read.parquet(f"{base}/{_VERSION}{known[-1]}") if known else None


def publish(df: DataFrame, base: str, version: int | None = None, partition_by: Sequence[str] = ()) -> int:
    """Write a new version beside the one being read.

    Readers see it only once complete. Naming the version makes a retried write idempotent.
    """
    if version is None:
        known = versions(df.sparkSession, base)
        version = known[-1] + 1 if known else 0
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base}/{_VERSION}{version}")
    return version


def rebalanced(df: DataFrame, *by: str) -> DataFrame:
    """Let AQE even out output files by size, splitting large and joining small partitions."""
    return df.hint("rebalance", *by)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """A partition number that depends on the key alone."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    unique: bool = False,
    widen: bool = False,
    by: Sequence[str] = (),
) -> None:
    """Merge into a partitioned table and rewrite only the partitions the source touches.

    ``partition`` must be a function of the key, such as ``key_bucket`` or a date in the key.
    The touched partition values, at most as many as the table has partitions, become a static
    partition filter; the merged partitions replace the old ones by dynamic partition overwrite
    once the new files are complete. A merge that broke off is repaired by running it again.
    The table is created if it does not exist. With ``by``, rows older than the held one stay out.
    NULL is a partition of its own, and partition values are read as the column's type, never guessed.
    """
    staged = materialize(source if unique else require_unique_keys(source, keys), "upsert-source")
    if exists(spark, path):
        touched = [row[0] for row in staged.select(partition).distinct().collect()]
        known = F.col(partition).isin([v for v in touched if v is not None])
        hit = known | F.col(partition).isNull() if None in touched else known
        target = read_partitioned(spark, path, {partition: staged.schema[partition].dataType}).filter(hit)
        newer = not_older(staged, target, keys, by) if by else staged
        merged = upsert(target, newer, keys, unique=True, widen=widen)
    else:
        merged = staged
    _store_schema(spark, path, merged.schema)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def _store_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Keep a table's schema beside its files, under a name that scans pass over."""
    fs, target = file_system(spark, f"{path}/{_SCHEMA}")
    out = fs.create(target, True)
    out.write(bytearray(schema.json().encode()))
    out.close()


def _stored_schema(spark: SparkSession, path: str) -> StructType | None:
    fs, target = file_system(spark, f"{path}/{_SCHEMA}")
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return StructType.fromJson(json.loads(text))


def read_partitioned(spark: SparkSession, path: str, types: Mapping[str, DataType] | None = None) -> DataFrame:
    """A partitioned table with the columns of all its files.

    The stored schema is used if there is one; otherwise all footers are read, and ``types``
    gives the types of partition columns, which Spark would guess from the folder names.
    """
    schema = _stored_schema(spark, path)
    if schema is None:
        guessed = spark.read.option("mergeSchema", "true").parquet(path).schema
        types = types or {}
        schema = StructType([StructField(f.name, types.get(f.name, f.dataType), f.nullable) for f in guessed])
    return spark.read.schema(schema).parquet(path)


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Delete all but the newest complete versions; returns the deleted ones."""
    old = versions(spark, base)[: -max(1, keep)]
    for version in old:
        fs, target = file_system(spark, f"{base}/{_VERSION}{version}")
        fs.delete(target, True)
    return old


def write_clustered(df: DataFrame, path: str, by: Sequence[str], partitions: int | None = None) -> None:
    """Range-cluster and sort files by the columns later filtered on, so row groups can be skipped."""
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Bucket and sort a table by its join key, so that joins on it need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def write_routed(df: DataFrame, base: str, column: str = "layer_schema") -> None:
    """Write each row into the one schema named in ``column``."""
    df.write.mode("overwrite").partitionBy(column).parquet(base)


def tagged(df: DataFrame, tags: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Attach lineage tags (layer, entity, writer, restricted) as column metadata."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={**df.schema[c].metadata, **tags[c]}) if c in tags else F.col(c)
            for c in df.columns
        ]
    )
