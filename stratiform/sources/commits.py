"""Bronze as numbered commits: a ledger of what was added when, and reading only what came after.

A commit is a folder of files below the generation of a table, and an entry in its ledger that names
rows, files, bytes and schema. Readers go by the ledger alone: a folder without an entry does not
exist for them. What an entity has consumed is the position of one entry, so a run reads the
files after it whatever the event times in them. A full refresh starts the next generation, whose
position lies after all before.

Files are written first, under a name of their own. Then the entry is created exclusively, so of two writers who
want a number one gets it and the other takes the next; the files move into their folder, and the entry is
filled last. An entry still empty holds readers back, since what lies behind it would otherwise be
consumed before it; one whose writer must be dead is passed over after ``STALE_MS``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from stratiform.session import file_system

COMMIT, GENERATION = "_commit", "_generation"
_LEDGER = "_ledger"
STALE_MS = 10 * 60_000  # an empty entry older than this is nobody's


@dataclass(frozen=True, order=True)
class Position:
    """Where a commit stands in a table's history."""

    generation: int
    commit: int

    @property
    def folder(self) -> str:
        return f"{GENERATION}={self.generation}/{COMMIT}={self.commit}"

    @property
    def entry(self) -> str:
        return f"{_LEDGER}/{self.generation:06d}-{self.commit:012d}.json"


@dataclass(frozen=True)
class Commits:
    """A table of commits, as a source that is read by arrival."""

    base: str


def _create(spark: SparkSession, path: str, overwrite: bool = False):
    """An open new file, or None if somebody else has created it.

    The file system decides, so this holds on those whose create without overwrite is atomic, such as
    HDFS, local disks and stores with conditional writes.
    """
    fs, target = file_system(spark, path)
    try:
        return fs.create(target, overwrite)
    except Py4JJavaError:
        if not overwrite and fs.exists(target):
            return None
        raise


def _read(spark: SparkSession, path: str) -> str:
    fs, target = file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _entries(spark: SparkSession, base: str) -> list[tuple[Position, bool, int]]:
    """Position, whether it is filled, and time of change of every entry, in order."""
    fs, root = file_system(spark, f"{base}/{_LEDGER}")
    if not fs.exists(root):
        return []
    listed = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(root)]
    return sorted((Position(*map(int, n.removesuffix(".json").split("-"))), size > 0, at) for n, size, at in listed if n.endswith(".json"))


def positions(spark: SparkSession, base: str, after: Position | None = None) -> list[Position]:
    """Commits of a table that can be read, in their order, by the names in its ledger."""
    found, now = [], spark._jvm.java.lang.System.currentTimeMillis()
    for position, filled, changed in _entries(spark, base):
        if filled:
            found.append(position)
        elif now - changed < STALE_MS:
            break
    return [p for p in found if after is None or p > after]


def newest(spark: SparkSession, base: str) -> Position | None:
    known = positions(spark, base)
    return known[-1] if known else None


def ledger(spark: SparkSession, base: str) -> DataFrame:
    """One row for each commit: generation, commit, n_rows, n_files, n_bytes."""
    rows = []
    for p in positions(spark, base):
        entry = json.loads(_read(spark, f"{base}/{p.entry}"))
        rows.append((p.generation, p.commit, entry["rows"], entry["files"], entry["bytes"]))
    return spark.createDataFrame(rows, "generation bigint, commit bigint, n_rows bigint, n_files bigint, n_bytes bigint")


def append_commit(df: DataFrame, base: str, position: Position | None = None, generation: int | None = None) -> Position:
    """Write rows as the next commit of the newest, or a named, generation.

    Naming the whole position makes a retried write the same commit: if its entry is filled, nothing is
    written again; what an attempt without one has left is replaced.
    """
    spark = df.sparkSession
    known = _entries(spark, base)
    if position and any(p == position and filled for p, filled, _ in known):
        return position
    fs, _ = file_system(spark, base)
    staged = f"{base}/_staged-{uuid.uuid4().hex}"
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
    listed = [s for s in fs.listStatus(file_system(spark, staged)[1]) if s.getPath().getName().endswith(".parquet")]
    entry = json.dumps({
        "rows": counted.get["rows"], "files": len(listed), "bytes": sum(s.getLen() for s in listed), "schema": json.loads(df.schema.json()),
    })
    if position:
        at, out = position, _create(spark, f"{base}/{position.entry}", overwrite=True)
    else:
        mine = [p for p, _, _ in known if generation is None or p.generation == generation]
        at = Position(mine[-1].generation, mine[-1].commit + 1) if mine else Position(generation or 0, 0)
        while (out := _create(spark, f"{base}/{at.entry}")) is None:
            at = Position(at.generation, at.commit + 1)
    folder = file_system(spark, f"{base}/{at.folder}")[1]
    fs.delete(folder, True)
    fs.mkdirs(folder.getParent())
    if not fs.rename(file_system(spark, staged)[1], folder):
        raise OSError(f"cannot move {staged} to {base}/{at.folder}")
    out.write(bytearray(entry.encode()))
    out.close()
    return at


def commit_stream(stream: DataFrame, base: str, checkpoint: str, generation: int = 0, wait: bool = True) -> StreamingQuery:
    """Every micro-batch of what is available now as one commit; its number is that of the batch, so a replay is the same commit."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_commit(batch, base, Position(generation, batch_id))

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def schema(spark: SparkSession, base: str) -> StructType | None:
    """The schema of the newest commit; None without one."""
    last = newest(spark, base)
    return StructType.fromJson(json.loads(_read(spark, f"{base}/{last.entry}"))["schema"]) if last else None


def read_after(spark: SparkSession, base: str, after: Position | None = None, upto: Position | None = None) -> DataFrame | None:
    """Rows of the commits after a position, with ``_generation`` and ``_commit``; None if there are none.

    Only folders of these commits are listed and read, with the schema of the newest; columns that older
    commits lack are NULL.
    """
    found = [p for p in positions(spark, base, after) if upto is None or p <= upto]
    if not found:
        return None
    columns = StructType.fromJson(json.loads(_read(spark, f"{base}/{found[-1].entry}"))["schema"])
    named = StructType([*columns.fields, StructField(GENERATION, LongType()), StructField(COMMIT, LongType())])
    return spark.read.option("basePath", base).schema(named).parquet(*(f"{base}/{p.folder}" for p in found))
