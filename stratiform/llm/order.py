"""Token sequences in training order, written as binary shards of equal records.

Every sequence of the corpus gets a number, and a keyed Feistel network permutes the numbers: where
the result falls outside the range it is permuted again (cycle walking), so the numbers map one to
one onto the slots. A key is a whole training order that no one has to store. A shard is a range of slots; record n of
a shard starts at byte n * stride, so a reader starts or goes on at any slot by one seek.

Numbers come from the task that reads a document and the place in it, counted in a first pass. A
lost task gives the same numbers again, which it checks, and a shard written again is the same bytes.

Defined results: NULL text is an empty document, whose one sequence is its end token; repeated rows
are sequences of their own; short sequences are filled up with ``pad``, their length is in the manifest; an empty
table gives no shards and an empty manifest; other input columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.base import filled, stored
from stratiform.llm.encoding import BYTE_BPE, encode, encoder
from stratiform.llm.words import mix, random_words

LENGTH = 256  # tokens of a record
SHARD = 1 << 14  # records of a shard
END, PAD = 50256, 50256
ROUNDS = 6  # of the network
SEED = "order"


@dataclass(frozen=True)
class Order:
    """A permutation of 0 to ``n`` - 1 under a key."""

    n: int
    seed: str = SEED

    def _once(self, x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
        low = np.uint64((1 << half) - 1)
        left, right = x >> np.uint64(half), x & low
        for key in keys:
            left, right = right, left ^ (mix(right + key) & low)
        return (left << np.uint64(half)) | right

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        """The slot of each number."""
        half = max(1, (max(self.n - 1, 1).bit_length() + 1) // 2)
        keys = random_words(f"feistel {self.seed}", ROUNDS)
        out = self._once(numbers.astype(np.uint64), half, keys)
        while (outside := out >= np.uint64(self.n)).any():
            out[outside] = self._once(out[outside], half, keys)
        return out.astype(np.int64)


@dataclass(frozen=True)
class Part:
    """The sequences of one task: the number of its first, how many, and a checksum over all in order."""

    first: int
    count: int
    checksum: int


def _cut(value: str, length: int, vocabulary: str, end: int) -> list[bytes]:
    """A document's sequences as little-endian numbers, of 16 bits if the vocabulary allows, else of 32."""
    kind = width(vocabulary)
    ids = np.append(encode(value, vocabulary), np.uint32(end)).astype(kind)
    return [ids[at : at + length].tobytes() for at in range(0, len(ids), length)]


def sequences(docs: DataFrame, key: str, text: str, length: int, vocabulary: str, end: int) -> DataFrame:
    """``key``, ``piece``, ``n_tokens``, ``ids_crc32``, the place (``part``, ``row``) of each sequence and the ``checksum`` so far.

    A document is cut every ``length`` tokens, its end token included.
    """
    size = np.dtype(width(vocabulary)).itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, checksum = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            of, out = [], [[] for _ in range(4)]
            for n, value in enumerate(batch.column(1)):
                for piece, own in enumerate(_cut(value.as_py(), length, vocabulary, end)):
                    checksum = zlib.crc32(own, checksum)
                    of.append(n)
                    for column, x in zip(out, (piece, len(own) // size, zlib.crc32(own), checksum)):
                        column.append(x)
            made = [pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))]
            place = [pa.array(np.full(len(of), part, np.int32)), pa.array(np.arange(row, row + len(of)))]
            row += len(of)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *made, *place], ["key", "piece", "n_tokens", "ids_crc32", "checksum", "part", "row"])

    schema = f"key {docs.schema[key].dataType.simpleString()}, piece int, n_tokens int, ids_crc32 bigint, checksum bigint, part int, row bigint"
    return docs.select(F.col(key).alias("key"), filled(text).alias("text")).mapInArrow(cut, schema)


def width(vocabulary: str) -> str:
    return "<u2" if encoder(vocabulary).n_vocab <= 1 << 16 else "<u4"


def slotted(docs: DataFrame, key: str, text: str, length: int, vocabulary: str, end: int, parts: dict[int, Part], order: Order) -> DataFrame:
    """``slot`` and ``ids`` of all sequences, cut again in the tasks that counted them.

    Ids are made twice rather than written and read between the passes. A task that does not
    find the sequences it found before stops the job.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row, checksum = parts.get(TaskContext.get().partitionId(), Part(0, 0, 0)), 0, 0
        for batch in batches:
            found = [own for value in batch.column(1) for own in _cut(value.as_py(), length, vocabulary, end)]
            for own in found:
                checksum = zlib.crc32(own, checksum)
            slots = order.slots(np.arange(known.first + row, known.first + row + len(found)))
            row += len(found)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(found, pa.binary())], ["slot", "ids"])
        if (row, checksum) != (known.count, known.checksum):
            raise RuntimeError("the input came in another order than before: write it to a table first")

    return docs.select(F.col(key).alias("key"), filled(text).alias("text")).mapInArrow(cut, "slot bigint, ids binary")


def materialise(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, shard: int = SHARD,
    vocabulary: str = BYTE_BPE, end: int = END, pad: int = PAD, seed: str = SEED,
) -> DataFrame:
    """Write all sequences to ``path``/shards in the order of ``seed``; the manifest, also in ``path``.

    The manifest has key, ``piece``, ``n_tokens``, ``ids_crc32``, ``slot``, ``shard`` and ``offset`` (bytes).
    A record is ``length`` ids and one line end, which Spark's text files put after each row.
    ``docs`` must come in the same order each time, as scans of files do.
    """
    spark = docs.sparkSession
    # splits of files must not follow the executors that come and go between the passes
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    found = stored(sequences(docs, key, text, length, vocabulary, end), "sequences")
    # a row for each task that wrote sequences
    last = found.groupBy("part").agg(F.count("*").alias("n"), F.max_by("checksum", "row").alias("checksum"))
    parts, total = {}, 0
    for r in last.orderBy("part").collect():
        parts[r.part] = Part(total, r.n, r.checksum)
        total += r.n
    order, size = Order(total, seed), np.dtype(width(vocabulary)).itemsize
    stride = length * size + 1
    shard_of = F.expr(f"CAST(slot DIV {shard} AS int)")
    filling = F.lit(bytearray(np.array([pad], width(vocabulary)).tobytes()))
    record = F.rpad("ids", F.lit(length * size), filling).cast("string")
    dealt = slotted(docs, key, text, length, vocabulary, end, parts, order).withColumn("shard", shard_of).repartitionById(max(1, -(-total // shard)), F.col("shard"))
    dealt.sortWithinPartitions("shard", "slot").select("shard", record.alias("value")).write.partitionBy("shard").text(f"{path}/shards")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, row = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("part", "row"))
            numbers = np.array([parts[p].first for p in part.tolist()], np.int64) + row
            yield batch.drop_columns(["part", "row"]).append_column("slot", pa.array(order.slots(numbers)))

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema if f.name not in ("checksum", "part", "row"))
    manifest = found.drop("checksum").mapInArrow(place, f"{kept}, slot bigint").withColumn("shard", shard_of).withColumn("offset", (F.col("slot") % shard) * stride)
    manifest.withColumnRenamed("key", key).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_from(spark: SparkSession, path: str, slot: int, length: int = LENGTH, shard: int = SHARD, vocabulary: str = BYTE_BPE) -> DataFrame:
    """``slot`` and ``ids`` (with padding) of all records from a slot on; earlier shards are not read."""
    kind = np.dtype(width(vocabulary)).itemsize
    stride = length * kind + 1
    files = spark.read.format("binaryFile").load(f"{path}/shards").where(F.col("shard") >= slot // shard)
    places = F.explode(F.sequence(F.lit(0), F.expr(f"CAST(length DIV {stride} AS int) - 1"))).alias("n")
    rows = files.select("shard", "content", places).select(
        (F.col("shard").cast("long") * shard + F.col("n")).alias("slot"), F.expr(f"substring(content, n * {stride} + 1, {length * kind})").alias("ids")
    )
    return rows.where(F.col("slot") >= slot)
