"""Token counts of all texts by a compiled transducer.

Texts up to a chunk run through the machine where they are read. Longer ones are cut into chunks
that any task can work on: each becomes the map of its chunk, and the maps of a text are applied
in order from the state at its beginning. See ``transducer`` for machine and maps.

Defined results: NULL is the empty text, which has no tokens; repeated rows each get their count,
a long text is worked on once whatever its copies; an empty table gives an empty result; input columns ride along.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stratiform.llm.base import filled, stored, text_key
from stratiform.llm.transducer import MARK, ChunkMap, transducer

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
CHUNK = 1 << 16  # characters


def _mapped(chunks: DataFrame, path: str) -> DataFrame:
    """``key``, ``place`` and the map of each chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            # the first chunk of a text begins with the mark that the library puts before it
            maps = [machine.chunk(c if n else MARK + c) for n, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            made = [pa.array([getattr(m, f) for m in maps], t) for f, t in (("head", pa.string()), ("inner", pa.int64()), ("tail", pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], ["key", "place", "head", "inner", "tail"])

    return chunks.select("key", "place", "chunk").mapInArrow(work, "key binary, place int, head string, inner bigint, tail string")


def _applied(maps: DataFrame, path: str) -> DataFrame:
    """``key`` and ``n_tokens``: the maps of a text, in order."""
    listed = maps.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "head", "inner", "tail"))).alias("maps"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            counts = [machine.through([ChunkMap(m["head"], m["inner"], m["tail"]) for m in own]) for own in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["key", "n_tokens"])

    return listed.mapInArrow(work, "key binary, n_tokens bigint")


def token_counts(docs: DataFrame, text: str = "text", path: str = PIECE_BPE, chunk: int = CHUNK) -> DataFrame:
    """All rows as ``row`` (without the text) with ``n_bytes`` and ``n_tokens``."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("row")
    rows = docs.select(row, filled(text).alias("text"))
    is_long = F.length("text") > chunk
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            counts = [machine.count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(counts, pa.int64())], ["row", "n_bytes", "n_tokens"])

    short = rows.where(~is_long).select("row", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = short.mapInArrow(whole, StructType([rows.schema["row"], *(StructField(c, LongType()) for c in ("n_bytes", "n_tokens"))]))
    long_rows = rows.where(is_long).withColumn("key", text_key("text"))
    cut = F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))).alias("place", "chunk")
    chunks = long_rows.dropDuplicates(["key"]).select("key", cut).repartition("key", "place")
    totals = stored(_applied(_mapped(chunks, path), path), "long-counts")
    long_ = long_rows.select("row", "key", F.octet_length("text").cast("long").alias("n_bytes")).join(totals, "key")
    return counted.unionByName(long_.select("row", "n_bytes", "n_tokens"))
