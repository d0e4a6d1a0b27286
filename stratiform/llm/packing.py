"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A bin is filled greedily with the longest pieces that fit. While room is left, its smallest piece
is replaced by two unpacked pieces that fill the widened gap more tightly. Only lengths matter
for that, so the bins are planned on the counts of each length, at most as many numbers as a
sequence has tokens: a bin that the counts allow again is planned once with its number of
repetitions. Spark then numbers the pieces of each length and looks up their places. The plan is
the same that packing piece by piece over the whole corpus would give.

Defined results: NULL text is an empty document, which is its end token alone; repeated rows are
documents of their own; sequences of an ordered table follow its order, within a stretch by the mean place of their pieces; pieces longer than a sequence do not exist, since longer documents are cut
into whole sequences with the shorter piece first; an empty table gives no pieces; other input columns do not matter, whatever
their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm import mixing
from stratiform.llm.base import filled, partitions, stored
from stratiform.llm.encoding import BYTE_BPE, encode

LENGTH = 2048  # tokens of a sequence
END = 0  # the id after each document
STRETCH = 1 << 20  # tokens in a row that are packed together
ROWS_A_GROUP = 4096  # and blocks of a part, for running sums


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, vocabulary: str = BYTE_BPE, end: int = END, with_ids: bool = False, along: tuple[str, ...] = ()) -> DataFrame:
    """Pieces of all documents: key, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    Columns named ``along`` come after them. ``ids`` are little-endian unsigned 32-bit numbers.
    """
    key_type = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in along)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, out = batch.column(0), defaultdict(list)
            rows = []
            for row, value in enumerate(batch.column(1)):
                ids = np.append(encode(value.as_py(), vocabulary), np.uint32(end)).astype("<u4", copy=False)
                first = len(ids) % length or length
                edges = [0, *range(first, len(ids) + 1, length)]
                for n, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = ids[a:b].tobytes()
                    rows.append(row)
                    out["piece"].append(n)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(part)
            types = {"piece": pa.int32(), "ids": pa.binary()}
            names = ["piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
            made = [pa.array(out[n], types.get(n, pa.int64())) for n in names]
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([keys.take(at), *made, *(c.take(at) for c in batch.columns[2:])], [key, *names, *along])

    return docs.select(key, filled(text).alias("text"), *along).mapInArrow(cut, schema)


def best_two_fit(counts: np.ndarray, length: int) -> list[tuple[dict[int, int], int]]:
    """Bins as (pieces of each length, repetitions) for ``counts`` pieces of each length."""
    left, bins = counts.astype(np.int64).copy(), []
    while left.any():
        free, used, peak, gap = left.copy(), defaultdict(int), defaultdict(int), length

        def take(size: int, n: int) -> None:
            used[size] += n
            free[size] -= n
            peak[size] = max(peak[size], used[size])

        while (sizes := np.flatnonzero(free[: gap + 1])).size:  # greedily, the longest that fits
            size = int(sizes[-1])
            n = min(gap // size, int(free[size]))
            take(size, n)
            gap -= n * size
        while gap and (pair := _two_for(free, min(used), gap)):
            smallest = min(used)
            used[smallest] -= 1
            free[smallest] += 1
            if not used[smallest]:
                del used[smallest]
            for size in pair:
                take(size, 1)
            gap -= sum(pair) - smallest
        # a used length may go down to what filling this bin once had needed of it
        again = min((int(left[s]) - peak[s]) // n for s, n in used.items()) + 1
        for size, n in used.items():
            left[size] -= n * again
        bins.append((dict(used), again))
    return bins


def _two_for(free: np.ndarray, smallest: int, gap: int) -> tuple[int, int] | None:
    """The two free lengths that fill ``smallest + gap`` most tightly, if more tightly than now."""
    room = smallest + gap
    sizes = np.flatnonzero(free[:room])
    if not sizes.size:
        return None
    at = np.searchsorted(sizes, np.minimum(room - sizes, sizes), side="right") - 1
    alone = (at >= 0) & (sizes[at] == sizes) & (free[sizes] < 2)
    at = at - alone
    total = np.where(at >= 0, sizes + sizes[at], 0)
    best = int(total.argmax())
    return (int(sizes[best]), int(sizes[at[best]])) if total[best] > smallest else None


def places(bins: list[tuple[dict[int, int], int]], length: int) -> dict[int, np.ndarray]:
    """For each length, rows of (first number, first sequence, pieces a sequence, first offset)."""
    found, numbers, sequence = defaultdict(list), np.zeros(length + 1, np.int64), 0
    for used, again in bins:
        offset = 0
        for size in sorted(used, reverse=True):
            found[size].append((int(numbers[size]), sequence, used[size], offset))
            numbers[size] += used[size] * again
            offset += size * used[size]
        sequence += again
    return {size: np.array(rows, np.int64) for size, rows in found.items()}


def looked_up(plan: dict[int, np.ndarray], sizes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Sequence and offset of pieces by their length and their number within it."""
    out = np.zeros((2, len(sizes)), np.int64)
    for size in np.unique(sizes):
        rows = sizes == size
        first, sequence, each, offset = plan[int(size)][np.searchsorted(plan[int(size)][:, 0], number[rows], side="right") - 1].T
        since = number[rows] - first
        out[:, rows] = sequence + since // each, offset + since % each * size
    return out


def numbered(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``number``, from 0 without gaps within each value of ``by``.

    Numbers are given inside chunks of equal hash, whose first numbers come from a running sum of
    their sizes, so that no value has to meet in one task.
    """
    chunk = F.pmod(F.xxhash64(*rows.columns), F.lit(4 * partitions(rows.sparkSession)))
    dealt = rows.withColumn("chunk", chunk)
    before = Window.partitionBy(by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy(by, "chunk").count().select(by, "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(by, "chunk").orderBy(*rows.columns)
    number = F.col("first") + F.row_number().over(inside) - 1
    return dealt.join(first, [by, "chunk"]).select(*rows.columns, number.alias("number"))


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """``cut`` pieces (see ``pieces``) with ``sequence_id`` and ``offset``.

    The driver sees the count of each length and nothing else.
    """
    counts = np.zeros(length + 1, np.int64)
    for size, n in cut.groupBy("length").count().collect():
        counts[size] = n
    plan = places(best_two_fit(counts, length), length)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, number = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "number"))
            out = looked_up(plan, sizes, number)
            kept = batch.drop_columns(["number"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(out[0]), pa.array(out[1])], [*kept.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id bigint, offset bigint"
    return numbered(cut, "length").mapInArrow(look_up, schema)


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, vocabulary: str = BYTE_BPE, end: int = END, with_ids: bool = False) -> DataFrame:
    """All documents cut and packed: the pieces with their places, written once before packing."""
    return pack(stored(pieces(docs, key, text, length, vocabulary, end, with_ids), "pieces"), length)


def laid_out(table: pa.Table, length: int) -> pa.Table:
    """Pieces of one stretch with ``sequence_id`` (from 0) and ``offset``, sequences in the order of the mixture."""
    table = table.sort_by([(c, "ascending") for c in ("position", "ids_crc32", "piece")])
    sizes = table.column("length").to_numpy()
    by_size = np.argsort(sizes, kind="stable")
    counts = np.bincount(sizes, minlength=length + 1)
    number = np.empty(len(sizes), np.int64)
    number[by_size] = np.arange(len(sizes)) - (np.cumsum(counts) - counts)[sizes[by_size]]
    sequence, offset = looked_up(places(best_two_fit(counts, length), length), sizes, number)
    middle = np.bincount(sequence, np.arange(len(sizes)) * sizes) / np.bincount(sequence, sizes)
    rank = np.empty(len(middle), np.int64)
    rank[np.argsort(middle, kind="stable")] = np.arange(len(middle))
    return table.append_column("sequence_id", pa.array(rank[sequence])).append_column("offset", pa.array(offset))


def packed_in_order(
    placed: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, vocabulary: str = BYTE_BPE, end: int = END, stretch: int = STRETCH,
) -> DataFrame:
    """Rows ordered by (``part``, ``group``, ``place``) cut and packed so that ``sequence_id`` follows that order.

    Each ``stretch`` of tokens is packed by itself in one task, from its lengths alone, and stretches
    follow each other. Running sums go over parts, over groups of a part and over rows of a group.
    """
    order = ("part", "group", "place")
    cut = stored(pieces(placed.select(key, text, *order), key, text, length, vocabulary, end, along=order), "pieces")

    def before(column: str, window: Window) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    groups = cut.groupBy("part", "group").agg(F.sum("length").alias("tokens"))
    # as many rows as there are parts
    parts = groups.groupBy("part").agg(F.sum("tokens").alias("tokens")).select("part", before("tokens", Window.partitionBy(F.lit(0)).orderBy("part")).alias("first"))
    firsts = groups.join(parts, "part").select("part", "group", (F.col("first") + before("tokens", Window.partitionBy("part").orderBy("group"))).alias("first"))
    inside = Window.partitionBy("part", "group").orderBy("place", "piece", "ids_crc32")
    found = cut.withColumn("since", before("length", inside)).join(firsts, ["part", "group"]).withColumn("position", F.col("first") + F.col("since"))
    found = found.drop(*order, "first", "since").withColumn("stretch", F.expr(f"position DIV {stretch}"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema) + ", sequence_id bigint, offset bigint"
    laid = stored(found.groupBy("stretch").applyInArrow(lambda table: laid_out(table, length), schema), "stretches")
    counts = laid.groupBy("stretch").agg((F.max("sequence_id") + 1).alias("n"))
    # as many rows as there are stretches
    first = counts.select("stretch", before("n", Window.partitionBy(F.lit(0)).orderBy("stretch")).alias("first"))
    kept = [c for c in found.columns if c not in ("position", "stretch")]
    return laid.join(first, "stretch").select(*kept, (F.col("first") + F.col("sequence_id")).alias("sequence_id"), "offset")


def in_file_order(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``part``, ``group``, ``place``: files by the number in their names, then rows as they lie in their file.

    Parquet keeps the order in which rows were written, and readers can tell it wherever they cut the files. A
    table that does not come from files is written first, one file after the other by its partitions.
    """
    def seen(df: DataFrame) -> DataFrame:
        where = df.metadataColumn("_metadata")
        return df.select(key, text, where["file_path"].alias("file"), where["row_index"].alias("place"))

    try:
        rows = seen(docs)
    except AnalysisException:
        rows = seen(stored(docs.select(key, text), "ordered"))
    number = F.regexp_extract(F.element_at(F.split("file", "/"), -1), r"^part-(\d+)", 1).try_cast("bigint")
    # as many rows as there are files
    files = rows.select("file").distinct().select("file", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(number.asc_nulls_first(), "file")).cast("long").alias("part"))
    return rows.join(files, "file").select(key, text, "part", F.expr(f"place DIV {ROWS_A_GROUP}").alias("group"), "place")


def packed_mixture(
    docs: DataFrame, targets: DataFrame | None = None, key: str = "doc_id", source: str = "source", text: str = "text", length: int = LENGTH,
    vocabulary: str = BYTE_BPE, end: int = END, block_chars: int = mixing.BLOCK_CHARS, stretch: int = STRETCH,
) -> DataFrame:
    """All documents mixed and packed, without storing the mixture between."""
    placed = mixing.schedule(docs, targets, key, source, text, block_chars, columns=[key, text])
    ordered = placed.select(F.col(f"row.`{key}`").alias(key), F.col(f"row.`{text}`").alias(text), F.expr(f"turn DIV {ROWS_A_GROUP}").alias("part"), F.col("turn").alias("group"), F.col("start").alias("place"))
    return packed_in_order(ordered, key, text, length, vocabulary, end, stretch)


def sequences(placed: DataFrame) -> DataFrame:
    """Whole sequences from placed pieces with ``ids``: ``sequence_id``, ``length``, ``ids``.

    A group is at most one sequence long.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.expr("aggregate(parts, CAST('' AS binary), (all, p) -> concat(all, p.ids))").alias("ids")
    )
