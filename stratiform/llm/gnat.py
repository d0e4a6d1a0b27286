"""Vector codes: product quantisation whose nearest entries are found by a GNAT over each codebook.

A vector is cut into equal parts, and each part is replaced by the number of the nearest entry of
its position's codebook. The entries of a codebook lie in a geometric near-neighbour access tree:
a node has a few split points, every other entry belongs to the nearest of them, and for each
pair of a split point and a child the node keeps the least and the largest distance. A query that
measured its distance to a split point drops every child whose range no closer entry can have.

Components are integers, floor(256 * x), so squared distances are exact. Bounds are square roots
rounded outwards, and a child goes only if its bound is strictly above the best distance so far; what is
left is compared by integer squared distance and then by number. So the search gives what
comparing all entries would give, ties included.

Training reads all vectors in each round. Tasks send on sums and counts by entry, so that what meets in one
place depends on the codebooks and never on the data; the driver holds the codebooks alone.

Defined results: vectors that are NULL, empty, or hold NULL or non-finite components are left out,
and so are those whose length differs from that of the first kept id or cannot be cut into equal
parts; components beyond +-2**26 count as that, which keeps sums of squares in 64 bits; ids that are NULL
come last, ties of the first ids go by their components; repeated rows have a code each and weigh as
often; fewer vectors than entries give a shorter codebook; equal entries are told apart by number,
so the later one stays unused; NULL labels are one group; an empty table gives an empty result;
other input columns ride along in ``row``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stratiform.llm.base import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 26  # of a component, either sign
SPLITS, LEAF = 8, 8  # split points of a node; entries that need no node
VECTORS_AT_ONCE = 8192  # searched together

# A square root of an exact integer is right to 2**-53 of itself and so is a difference of two; 2**-48 covers both.
_DOWN, _UP = 1 - 2.0**-48, 1 + 2.0**-48
_NEVER = np.iinfo(np.int64).max


@dataclass
class Node:
    """Split points with one child each, and for split i and child j the range of distances from i to all below j, j included."""

    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: list[Node | np.ndarray | None]


@dataclass
class Search:
    """Nearest entries of one codebook; ``measured`` counts the distances that were computed."""

    entries: np.ndarray
    root: Node | np.ndarray = field(init=False)
    measured: int = 0

    def __post_init__(self) -> None:
        self.root = self._grown(np.arange(len(self.entries)))

    def _squared(self, i: int, others: np.ndarray) -> np.ndarray:
        apart = self.entries[others] - self.entries[i]
        return (apart * apart).sum(1)

    def _grown(self, ids: np.ndarray) -> Node | np.ndarray:
        if len(ids) <= max(LEAF, 2):
            return ids
        chosen, nearest = [int(ids[0])], self._squared(ids[0], ids)
        while len(chosen) < min(SPLITS, len(ids)) and nearest.max() > 0:  # each as far as can be from those before
            chosen.append(int(ids[nearest.argmax()]))
            nearest = np.minimum(nearest, self._squared(chosen[-1], ids))
        if len(chosen) < 2:  # all alike
            return ids
        chosen.sort()
        to_all = np.stack([self._squared(c, ids) for c in chosen])
        owner = to_all.argmin(0)
        owner[np.searchsorted(ids, chosen)] = np.arange(len(chosen))
        low = np.stack([[np.sqrt(d[owner == j].min()) for j in range(len(chosen))] for d in to_all]) * _DOWN
        high = np.stack([[np.sqrt(d[owner == j].max()) for j in range(len(chosen))] for d in to_all]) * _UP
        below = [ids[(owner == j) & (ids != c)] for j, c in enumerate(chosen)]
        return Node(np.array(chosen), low, high, [self._grown(b) if len(b) else None for b in below])

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry and its squared distance, the lower number among equals."""
        self._queries = queries
        self._best = np.full(len(queries), _NEVER)
        self._at = np.full(len(queries), len(self.entries))
        if len(queries):
            self._visit(self.root, np.arange(len(queries)))
        return self._at, self._best

    def _measure(self, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of queries to entries (ascending); the best of them is kept if it is better than before."""
        own, squared = self._queries[rows], np.zeros((len(rows), len(ids)), np.int64)
        for place in range(own.shape[1]):
            apart = own[:, place, None] - self.entries[ids, place]
            squared += apart * apart
        self.measured += squared.size
        least = squared.argmin(1)
        value, entry = squared[np.arange(len(rows)), least], ids[least]
        better = (value < self._best[rows]) | ((value == self._best[rows]) & (entry < self._at[rows]))
        won = rows[better]
        self._best[won], self._at[won] = value[better], entry[better]
        return squared

    def _visit(self, node: Node | np.ndarray | None, rows: np.ndarray) -> None:
        if node is None or not len(rows):
            return
        if isinstance(node, np.ndarray):
            self._measure(rows, node)
            return
        away = np.sqrt(self._measure(rows, node.splits))
        bound = np.full(away.shape, -np.inf)
        for i in range(len(node.splits)):
            far, near = away[:, i, None] * _DOWN - node.high[i], node.low[i] - away[:, i, None] * _UP
            np.maximum(bound, np.maximum(far, near), out=bound)
        bound *= _DOWN
        alive, closest = bound <= (np.sqrt(self._best[rows]) * _UP)[:, None], away.argmin(1)
        # the nearest split's child first, whose entries tighten the radius for the others
        for first in (True, False):
            for j, child in enumerate(node.children):
                own = np.flatnonzero(alive[:, j] & ((closest == j) == first))
                self._visit(child, rows[own[bound[own, j] <= np.sqrt(self._best[rows[own]]) * _UP]])


def usable(vector: str) -> Column:
    """Whether a vector is there, has components and all of them are finite numbers."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(F.col(vector), lambda x: finite(x.cast("double")))


def whole(vector: str) -> Column:
    """The components as integers."""
    top = F.lit(float(LARGEST))
    return F.transform(F.col(vector), lambda x: F.floor(F.least(F.greatest(x.cast("double") * SCALE, -top), top)))


def _cut(column: pa.Array, width: int, parts: int) -> np.ndarray:
    """Vectors as (part, vector, component)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return np.ascontiguousarray(flat.reshape(-1, parts, width // parts).swapaxes(0, 1))


def _joined(batches: Iterator[pa.RecordBatch], rows: int = VECTORS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Batches of about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


@dataclass(frozen=True)
class Codebooks:
    """Entries by part: integers of shape (part, entry, component)."""

    entries: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def searches(self) -> list[Search]:
        return [Search(e) for e in self.entries]


def _sums(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``part``, ``entry``, ``n`` and ``total`` (by component) of the nearest vectors; a task sends one row for each entry at most."""
    parts, entries, inner = books.entries.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches, counts, totals = books.searches(), np.zeros((parts, entries), np.int64), np.zeros((parts, entries, inner), np.int64)
        for batch in _joined(batches):
            for p, queries in enumerate(_cut(batch.column(0), parts * inner, parts)):
                at, _ = searches[p].nearest(queries)
                order = np.argsort(at, kind="stable")
                used, first = np.unique(at[order], return_index=True)
                counts[p] += np.bincount(at, minlength=entries)
                totals[p, used] += np.add.reduceat(queries[order], first)
        part, entry = np.nonzero(counts)
        sums = pa.array(totals[part, entry].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), sums], ["part", "entry", "n", "total"])

    sent = vectors.select("vector").mapInArrow(work, "part int, entry int, n bigint, total array<bigint>")
    # the sums of many tasks need more than 64 bits only for absurd inputs, which decimals hold too
    by_component = F.transform(F.sequence(F.lit(0), F.lit(inner - 1)), lambda i: F.element_at("total", i + 1))
    split = sent.select("part", "entry", "n", F.posexplode(by_component).alias("place", "x"))
    return split.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("total"))


def trained(vectors: DataFrame, key: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks from the parts of the first ids, moved to the mean of their vectors in each round; None without vectors.

    ``vectors`` has the key and ``vector``, whole numbers of one length.
    """
    first = vectors.select(key, "vector").orderBy(F.col(key).asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return None
    start = np.array([r["vector"] for r in first], np.int64)
    books = Codebooks(start.reshape(len(first), parts, -1).swapaxes(0, 1).copy())
    for _ in range(rounds):
        moved = books.entries.copy()
        for r in _sums(vectors, books).collect():  # parts x entries x components at most
            moved[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
        books = Codebooks(moved)
    return books


def encoded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` (``row``, ``vector``) as ``row``, ``code`` (two hexadecimal digits for each part) and ``error``."""
    parts, _, inner = books.entries.shape
    schema = StructType([rows.schema["row"], StructField("code", StringType()), StructField("error", LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = books.searches()
        for batch in _joined(batches):
            codes, error = np.zeros((batch.num_rows, parts), np.uint8), np.zeros(batch.num_rows, np.int64)
            for p, queries in enumerate(_cut(batch.column(1), parts * inner, parts)):
                at, squared = searches[p].nearest(queries)
                codes[:, p] = at
                error += squared
            digits, width = codes.tobytes().hex(), 2 * parts
            written = [digits[i : i + width] for i in range(0, len(digits), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(written, pa.string()), pa.array(error)], ["row", "code", "error"])

    return rows.select("row", "vector").mapInArrow(work, schema)


def quantised(table: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """All usable rows as ``row`` (without the vector), ``code``, ``error``, written once, and the codebooks; at most 256 entries."""
    if not 0 < entries <= 256:
        raise ValueError("codes have two hexadecimal digits for each part")
    row = F.struct(*(F.col(f"`{c}`") for c in table.columns if c != vector)).alias("row")
    kept = table.where(usable(vector)).select(row, F.col(f"`{key}`").alias("key"), whole(vector).alias("vector"))
    first = kept.orderBy(F.col("key").asc_nulls_last(), "vector").select(F.size("vector")).first()
    width = first[0] if first else 0
    fitting = kept.where((F.size("vector") == width) & F.lit(width % parts == 0))
    books = trained(fitting, "key", parts, entries, rounds)
    if books is None:
        return fitting.select("row", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None
    return stored(encoded(fitting, books), "codes"), books


def by_label(codes: DataFrame, label: str) -> DataFrame:
    """``codes`` with ``label_error``, the error of all rows of a label; tasks add up their own rows first."""
    named = codes.select("*", F.col(f"row.`{label}`").alias("label"))
    total = stored(named.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    return named.join(total, F.col("label").eqNullSafe(F.col("of"))).drop("label", "of")
