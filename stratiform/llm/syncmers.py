"""Fingerprints of closed syncmers over the bytes of a text.

A k-mer is ``k`` consecutive UTF-8 bytes of the text with each run of white space as one space and
none at its ends. It is an anchor when the least hash of the runs of ``s`` bytes
inside it lies at its first or last place, ties included. Whether a k-mer is an anchor depends on
its own bytes and nothing else, so an edit elsewhere in the text leaves it in place, and any ``2 * k - s - 1``
bytes hold one, whatever the script and with or without spaces. A fingerprint
is the 32-bit hashes of the anchors in the order of the text. All of it is DataFrame
functions; a text is never taken apart into rows, and a very long one is looked at in blocks.

Defined results: white space is space and tab to carriage return; NULL is
the empty text; a text of white space has the empty fingerprint; one with fewer than ``k`` bytes
has one anchor, all of it; two empty fingerprints are alike by 1, an empty and another by 0; rows
with one key follow each other by the MD5 of their text and a NULL key comes last; a table of one
row is followed by itself; an empty table gives an empty result; input columns ride along in ``row``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.base import filled, partitions, stored

K, S = 12, 4  # bytes of a k-mer and of the runs inside it
BLOCK = 1 << 14  # k-mers of a text that are looked at together
PARTS = 4  # ranges of keys for each shuffle partition


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _hashed(part: Column) -> Column:
    return F.shiftright(F.xxhash64(part), 32).cast("int")


def _squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")).cast("binary")


def _closed(block: Column, first: Column, k: int, s: int) -> Column:
    """Places and hashes of the closed syncmers of at least ``k`` bytes that begin at ``first``, in order."""
    last = k - s  # place of the last run in a k-mer
    inner = last - 1  # runs between the first and the last

    def least(h: Column, step: int) -> Column:
        return F.zip_with(h, F.slice(h, step + 1, F.greatest(F.lit(0), F.size(h) - step)), lambda a, b: F.least(a, b))

    def chosen(edges: Column, of_inner: Column, width: int) -> Column:
        """K-mers whose edges are no larger than the least of ``width`` inner runs from either side."""

        def closed(i: Column) -> Column:
            return reduce(and_, (of_inner[i + n] >= edges[i] for n in ([1, last - width] if inner else [])), F.lit(True))

        places = F.filter(F.sequence(F.lit(0), F.length(block) - k), closed)
        return F.transform(places, lambda i: F.struct((first + i).alias("place"), _hashed(F.substring(block, i + 1, k)).alias("mark")))

    def widened(edges: Column, of_inner: Column, width: int) -> Column:
        if 2 * width > inner:
            return chosen(edges, of_inner, width)
        return _named(least(of_inner, width), lambda wider: widened(edges, wider, 2 * width))

    runs = F.transform(F.sequence(F.lit(1), F.length(block) - s + 1), lambda i: F.xxhash64(F.substring(block, i, s)))
    return _named(runs, lambda r: _named(least(r, last), lambda edges: widened(edges, r, 1)))


def placed(text: Column, k: int = K, s: int = S) -> Column:
    """The closed syncmers of a text, in order: ``place`` in its squeezed bytes and ``mark``, the hash."""

    def of_bytes(b: Column) -> Column:
        # blocks overlap by k - 1 bytes, so each k-mer lies in one
        firsts = F.sequence(F.lit(0), F.length(b) - k, F.lit(BLOCK))
        blocks = F.flatten(F.transform(firsts, lambda first: _named(F.substring(b, first + 1, BLOCK + k - 1), lambda block: _closed(block, first, k, s))))
        whole = F.array(F.struct(F.lit(0).alias("place"), _hashed(b).alias("mark")))
        return F.when(F.length(b) >= k, blocks).when(F.length(b) > 0, whole).otherwise(F.array().cast("array<struct<place:int,mark:int>>"))

    return _named(_squeezed(text), of_bytes)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Hashes of the closed syncmers of a text, in order."""
    return placed(text, k, s)["mark"]


def _ends_by(size: Column, k: int) -> Callable[[Column], Column]:
    return lambda anchor: anchor["place"] <= size - k


def joined_anchors(head: Column, of_head: Column, tail: Column, of_tail: Column, k: int = K, s: int = S) -> Column:
    """``anchors`` of ``head`` and ``tail`` put together, where ``of_head`` and ``of_tail`` are ``placed`` of texts that begin with them.

    A k-mer inside one part is an anchor of the whole if it is one of the part, so only those across the border are looked at.
    """

    def of_sizes(x: Column) -> Column:
        whole, n_head, n_tail = x["whole"], x["n_head"], x["n_tail"]
        start = F.greatest(F.lit(0), n_head - (k - 1))
        stop = F.least(F.length(whole), F.length(whole) - n_tail + (k - 1))
        across = F.when(stop - start >= k, _closed(F.substring(whole, start + 1, stop - start), start, k, s)["mark"]).otherwise(F.array().cast("array<int>"))
        inside = [F.filter(found, _ends_by(n, k))["mark"] for found, n in ((of_head, n_head), (of_tail, n_tail))]
        short = F.when(F.length(whole) > 0, F.array(_hashed(whole))).otherwise(F.array().cast("array<int>"))
        return F.when(F.length(whole) >= k, F.concat(inside[0], across, inside[1])).otherwise(short)

    sizes = F.struct(
        _squeezed(F.concat(head, tail)).alias("whole"), F.length(_squeezed(head)).alias("n_head"), F.length(_squeezed(tail)).alias("n_tail"),
    )
    return _named(sizes, of_sizes)


def written(marks: Column) -> Column:
    """Anchors as text, eight hexadecimal digits each."""
    return F.lower(F.array_join(F.transform(marks, lambda a: F.right(F.hex(a.cast("bigint") + (1 << 32)), F.lit(8))), ""))


def likeness(a: Column, b: Column) -> Column:
    """Twice the different anchors in both over those in each: 1 for the same, 0 for nothing shared."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    sizes = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(sizes == 0, F.lit(1.0)).otherwise(2 * both / sizes)


def ranged(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``part``: ranges of the key with about as many rows each, NULL in the last."""
    parts = PARTS * partitions(docs.sparkSession)
    cuts = docs.approxQuantile(key, [n / parts for n in range(1, parts)], 0.1 / parts)
    cuts = [float("-inf"), *sorted(set(cuts)), float("inf")] if cuts else [float("-inf"), 0.0, float("inf")]
    cut = Bucketizer(splits=cuts, inputCol="range_key", outputCol="range", handleInvalid="keep")
    return cut.transform(docs.withColumn("range_key", F.col(key).cast("double"))).withColumn("part", F.coalesce(F.col("range").cast("int"), F.lit(len(cuts)))).drop("range_key", "range")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """All rows as ``row`` (without the text) with ``text``, ``found`` (anchors with their places), ``next_text`` and ``next_found``, those of the row with the next key.

    Rows are shuffled once, by ranges of the key; the first row of each range also goes to the end
    of the range before. No range is larger than its share, and nothing is sorted in one task.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text))
    rows = docs.select(row.alias("row"), F.col(key).alias("key"), filled(text).alias("text"))
    rows = ranged(rows, "key").withColumn("tie", F.md5("text")).withColumn("last", F.col("key").isNull()).withColumn("guest", F.lit(False))
    order = F.struct("last", "key", "tie")
    firsts = stored(rows.groupBy("part").agg(F.min_by(F.struct("row", "key", "text", "tie", "last"), order).alias("first")), "range-firsts")
    # as many rows as there are ranges
    ring = Window.partitionBy(F.lit(0)).orderBy("part")
    before = F.coalesce(F.lag("part").over(ring), F.max("part").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    guests = firsts.select("first.*", before.alias("part"), F.lit(True).alias("guest"))
    dealt = rows.unionByName(guests).repartition(partitions(docs.sparkSession), "part").sortWithinPartitions("part", "guest", "last", "key", "tie")
    marked = dealt.withColumn("found", placed(F.col("text"), k, s))
    following = Window.partitionBy("part").orderBy("guest", "last", "key", "tie")
    paired = marked.withColumn("next", F.lead(F.struct("text", "found")).over(following))
    return paired.where("NOT guest").select("row", "text", "found", F.col("next.text").alias("next_text"), F.col("next.found").alias("next_found"))


def halves(text: Column, following: Column) -> tuple[Column, Column]:
    """The parts of the text whose second half is replaced by the beginning of another."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.left(text, F.length(text) - half), F.left(following, half)


def half_edited(text: Column, following: Column) -> Column:
    """The text with its second half replaced by the beginning of another."""
    return F.concat(*halves(text, following))
