"""Repeated passages: windows of words that occur more than once, by super-k-mers.

A window is ``window`` consecutive words of one text. Its minimiser is the least hash of the
``minimiser`` consecutive words inside it, the leftmost if tied. Consecutive windows that share a
minimiser at one place form a super-k-mer, which travels as one string of words to the bucket of
its minimiser. There the windows of all strings are sorted and equal neighbours counted, on the words
themselves. Windows that are equal have equal minimisers, so they always meet, and a super-k-mer
whose minimiser occurs once in the corpus has no equal and stays where it is.

Equal texts are taken once, with their number of copies; each of their windows occurs elsewhere
anyway. Equal strings of a bucket travel once with their count. A bucket with more than
``HOT`` different strings is dealt out anew by the windows themselves.

Defined results: NULL texts and texts without words have no windows and keep nothing; a text
shorter than a window keeps all its words unless it is one; repeated rows are copies of
each other; an empty table gives an empty result; input columns ride along in ``row``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.base import distinct_texts, stored, text_key
from stratiform.llm.words import runs, word_hashes

WINDOW = 50  # words
MINIMISER = 8  # words
HOT = 5_000  # different strings of a bucket that one task sorts


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """Where each stretch of ``width`` hashes has its least one, the leftmost if tied."""
    view = np.lib.stride_tricks.sliding_window_view(hashes, width)
    at = [view[n : n + 65536].argmin(axis=1) for n in range(0, len(view), 65536)]
    return np.concatenate(at) + np.arange(len(view))


def super_kmers(data: bytes, window: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of each super-k-mer of a text."""
    words = word_hashes(data)
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = runs(words, minimiser)
    places = _least_places(hashes, window - minimiser + 1)
    first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
    return hashes[places[first]], first, np.diff(np.append(first, len(places)))


def _spans(texts: DataFrame, window: int, minimiser: int) -> DataFrame:
    """``minimiser``, ``key``, ``first`` and ``windows`` of all super-k-mers; written once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for n, text in enumerate(batch.column(1)):
                found.append(super_kmers(text.as_py().encode(), window, minimiser))
                rows.append(np.full(len(found[-1][0]), n))
            hashes, first, windows = (np.concatenate(x) for x in zip(*found))
            keys = batch.column(0).take(pa.array(np.concatenate(rows) if rows else [], pa.int64()))
            made = [pa.array(hashes.view(np.int64)), keys, pa.array(first.astype(np.int32)), pa.array(windows.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(made, ["minimiser", "key", "first", "windows"])

    return stored(texts.select("key", "text").mapInArrow(cut, "minimiser bigint, key binary, first int, windows int"), "super-k-mers")


def _strings(texts: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """``minimiser``, ``key``, ``first``, ``words`` (packed) and ``copies`` of the given super-k-mers."""
    wanted = spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("first", "windows", "minimiser"))).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(5)]
            for key, text, copies, own in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.encode().split()
                for span in own:
                    packed = b" ".join(words[span["first"] : span["first"] + span["windows"] + window - 1])
                    for column, value in zip(out, (span["minimiser"], key, span["first"], packed, copies)):
                        column.append(value)
            types = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["minimiser", "key", "first", "words", "copies"])

    joined = texts.join(wanted, "key").select("key", "text", "copies", "spans")
    return joined.mapInArrow(cut, "minimiser bigint, key binary, first int, words binary, copies bigint")


def _windows(packed: bytes, window: int) -> list[bytes]:
    words = packed.split(b" ")
    return [b" ".join(words[n : n + window]) for n in range(len(words) - window + 1)]


def _stretches(places: list[int]) -> list[tuple[int, int]]:
    """First and last of each stretch of consecutive numbers."""
    runs_ = groupby(enumerate(sorted(places)), lambda x: x[1] - x[0])
    return [(own[0][1], own[-1][1]) for own in (list(g) for _, g in runs_)]


def _repeated_in_buckets(strings: DataFrame, window: int) -> DataFrame:
    """``string``, ``a``, ``b``: windows a to b of a string occur again; sorted bucket by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out = []
        for _, bucket in groupby(rows(), lambda r: r[0]):
            seen = sorted((w, string, n, copies) for _, string, packed, copies in bucket for n, w in enumerate(_windows(packed, window)))
            hit = {}
            for _, equal in groupby(seen, lambda s: s[0]):
                equal = list(equal)
                if sum(copies for *_, copies in equal) > 1:
                    for _, string, n, _ in equal:
                        hit.setdefault(string, []).append(n)
            out += [(string, a, b) for string, places in hit.items() for a, b in _stretches(places)]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    types, names = (pa.binary(), pa.int32(), pa.int32()), ["string", "a", "b"]
    sorted_ = strings.select("minimiser", "string", "words", "copies").repartition("minimiser").sortWithinPartitions("minimiser")
    return sorted_.mapInArrow(count, "string binary, a int, b int")


def _repeated_by_window(strings: DataFrame, window: int) -> DataFrame:
    """The same for hot buckets: each window goes where its own 128-bit digest sends it."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(4)]
            for string, packed, copies in zip(*(c.to_pylist() for c in batch.columns)):
                for n, w in enumerate(_windows(packed, window)):
                    for column, value in zip(out, (string, n, hashlib.blake2b(w, digest_size=16).digest(), copies)):
                        column.append(value)
            types = (pa.binary(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["string", "n", "digest", "copies"])

    dealt = strings.select("string", "words", "copies").mapInArrow(deal, "string binary, n int, digest binary, copies bigint")
    again = dealt.groupBy("digest").agg(F.sum("copies").alias("times")).where("times > 1").select("digest")
    return dealt.join(again, "digest").select("string", F.col("n").alias("a"), F.col("n").alias("b"))


def repeated_windows(texts: DataFrame, window: int, minimiser: int) -> DataFrame:
    """``key``, ``a``, ``b``: windows a to b of a text (see ``distinct_texts``) occur elsewhere too."""
    spans = _spans(texts, window, minimiser)
    # written, so that the join shuffles both sides and a minimiser of very many is split
    again = stored(spans.groupBy("minimiser").agg(F.count("*").alias("n")).where("n > 1").select("minimiser"), "minimisers")
    rows = stored(_strings(texts, spans.join(again, "minimiser"), window).withColumn("string", F.unhex(F.md5("words"))), "strings")
    # the string decides its minimiser, so its digest alone names it
    strings = rows.groupBy("string").agg(F.first("minimiser").alias("minimiser"), F.first("words").alias("words"), F.sum("copies").alias("copies"))
    strings = stored(strings, "different-strings")
    hot = stored(strings.groupBy("minimiser").agg(F.count("*").alias("n")).where(f"n > {HOT}").select("minimiser"), "hot")
    quiet = _repeated_in_buckets(strings.join(hot, "minimiser", "left_anti"), window)
    found = quiet.unionByName(_repeated_by_window(strings.join(hot, "minimiser", "left_semi"), window))
    places = rows.select("key", "first", "string").join(stored(found, "repeated"), "string")
    return places.select("key", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))


def without_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """All rows as ``row`` with ``n_words``, ``n_removed``, ``removed`` (spans of words, end exclusive) and ``kept_text``.

    Each word that a repeated window covers is removed, every occurrence of it; windows are judged
    on the texts as they came.
    """
    minimiser = min(minimiser, window)
    texts = distinct_texts(docs, text)
    found = repeated_windows(texts, window, minimiser).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(5)]
            for key, value, copies, own in zip(*(c.to_pylist() for c in batch.columns)):
                words = value.encode().split()
                drop = np.zeros(len(words) + 1, np.int64)
                if copies > 1 and len(words) >= window:
                    own = [{"a": 0, "b": len(words) - window}]
                for span in own or ():
                    drop[span["a"]] += 1
                    drop[span["b"] + window] -= 1
                gone = drop.cumsum()[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]
                kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
                for column, x in zip(out, (key, len(words), int(gone.sum()), spans, kept)):
                    column.append(x)
            types = (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["key", "n_words", "n_removed", "removed", "kept_text"])

    schema = "key binary, n_words bigint, n_removed bigint, removed array<struct<start: bigint, end: bigint>>, kept_text string"
    joined = texts.join(found, "key", "left").select("key", "text", "copies", "spans")
    return stored(joined.mapInArrow(cut, schema), "kept-texts")


def cleaned(docs: DataFrame, text: str = "text", window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """All rows of ``docs`` as ``row`` (without the text) with what ``without_repeats`` found for their texts."""
    found = without_repeats(docs, text, window, minimiser)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text))
    rows = docs.select(row.alias("row"), text_key(text).alias("key"))
    return rows.join(found, "key").drop("key")
