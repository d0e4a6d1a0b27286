"""License scans by a positional index of rare words.

Every licence is a template: words, with mandatory key phrases in square brackets. The index has a
posting (phrase, offset) for each word of a key phrase. How rare a word is comes from its document
frequency over the whole table. For a text, its licence words are looked up from the highest IDF
down; a posting turns the places of a word into places where its phrase would start, and the
postings of a phrase are intersected by that relative position, rarest first, until enough words
agree. What is left is verified: every word of the phrase, and every mandatory phrase of the
template at about its own distance from the first. No phrase is missed, since all its words stand in a text
that has it, however rare they are.

A place is scored by the share of the template's words, weighted by IDF, that stand where they
should, give or take ``SLACK`` words. Counting needs a row for each licence word from each task,
scanning nothing but the text itself: no texts are shuffled, and a lost task is simply run again.

Defined results: words are runs of digits, letters a-z after lower-casing A-Z, and characters
beyond ASCII; NULL is the empty text, without words and places; very long texts are scanned whole;
repeated rows and rows of one key are scanned each for itself and count as often; equal IDFs are ordered by
the word, so ties change nothing; a table without rows gives an empty result; input columns but
the text ride along in ``row``, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from stratiform.llm.base import filled

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices of public licences, key phrases in brackets.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache-2.0", "licensed under the [apache license version 2 0]"),
    ("apache-2.0", "[licensed under the apache license] version 2 0 the license you [may not use this file except in compliance with the license]"),
    ("mit", "released under the [mit license]"),
    ("mit", "[permission is hereby granted free of charge to any person obtaining a copy] of this software and associated documentation files the software to deal in the software without restriction"),
    ("bsd", "[redistribution and use in source and binary forms with or without modification] are permitted provided that the following conditions are met"),
    ("bsd", "licensed under the [bsd license]"),
    ("isc", "[permission to use copy modify and or distribute this software for any purpose] with or without fee is hereby granted"),
    ("gpl-2.0", "licensed under the [gnu general public license version 2]"),
    ("gpl-3.0", "this work is licensed under the [gnu general public license version 3]"),
    ("gpl", "this program is free software you can [redistribute it and or modify it under the terms of the gnu general public license]"),
    ("lgpl", "licensed under the [gnu lesser general public license]"),
    ("agpl", "licensed under the [gnu affero general public license]"),
    ("mpl-2.0", "this source code form is subject to the terms of the [mozilla public license v 2 0]"),
    ("mpl-2.0", "licensed under the [mozilla public license version 2 0]"),
    ("epl", "made available under the terms of the [eclipse public license]"),
    ("cc-by-nc", "licensed under [cc by nc] 4 0"),
    ("cc-by-nd", "licensed under [cc by nd] 4 0"),
    ("cc-by-sa", "licensed under [cc by sa] 4 0"),
    ("cc-by", "licensed under a [creative commons attribution] 4 0 international license"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain [cc0]"),
    ("unlicense", "this is free and unencumbered software [released into the public domain]"),
    ("spdx", "[spdx license identifier]"),
    ("copyright", "[copyright c]"),
)

ANCHORS = 3  # words of a phrase whose places are intersected before the rest is verified
SLACK, DRIFT = 3, 12  # words that a word, or a whole mandatory phrase, may be off its place

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Template:
    """Words of a licence and where its mandatory phrases are; ``base`` ones are their phrase and nothing else."""

    label: str
    words: tuple[bytes, ...]
    phrases: tuple[tuple[int, tuple[bytes, ...]], ...]
    base: bool = False

    @classmethod
    def of(cls, label: str, notice: str, base: bool = False) -> Template:
        words, phrases = [], []
        for n, part in enumerate(re.split(r"[\[\]]", notice)):
            own = words_of(part.encode())
            if n % 2:
                phrases.append((len(words), tuple(own)))
            words += own
        if not phrases or not all(p for _, p in phrases):
            raise ValueError(f"template {label!r} needs key phrases")
        return cls(label, tuple(words), tuple(phrases), base)


@dataclass(frozen=True)
class Place:
    label: str
    base: bool
    start: int
    length: int
    share: float


@dataclass(frozen=True)
class Index:
    """Postings of the words of all mandatory phrases, and the IDF of every licence word."""

    templates: tuple[Template, ...]
    idf: Mapping[bytes, float] = field(default_factory=dict)

    @cached_property
    def vocabulary(self) -> frozenset[bytes]:
        return frozenset(w for t in self.templates for w in t.words)

    @cached_property
    def postings(self) -> dict[bytes, list[tuple[int, int, int]]]:
        """Of each word: template, phrase and offset in it."""
        found = defaultdict(list)
        for t, template in enumerate(self.templates):
            for n, (_, phrase) in enumerate(template.phrases):
                for offset, word in enumerate(phrase):
                    found[word].append((t, n, offset))
        return dict(found)

    @cached_property
    def mandatory(self) -> list[frozenset[bytes]]:
        return [frozenset(w for _, phrase in t.phrases for w in phrase) for t in self.templates]

    def rarest(self, words: Iterator[bytes]) -> list[bytes]:
        return sorted(words, key=lambda w: (-self.idf.get(w, math.inf), w))

    def places(self, words: list[bytes]) -> list[Place]:
        """Every verified place of a template in a text, by start."""
        present = self.vocabulary.intersection(words)
        open_ = {t for t, needed in enumerate(self.mandatory) if needed <= present}
        if not open_:
            return []
        where = defaultdict(list)
        for place, word in enumerate(words):
            if word in present:
                where[word].append(place)
        starts: dict[tuple[int, int], set[int]] = {}
        agreed = Counter()
        for word in self.rarest(w for w in present if w in self.postings):
            for t, n, offset in self.postings[word]:
                if t in open_ and agreed[t, n] < ANCHORS:
                    shifted = {p - offset for p in where[word]}
                    starts[t, n] = starts[t, n] & shifted if (t, n) in starts else shifted
                    agreed[t, n] += 1
                    if not starts[t, n]:
                        open_.discard(t)
        found = [p for t in sorted(open_) for p in self._verified(t, words, where, starts)]
        return sorted(found, key=lambda p: (p.start, not p.base, p.label, p.length))

    def _verified(self, t: int, words: list[bytes], where: Mapping[bytes, list[int]], starts: Mapping[tuple[int, int], set[int]]) -> Iterator[Place]:
        template = self.templates[t]
        own = [sorted(s for s in starts[t, n] if s >= 0 and tuple(words[s : s + len(phrase)]) == phrase) for n, (_, phrase) in enumerate(template.phrases)]
        at = template.phrases[0][0]
        others = [(set(places), offset - at) for places, (offset, _) in zip(own[1:], template.phrases[1:])]
        near = [0, *(d for n in range(1, DRIFT + 1) for d in (n, -n))]
        for start in own[0]:
            if all(any(start + offset + d in places for d in near) for places, offset in others):
                yield Place(template.label, template.base, start, len(template.phrases[0][1]), self._share(template, words, start - at))

    def _share(self, template: Template, words: list[bytes], start: int) -> float:
        """Share of the template's weight that stands in its place."""
        weight = [self.idf.get(w, 1.0) for w in template.words]
        there = [w in words[max(0, start + q - SLACK) : max(0, start + q + SLACK + 1)] for q, w in enumerate(template.words)]
        whole = sum(weight)
        return sum(x for x, is_there in zip(weight, there) if is_there) / whole if whole else sum(there) / len(there)


def templates(base: Mapping[str, str] = BASE, notices: Sequence[tuple[str, str]] = TEMPLATES) -> tuple[Template, ...]:
    return tuple([*(Template.of(label, f"[{phrase}]", True) for phrase, label in base.items()), *(Template.of(*n) for n in notices)])


def document_frequencies(docs: DataFrame, vocabulary: frozenset[bytes], text: str = "text") -> DataFrame:
    """``word`` and ``n``, the rows that have it, of each word of the vocabulary that occurs; NULL for the number of all rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for value in batch.column(0):
                found.update(vocabulary.intersection(words_of(value.as_buffer().to_pybytes())))
        listed = [(None, rows), *found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in listed], pa.binary()).cast(pa.string()), pa.array([n for _, n in listed], pa.int64())], ["word", "n"])

    counted = docs.select(filled(text).alias("text")).mapInArrow(work, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def index(docs: DataFrame, text: str = "text", known: tuple[Template, ...] | None = None) -> Index:
    """The index with IDFs of a whole table; the driver sees a number for each word of the templates."""
    bare = Index(templates() if known is None else known)
    counts = {r["word"]: r["n"] for r in document_frequencies(docs, bare.vocabulary, text).collect()}
    rows = counts.get(None, 0)
    return Index(bare.templates, {w: math.log((rows + 1) / (counts.get(w.decode(), 0) + 1)) for w in bare.vocabulary})


PLACES = ArrayType(StructType([StructField("label", StringType()), StructField("base", BooleanType()), StructField("start", LongType()), StructField("length", LongType()), StructField("share", DoubleType())]))


def scanned(docs: DataFrame, known: Index, text: str = "text") -> DataFrame:
    """All rows as ``row`` (without the text) with ``n_words`` and ``places``: label, base, start (words from 0), length (of its first key phrase), share."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("row")
    rows = docs.select(row, filled(text).alias("text"))
    schema = StructType([rows.schema["row"], StructField("n_words", LongType()), StructField("places", PLACES)])
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("length", pa.int64()), ("share", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places = [], []
            for value in batch.column(1):
                words = words_of(value.as_buffer().to_pybytes())
                counts.append(len(words))
                places.append([vars(p) for p in known.places(words)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(places, kind)], ["row", "n_words", "places"])

    return rows.mapInArrow(work, schema)
