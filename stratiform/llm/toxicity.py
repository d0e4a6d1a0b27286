"""Toxicity of texts after undoing obfuscation: noisy-channel decoding, then a score of what was meant.

A word as written may hide the word as meant: digits and signs for letters, letters set apart by
spaces or signs, letters drawn out. Each such word opens a lattice of letters for each character,
with a cost for every change, and Viterbi finds the letters that are likeliest under a trigram model
of characters counted over all texts. Of letters set apart, each gap may be dropped or stay as a word border, so
the same search finds the words. Words that no change applies to have one path
and stay as they are. A text is then the set of its restored words and word beginnings, scored by a logistic
model fitted to labelled rows.

Bounds: the character model has at most 29 ** 3 counts; the classifier is fitted on ``SAMPLE``
labelled rows with different texts, those first by the MD5 of their key, and keeps ``FEATURES``
features. Everything else covers all rows and whole texts.

Defined results: NULL and empty texts have no features and score as the model's constant; rows
whose label or key is NULL are not learned from; a key with several labels counts as toxic if one is; repeated rows score alike;
without labelled rows of both kinds every score is 0; an empty table gives an empty result; label, language, source
and key are no inputs of a score; input columns ride along in ``row``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stratiform.llm.base import filled, stored

SAMPLE = 20_000  # labelled rows that the classifier is fitted on
FEATURES = 2_000  # of the classifier
LEAST_ROWS = 5  # labelled rows that a feature is in, and that it would have of the label it speaks against
ODDS = 2  # times that a feature's odds differ from those of the rows without it, up or down
RIDGE, STEP, ROUNDS = 0.03, 1.0, 1500  # of the fit

# The letters that digits and signs are written for.
MEANT = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i",
}
CHANGED, DROPPED, DRAWN_OUT, KEPT_SIGN = 0.7, 0.5, 0.2, 1.5  # costs of the channel, as -log p
BORDER, WIDE_DROPPED = 0.5, 2.0  # of a gap between letters set apart that stays, of a wider one that does not

EDGE, OTHER, DIGIT, CLASSES = 0, 27, 28, 29  # classes of characters; letters are 1 to 26
_BYTE_CLASS = np.full(256, EDGE, np.int64)
_BYTE_CLASS[[*b"abcdefghijklmnopqrstuvwxyz"]] = np.arange(1, 27)
_BYTE_CLASS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = np.arange(1, 27)
_BYTE_CLASS[[*b"0123456789"]] = DIGIT
_BYTE_CLASS[0xC0:] = OTHER

_SIGNS = re.escape("".join(c for c in MEANT if not c.isdigit()))
_TOKEN = re.compile(r"\S+")
_GAP = re.compile(r"[ .\-_*]+")
_TAIL = re.compile(r"([^\w\s$@€£])\1+$")  # a sign repeated at the end is ornament, but for those written for letters only
_SPACED = re.compile(rf"(?<!\S)(?:[\w{_SIGNS}][ .\-_*]+){{2,}}[\w{_SIGNS}](?=[^\w\s]*(?!\S))")
_HIDDEN = re.compile(rf"[^\W\d_][\d{_SIGNS}.\-_*]+[^\W\d_]|(?:^|\W)[\d{_SIGNS}]+[^\W\d_]|[^\W\d_][\d{_SIGNS}]+(?:$|\W)|([^\W\d_])\1\1")
_WORD = re.compile(r"[^\W\d_]+")


def char_class(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return DIGIT if c.isdigit() else OTHER if c.isalpha() else EDGE


def trigrams(texts: list[str]) -> np.ndarray:
    """Counts of runs of three classes; runs of what is not a letter or digit are one edge."""
    raw = np.frombuffer(" ".join(["", *texts, ""]).encode(), np.uint8)
    raw = raw[(raw & 0xC0) != 0x80]
    classes = _BYTE_CLASS[raw]
    kept = classes[np.concatenate(([True], (classes[1:] != EDGE) | (classes[:-1] != EDGE)))]
    return np.bincount((kept[:-2] * CLASSES + kept[1:-1]) * CLASSES + kept[2:], minlength=CLASSES**3)


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """-log of each class after each two, from the counts of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                total += trigrams([value])
        runs = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array(total[runs])], ["run", "n"])

    counted = docs.select(filled(text).alias("text")).mapInArrow(count, "run bigint, n bigint").groupBy("run").agg(F.sum("n").alias("n"))
    counts = np.full((CLASSES, CLASSES, CLASSES), 0.1)
    for run, n in counted.collect():  # CLASSES ** 3 rows at most
        counts.reshape(-1)[run] += n
    return -np.log(counts / counts.sum(axis=2, keepdims=True))


def _arcs(word: str) -> list[list[tuple[str, float]]]:
    """The lattice: what each character may stand for, and at what cost; '' drops it."""
    out = []
    for n, c in enumerate(word):
        if c.isalpha():
            arcs = [(c, 0.0)]
            if word[max(0, n - 2) : n + 1].count(c) > 1 and n and word[n - 1] == c and (word[n - 2 : n - 1] == c or word[n + 1 : n + 2] == c):
                arcs.append(("", DRAWN_OUT))
        elif c in MEANT:
            repeated = c in "$@€£" and c in (word[n - 1 : n], word[n + 1 : n + 2])
            arcs = [(x, CHANGED) for x in MEANT[c]] + [(c, KEPT_SIGN)] + ([] if c.isdigit() else [("", 2 * KEPT_SIGN if repeated else DROPPED)])
        else:
            arcs = [(c, KEPT_SIGN), ("", DROPPED)]
        out.append(arcs)
    return out


def _spaced_arcs(written: str) -> list[list[tuple[str, float]]]:
    """The lattice of letters set apart: gaps are dropped or stay as borders."""
    letters = iter(_arcs(_GAP.sub("", written)))
    parts = re.findall(rf"{_GAP.pattern}|.", written)
    return [next(letters) if not _GAP.fullmatch(x) else [("", 0.0 if len(x) == 1 else WIDE_DROPPED), (" ", BORDER if len(x) == 1 else 0.0)] for x in parts]


def likeliest(lattice: list[list[tuple[str, float]]], cost: np.ndarray) -> str:
    """The likeliest letters of a lattice of any length; paths are linked back, not copied."""
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
    for arcs in lattice:
        step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (total, path) in best.items():
            for letter, price in arcs:
                if letter:
                    c = char_class(letter)
                    to, paid, made = (b, c), total + price + cost[a, b, c], (letter, path)
                else:
                    to, paid, made = (a, b), total + price, path
                if to not in step or paid < step[to][0]:
                    step[to] = (paid, made)
        best = step
    path = min(((total + cost[a, b, EDGE], (a, b)) for (a, b), (total, _) in best.items()))[1]
    letters, at = [], best[path][1]
    while at is not None:
        letter, before = at
        letters.append(letter)
        at = before
    return "".join(reversed(letters))


def restored(word: str, cost: np.ndarray) -> str:
    """The likeliest letters behind a word as written."""
    return likeliest(_arcs(word), cost)


@dataclass
class Decoder:
    """Restores texts; words seen lately are remembered."""

    cost: np.ndarray
    seen: dict[str, str] = field(default_factory=dict)
    longest: int = 64  # characters of a word that is remembered

    def word(self, word: str) -> str:
        if len(word) > self.longest:
            return restored(word, self.cost)
        if word not in self.seen:
            if len(self.seen) > 200_000:
                self.seen.clear()
            self.seen[word] = restored(word, self.cost)
        return self.seen[word]

    def spaced(self, written: str) -> str:
        """Letters that were set apart, put together into words and restored."""
        return likeliest(_spaced_arcs(written), self.cost)

    def token(self, token: str) -> str:
        """A token restored if it may hide a word, else as it is."""
        token = _TAIL.sub("", token)
        return self.word(token) if _HIDDEN.search(token) else token

    def text(self, text: str) -> str:
        """The whole text, lower-cased and restored."""
        together = _SPACED.sub(lambda m: self.spaced(m[0]), text.lower())
        return _TOKEN.sub(lambda m: self.token(m[0]), together)

    def words(self, text: str) -> set[str]:
        """The different words of a text, as written and as restored."""
        text = text.lower()
        tokens = set(_TOKEN.findall(text))
        found = tokens | {self.token(t) for t in tokens} | {self.spaced(m[0]) for m in _SPACED.finditer(text)}
        return set(_WORD.findall(" ".join(found)))


def features(words: set[str]) -> set[str]:
    """Whole words (with an end mark) and their first 4, 5 and 6 letters."""
    long_ = [w for w in words if len(w) > 2]
    return {w + "$" for w in long_} | {w[:n] for w in long_ for n in (4, 5, 6) if len(w) >= n}


@dataclass
class Model:
    """Character model and classifier; both of bounded size."""

    cost: np.ndarray
    weights: dict[str, float]
    constant: float

    def score(self, decoder: Decoder, text: str) -> float:
        if not self.weights and self.constant == -math.inf:
            return 0.0
        z = self.constant + sum(self.weights.get(f, 0.0) for f in sorted(features(decoder.words(text))))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _sampled(docs: DataFrame, labels: DataFrame, key: str, text: str, sample: int) -> DataFrame:
    """``text_key``, ``text`` and ``toxic`` of at most ``sample`` different texts of at most ``sample`` labelled keys.

    Of the texts of keys that repeat, those with the least hashes are taken.
    """
    known = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max("toxic").alias("toxic"))
    # written, so that its true size decides how it is joined
    picked = stored(known.orderBy(F.md5(F.col("key").cast("string"))).limit(sample), "sampled-labels")
    rows = docs.select(F.col(key).alias("key"), filled(text).alias("text")).join(picked, "key")
    texts = stored(rows.groupBy(F.xxhash64("text").alias("text_key")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")), "sampled-texts")
    if texts.count() <= sample:
        return texts
    last = texts.select("text_key").orderBy("text_key").limit(sample).agg(F.max("text_key")).first()[0]
    return texts.where(F.col("text_key") <= last)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """The model from all texts (characters) and a sample of ``labels`` (``key``, ``toxic``)."""
    cost = character_model(docs, text)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(cost)
        for batch in batches:
            own = [sorted(features(decoder.words(value))) for value in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.string())), batch.column(2)], ["text_key", "features", "toxic"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, positive = Counter(), Counter()
        for batch in batches:
            for own, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.update(own)
                if toxic:
                    positive.update(own)
        names = list(seen)
        for at in range(0, len(names), 10_000):
            some = names[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([seen[f] for f in some], pa.int64()), pa.array([positive[f] for f in some], pa.int64())], ["feature", "n", "p"])

    rows = _sampled(docs, labels, key, text, sample).select("text_key", "text", F.col("toxic").cast("int").alias("toxic"))
    found = stored(rows.mapInArrow(expand, "text_key bigint, features array<string>, toxic int"), "toxic-features")
    everyone = found.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    if not everyone.n or everyone.p in (0, everyone.n):
        return Model(cost, {}, -math.inf)
    n_all, p_all = float(everyone.n), float(everyone.p)
    partial = found.select("features", "toxic").mapInArrow(count, "feature string, n bigint, p bigint")
    counts = partial.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).where(f"n >= {LEAST_ROWS}")

    def term(a, b):
        return F.when(a > 0, a * F.log(a / b)).otherwise(0.0)

    n, p = F.col("n").cast("double"), F.col("p").cast("double")
    share = p_all / n_all
    evidence = term(p, n * share) + term(n - p, n * (1 - share)) + term(p_all - p, p_all - n * share) + term(n_all - n - p_all + p, (n_all - n) - (p_all - n * share))
    odds = (p + 0.5) * (n_all - n - p_all + p + 0.5) / ((n - p + 0.5) * (p_all - p + 0.5))
    for_toxic = (odds >= ODDS) & (n * (1 - share) >= LEAST_ROWS)
    for_clean = (odds <= 1 / ODDS) & (n * share >= LEAST_ROWS)
    kept = counts.where(for_toxic | for_clean).orderBy(evidence.desc(), "feature").limit(FEATURES).select("feature")
    names = [r.feature for r in kept.collect()]
    place = {name: at for at, name in enumerate(names)}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[place[f] for f in row if f in place] for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int32())), batch.column(2)], ["text_key", "places", "toxic"])

    # a row for each text of the sample with its places among the model's features, both bounded
    table = found.mapInArrow(numbered, "text_key bigint, places array<int>, toxic int").toArrow().sort_by("text_key").combine_chunks()
    places = table.column(1).combine_chunks()
    rows_at = np.repeat(np.arange(len(places)), np.diff(places.offsets.to_numpy()))
    columns, truth = places.flatten().to_numpy(), table.column(2).to_numpy().astype(float)
    weights, constant = _logistic(rows_at, columns, truth, len(names))
    return Model(cost, dict(zip(names, weights.tolist())), constant)


def _logistic(rows: np.ndarray, columns: np.ndarray, truth: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weights and constant of a ridge-logistic model on sparse 0/1 features."""
    share = truth.mean()
    weights, constant = np.zeros(width), math.log(share / (1 - share))
    seen, seen_constant = np.full(width, 1e-8), 1e-8
    for _ in range(ROUNDS):
        z = constant + np.bincount(rows, weights[columns], len(truth))
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - truth
        slope = np.bincount(columns, error[rows], width) + RIDGE * weights
        seen += slope * slope
        weights -= STEP * slope / np.sqrt(seen)
        seen_constant += error.sum() ** 2
        constant -= STEP * error.sum() / math.sqrt(seen_constant)
    return weights, float(constant)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows as ``row`` (all columns) with ``score``, the probability of the label 1."""
    rows = docs.select(F.struct("*").alias("row"), filled(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model.cost)
        for batch in batches:
            scores = [model.score(decoder, t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["row", "score"])

    return rows.mapInArrow(work, StructType([rows.schema["row"], StructField("score", DoubleType())]))
