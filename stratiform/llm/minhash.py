"""Near-duplicate documents: banded MinHash candidates, verified by sequential Bayesian comparison.

A document is its set of word shingles; documents with equal sets are one node. Nodes that agree
on a band of their signatures are candidates. The signatures of a candidate pair are compared a
batch of hashes at a time, and the pair is given up once the posterior probability (under an even
prior) that its similarity reaches the threshold falls below ``MISS``. What survives is verified
on the full sets.

A bucket of m nodes does not become m * m pairs. Every node is first compared with the smallest of
its bucket. Then only buckets whose nodes are not in one component yet are gone through, blocks of nodes
against blocks, each in one task: the signatures first, which names the nodes that may still be
linked, and then these with their texts. A task sends on the links that join components and no
others, at most one for each node, so no link is left out that could join two components.

Defined results: NULL texts and texts without words have the empty set, are linked with nothing
and stay; NULL keys take part, and a component's id is its smallest key that is not NULL; rows with
one key are documents of their own in one component if their texts are linked; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.base import filled, stored, text_key
from stratiform.llm.components import components
from stratiform.llm.words import mix, random_words, shingles

WORDS = 5  # of a shingle
PERCENT = 80  # similarity that links
BANDS, ROWS = 32, 5  # a pair at 0.8 shares no band with probability (1 - 0.8 ** 5) ** 32 = 3e-6
BATCH = 32  # hashes compared at a time
MISS = 1e-6  # a pair is given up when it reaches the threshold with less probability
BLOCK, BLOCK_BYTES = 512, 1 << 24  # nodes, and bytes of their texts, compared with as many at once

HASHES = BANDS * ROWS
_TIMES, _PLUS = random_words("times", HASHES) | np.uint64(1), random_words("plus", HASHES)
_SALT = random_words("bands", BANDS)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """The smallest 16 bits of the set under each of the hashes."""
    least = np.full(HASHES, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for at in range(0, len(shingle_set), 1024):
        part = shingle_set[at : at + 1024]
        least = np.minimum(least, (_TIMES[:, None] * part[None, :] + _PLUS[:, None]).min(axis=1))
    return (mix(least) & np.uint64(0xFFFF)).astype("<u2")


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A number for each band of each signature."""
    bands = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(_SALT, bands.shape[:2])
    for k in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return out.view(np.int64)


@lru_cache
def least_matches(percent: int, miss: float) -> tuple[int, ...]:
    """The fewest matches after 1, 2, ... batches with which a pair may still reach the threshold.

    With an even prior and m of n matches the similarity is Beta(m + 1, n - m + 1); it exceeds t
    with the probability that of n + 1 draws at t at most m succeed.
    """
    t = percent / 100

    def above(m: int, n: int) -> float:
        return sum(comb(n + 1, j) * t**j * (1 - t) ** (n + 1 - j) for j in range(m + 1))

    return tuple(next(m for m in range(n + 1) if above(m, n) >= miss) for n in range(BATCH, HASHES + 1, BATCH))


def surviving(a: np.ndarray, b: np.ndarray, percent: int, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of signature rows survive all batches, and their matches."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int32)
    for n, least in enumerate(least_matches(percent, miss)):
        part = slice(n * BATCH, (n + 1) * BATCH)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] >= least]
    return alive, matches[alive]


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, HASHES)


def profiles(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``key``, ``text_key``, ``bytes``, ``n_shingles``, ``set_key`` and ``signature`` of each row, the last two NULL without words; written once."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            sizes, sets, signatures = [], [], []
            for value in batch.column(3):
                own = shingles(value.as_py(), words)
                sizes.append(len(own))
                sets.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                signatures.append(signature(own).tobytes() if len(own) else None)
            made = [pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], ["key", "text_key", "bytes", "n_shingles", "set_key", "signature"])

    schema = f"key {docs.schema[key].dataType.simpleString()}, text_key binary, bytes bigint, n_shingles bigint, set_key binary, signature binary"
    size = F.octet_length(filled(text)).cast("long").alias("bytes")
    return stored(docs.select(F.col(key).alias("key"), text_key(text).alias("text_key"), size, filled(text).alias("text")).mapInArrow(profile, schema), "profiles")


def nodes_of(profile: DataFrame) -> DataFrame:
    """``node`` (a number), ``set_key``, ``signature`` and one row (``key``, ``text_key``, ``bytes``) of each different set; written once."""
    one = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "text_key", "bytes"))
    grouped = profile.where("set_key IS NOT NULL").groupBy("set_key").agg(one.alias("row"), F.first("signature").alias("signature"))
    return stored(grouped.select(F.monotonically_increasing_id().alias("node"), "set_key", "signature", "row.key", "row.text_key", "row.bytes"), "nodes")


def memberships(nodes: DataFrame) -> DataFrame:
    """``band``, ``node`` and the ``leader`` and number of ``blocks`` of the bucket, for buckets of two and more nodes; written once."""

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_rows(batch.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *(pa.array(np.repeat(batch.column(n).to_numpy(), BANDS)) for n in (0, 2))], ["band", "node", "bytes"])

    bands = nodes.select("node", "signature", "bytes").mapInArrow(banded, "band bigint, node bigint, bytes bigint")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("all_bytes") / BLOCK_BYTES)).cast("int")
    grouped = bands.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("size"), F.sum("bytes").alias("all_bytes"))
    sizes = grouped.where("size > 1").select("band", "leader", blocks.alias("blocks"))
    bands = bands.drop("bytes")
    return stored(bands.join(sizes, "band"), "buckets")


def promising(pairs: DataFrame, nodes: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs (``a``, ``b``) whose signatures survive the sequential comparison."""
    side = nodes.select("node", "signature")
    signed = pairs.join(side.toDF("a", "sig_a"), "a").join(side.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive, _ = surviving(_rows(batch.column(2)), _rows(batch.column(3)), percent, miss)
                yield batch.select(["a", "b"]).take(pa.array(alive))

    return signed.mapInArrow(compare, "a bigint, b bigint")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs that are linked, by their full sets."""
    joined = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, last, mine = [], None, None
            for n, (text_a, text_b) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if text_b != last:
                    last, mine = text_b, shingles(text_b, words)
                if _similar(mine, shingles(text_a, words), percent):
                    kept.append(n)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return joined.mapInArrow(check, "a bigint, b bigint")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Stretches of rows that are alike in their first three columns, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.array([batch.column(n).to_numpy() for n in range(3)]).T
        starts = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]).any(axis=1))))
        for a, b in zip(starts, [*starts[1:], len(names)]):
            name = tuple(names[a])
            if held and name != last:
                yield pa.Table.from_batches(held)
                held = []
            last = name
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _cross(group: pa.Table, percent: int, miss: float) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a pair of blocks with the rows of other labels that survive beside them.

    A pair that shares several bands belongs to the first of them.
    """
    (band, i, j), (own, node, label) = (group.column(c)[0].as_py() for c in ("band", "i", "j")), (group.column(c).to_numpy() for c in ("own", "node", "label"))
    sig = _rows(group.column("signature"))
    keys = band_keys(sig)
    earlier = int(np.flatnonzero(keys[0] == band)[0])
    right = np.flatnonzero(own == j)
    for x in np.flatnonzero(own == i):
        others = right[(label[right] != label[x]) & ((node[right] > node[x]) | (i != j))]
        others = others[~(keys[others, :earlier] == keys[x, :earlier]).any(axis=1)]
        if len(others):
            alive, _ = surviving(np.broadcast_to(sig[x], (len(others), HASHES)), sig[others], percent, miss)
            if len(alive):
                yield x, others[alive]


def _in_blocks(open_: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int, miss: float) -> DataFrame:
    """Links (``a``, ``b``) that join labels inside the given buckets; every pair of labels is tried until they are joined."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = open_.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = met.select("band", F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j"), "own", "node", "label")
    name = ["band", "i", "j"]

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            found = {int(n) for x, others in _cross(group, percent, miss) for n in (x, *others)}
            if found:
                yield from group.take(pa.array(sorted(found))).combine_chunks().to_batches()

    signed = dealt.join(nodes.select("node", "signature"), "node").select(*name, "own", "node", "label", "signature")
    kept = stored(signed.repartition(*name).sortWithinPartitions(*name).mapInArrow(involved, signed.schema), "involved")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            node, label, sets, root, links = group.column("node").to_numpy(), group.column("label").to_pylist(), {}, {}, []

            def top(x: int) -> int:
                while (up := root.get(x, x)) != x:
                    root[x] = x = root.get(up, up)
                return x

            def shingled(n: int) -> np.ndarray:
                if n not in sets:
                    sets[n] = shingles(group.column("text")[n].as_py(), words)
                return sets[n]

            for x, others in _cross(group, percent, miss):
                for y in others:
                    if top(label[x]) != top(label[y]) and _similar(shingled(x), shingled(int(y)), percent):
                        root[top(label[x])] = top(label[y])
                        links.append((int(node[x]), int(node[y])))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])

    whole = kept.join(texts, "node").select(*name, "own", "node", "label", "signature", "text")
    return whole.repartition(*name).sortWithinPartitions(*name).mapInArrow(join, "a bigint, b bigint")


def linked(docs: DataFrame, nodes: DataFrame, key: str, text: str, words: int, percent: int, miss: float) -> DataFrame:
    """``node`` and ``label`` of all nodes that are linked with another."""
    members = memberships(nodes)
    suspects = nodes.join(members.select("node").distinct(), "node").select("node", "key", "text_key")
    rows = docs.select(F.col(key).alias("key"), text_key(text).alias("text_key"), filled(text).alias("text"))
    same = rows.key.eqNullSafe(suspects.key) & (rows.text_key == suspects.text_key)
    # repeated rows are alike in key and text: any of them will do
    texts = stored(rows.join(suspects, same).groupBy("node").agg(F.first("text").alias("text")), "suspects")

    stars = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    found = stored(verified(stored(promising(stars, nodes, percent, miss), "promising"), texts, words, percent), "near-links")
    labels = components(found)
    named = members.select("band", "node", "blocks").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("band")
    more = stored(_in_blocks(stored(named.join(mixed, "band"), "open"), nodes, texts, words, percent, miss), "block-links")
    return components(found.unionByName(more))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """One row per document: ``key``, ``text_key``, ``n_shingles``, ``component_id``, its component's smallest key, and ``component``, a number, NULL without words."""
    profile = profiles(docs, key, text, words)
    nodes = nodes_of(profile)
    labels = linked(docs, nodes, key, text, words, percent, miss)
    classes = nodes.select("set_key", "node").join(labels, "node", "left").select("set_key", F.coalesce("label", "node").alias("label"))
    smallest = nodes.select("set_key", "key").join(classes, "set_key").groupBy("label").agg(F.min("key").alias("component_id"))
    by_set = stored(classes.join(smallest, "label").select("set_key", "component_id", F.col("label").alias("component")), "set-components")
    # without a set a document is alone
    joined = profile.drop("signature").join(by_set, "set_key", "left")
    alone = F.when(F.col("set_key").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select("key", "text_key", "n_shingles", alone.alias("component_id"), "component")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest key; rows without words all stay.

    Of rows alike in key and text one stays. A component without any key keeps one of its texts.
    """
    found = near_duplicates(docs, key, text, words, percent, miss)
    own = F.col("component_id").eqNullSafe(F.col("key")) & F.col("component").isNotNull()
    keepers = found.where(own).groupBy("component").agg(F.first("key").alias("keep_key"), F.min("text_key").alias("keep_text")).drop("component")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("row_key"), text_key(text).alias("row_text"), (F.regexp_like(filled(text), F.lit(r"[^\x20\x09-\x0D]"))).alias("worded"))
    same = rows.row_key.eqNullSafe(keepers.keep_key) & (rows.row_text == keepers.keep_text)
    chosen = rows.where("worded").join(keepers, same).select("row", "row_key", "row_text")
    first = Window.partitionBy("row_key", "row_text").orderBy(F.xxhash64(F.to_json("row")))
    kept = chosen.withColumn("n", F.row_number().over(first)).where("n = 1").select("row.*")
    return kept.unionByName(rows.where("NOT worded").select("row.*"))
